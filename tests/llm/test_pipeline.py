"""The pipeline against its own operators' brute-force versions, stage by stage."""

import hashlib
import re

import numpy as np

import corpus_pipeline as P
from strata.llm.queries import pattern, tokenizer_file

SF = "/root/testdata/sf0.01"


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages(spark):
    import tiktoken

    from strata.llm.bpe import read_ranks
    from tests.llm.test_edges import brute_components
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first, columns = rows_of(docs), docs.columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    stage = dict(P.STAGES)
    assert [name for name, _ in P.STAGES] == ["quality classifier", "line dedup", "n-gram Jaccard join",
                                              "benchmark decontamination", "byte-level BPE"]

    out = stage["quality classifier"](spark, docs, SF).cache()
    assert out.columns == columns
    good = [i for i in labels if labels[i] == 1]
    kept = rows_of(out)
    assert np.mean([i in kept for i in good]) > 0.95 and len(kept) < len(first)

    lined = stage["line dedup"](spark, out, SF).cache()
    assert lined.columns == columns and set(rows_of(lined)) == set(kept)
    assert all(r.n_chars == len(r.text) for r in lined.collect() if r.text != kept[r.doc_id].text)

    near = stage["n-gram Jaccard join"](spark, lined, SF).cache()
    want = {i for i, _, c in brute_components([(r.doc_id, r.text, r.lang) for r in lined.collect()]) if i == c}
    assert near.columns == columns and set(rows_of(near)) == want

    clean = stage["benchmark decontamination"](spark, near, SF).cache()
    assert clean.columns == columns
    words = lambda t: re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = words(r.text)
        windows |= {tuple(w[k:k + 13]) for k in range(max(1, len(w) - 12) if w else 0)}
    lengths, want = {len(w) for w in windows}, set()
    for i, r in rows_of(near).items():
        w = words(r.text)
        hit = {p for n in lengths for k in range(len(w) - n + 1) if tuple(w[k:k + n]) in windows for p in range(k, k + n)}
        if not (hit and 20 * len(hit) >= len(w)):
            want.add(i)
    assert set(rows_of(clean)) == want

    own = tiktoken.Encoding("own", pat_str=pattern(), special_tokens={}, mergeable_ranks={
        t: k for k, t in enumerate(read_ranks(tokenizer_file("byte_bpe_multi_50k.tiktoken"))) if t})
    last = rows_of(stage["byte-level BPE"](spark, clean, SF))
    for i, r in rows_of(clean).items():
        ids = np.array(own.encode_ordinary(r.text or ""), "<u4")
        assert (last[i].n_tokens, last[i].ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert last[i].decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_run_and_awkward_tables(spark, tmp_path):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, predicted string"
    for name, rows in (("some", [(1, None, None, None, None, "p"), (None, "x y", "en", "s", 3, None), (2, "", "en", "s", 0, "q")]), ("none", [])):
        where = f"{tmp_path}/{name}"
        spark.createDataFrame(rows, schema).write.parquet(f"{where}/documents.parquet")
        spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
        spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{where}/benchmark.parquet")
        out = P.run(spark, where).collect()
        assert sorted(r.doc_id or 0 for r in out) == sorted(r[0] or 0 for r in rows)
