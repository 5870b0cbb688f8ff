"""Every text operator on null, empty, very long, tied and repeated input, empty tables and clashing extra columns."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm.queries import pattern, tokenizer_file

SCHEMA = ("doc_id bigint, text string, lang string, n_tokens string, score string, held_out string, shard string, "
          "kept_text string, component_id string")
LABELS = "doc_id bigint, quality int, toxic int"


def table(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, lang, "x", None, "y", "z", "w", "v") for i, t, lang in rows], SCHEMA)


def awkward():
    rng = random.Random(4)
    words = ["alpha", "beta", "Gamma,", "straße", "漢字", "été", "x"]
    long = " ".join(rng.choice(words) for _ in range(30000))
    line = "a line that is repeated in many of the documents here"
    rows = [(1, None, "en"), (2, "", None), (3, " \n\t\n ", "de"), (4, long, "en"), (5, long, "en"),
            (6, "one two", "en"), (7, "one two", "fr"), (None, "one two three four five six", "en"),
            (8, "a" * 5000, None), (8, "a" * 5000, None), (9, "é" * 700 + "　 \x85 \x1c end", "fr")]
    rows += [(20 + k, f"{line}\nnumber {k} of the lot\n  {line.upper()} ", "en") for k in range(6)]
    return rows


def labels(spark, rows):
    return spark.createDataFrame([(i, k % 2, k % 3 == 0 and 1 or 0) for k, (i, _, _) in enumerate(rows) if i is not None]
                                 + [(6, None, None), (None, 1, 1)], LABELS)


@pytest.fixture(scope="module", params=["awkward", "empty"])
def docs(request, spark):
    rows = awkward() if request.param == "awkward" else []
    return rows, table(spark, rows)


def crc_fold(i, m):
    return zlib.crc32(b"" if i is None else str(i).encode()) % m


def test_lines(spark, docs):
    from strata.llm.lines import drop_repeated_lines
    rows, df = docs
    got = drop_repeated_lines(df)
    assert got.columns.count("kept_text") == 1 and "lang" in got.columns
    out = sorted((r.doc_id or 0, r.kept_text, r.n_lines, r.n_dropped) for r in got.collect())
    where = {}
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    for i, t, _ in rows:
        for x in (t or "").split("\n"):
            if i is not None and len(key(x)) >= 40:
                where.setdefault(key(x), set()).add(i)
    want = []
    for i, t, _ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(where.get(key(x), ())) < 5 or max(where[key(x)]) == i]
        want.append((i or 0, "\n".join(kept), len(lines), len(lines) - len(kept)))
    assert out == sorted(want)
    assert not rows or sum(w[3] for w in want) == 10


def test_decontaminate(spark, docs):
    from strata.llm.decontaminate import find_benchmark
    rows, df = docs
    bench = spark.createDataFrame([(1, "One, TWO!"), (2, None), (None, "alpha"), (3, " . "), (1, "one two"),
                                   (4, "number 3 of the lot")], "item_id bigint, text string")
    got = {(r.doc_id, r.n_words): r for r in find_benchmark(df, bench).collect()}
    assert len(find_benchmark(df, bench.limit(0)).where("n_hit > 0").collect()) == 0
    if not rows:
        assert not got
        return
    assert got[6, 2].n_hit == 2 and got[6, 2].item_ids == ["1"]
    assert [(s.start, s.end) for s in got[6, 2].spans] == [(0, 7)]
    hit = next(r for (i, _), r in got.items() if i == 23)
    text = dict((i, t) for i, t, _ in rows)[23]
    assert [text[s.start:s.end] for s in hit.spans] == ["number 3 of the lot"] and hit.item_ids == ["4"]
    assert got[1, 0].n_hit == 0 and got[2, 0].n_hit == 0 and got[3, 0].n_hit == 0
    # a benchmark cut into many automata gives the same
    small = {(r.doc_id, r.n_words): r for r in find_benchmark(df, bench, automaton_bytes=8).collect()}
    assert small == got


def test_bpe(spark, docs):
    import tiktoken

    from strata.llm.bpe import decode, encode, read_ranks
    rows, df = docs
    ranks = tokenizer_file("byte_bpe_multi_50k.tiktoken")
    own = tiktoken.Encoding("own", pat_str=pattern(), special_tokens={},
                            mergeable_ranks={t: i for i, t in enumerate(read_ranks(ranks)) if t})
    got = decode(encode(df, ranks, pattern()), ranks).collect()
    want = sorted((i or 0, np.array(own.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t, _ in rows)
    assert sorted((r.doc_id or 0, bytes(r.ids), bytes(r.decoded)) for r in got) == want


def test_wavelet(spark, docs):
    from tokenizers import Tokenizer

    from strata.llm.wavelet import read_shards, write_shards
    rows, df = docs
    spec = tokenizer_file("byte_bpe_50k.json").decode()
    own = Tokenizer.from_str(spec)
    own.encode_special_tokens = True
    got = read_shards(*write_shards(df, spec, pattern(), shard_bytes=50_000)).collect()
    at, want = 0, []
    for i, t, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = [*own.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((i, at, len(ids), np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert sorted(((r.doc_id, r.start, r.n_tokens, bytes(r.ids)) for r in got), key=lambda r: r[1]) == want


def test_wavelet_added_tokens(spark):
    """Ids with the added tokens spelt out in texts, against the library with its default settings."""
    from tokenizers import Tokenizer

    from strata.llm.wavelet import read_shards, write_shards
    mark = "<|endoftext|>"
    some = [f"a line {mark} and more", mark, f"{mark}{mark}", f"  {mark}  \n{mark}\n x", None, "", "no mark", mark[:8], mark[8:] + " y",
            f"{mark[:8]}{mark} z", f"été{mark}漢字 {mark} ", "<|endoftext |>", f"tail{mark}"]
    for texts_ in (some, ["plain", "text"], [mark]):
        spec = tokenizer_file("byte_bpe_50k.json").decode()
        own = Tokenizer.from_str(spec)
        got = read_shards(*write_shards(table(spark, [(i, t, "en") for i, t in enumerate(texts_)]), spec, pattern())).collect()
        ids = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in got}
        want = {i: [*own.encode(t or "", add_special_tokens=False).ids, 0] for i, t in enumerate(texts_)}
        assert ids == want and (50256 in sum(ids.values(), [])) == (mark in texts_)
        assert [r.start for r in sorted(got, key=lambda r: r.doc_id)] == [sum(len(want[j]) for j in range(i)) for i in want]


def test_scores_cover_all_rows(spark, docs):
    from strata.llm.language import identify
    from strata.llm.quality import score_quality
    from strata.llm.toxicity import score_toxicity
    rows, df = docs
    for some in (labels(spark, rows), labels(spark, rows).limit(0)):
        for got, modulus, held in ((score_quality(df, some), 5, 0), (score_toxicity(df, some), 4, 2)):
            out = got.collect()
            assert sorted(r.doc_id or 0 for r in out) == sorted(i or 0 for i, _, _ in rows)
            for r in out:
                assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
                assert r.held_out == (crc_fold(r.doc_id, modulus) == held)
    out = identify(df).collect()
    assert sorted(r.doc_id or 0 for r in out) == sorted(i or 0 for i, _, _ in rows)
    for r in out:
        assert 0 <= r.score <= 1 and r.held_out == (crc_fold(r.doc_id, 4) == 2)
        assert (r.lang_pred == "und") == (r.doc_id in (1, 2, 3))
    assert all(r.lang_pred == "und" for r in identify(df.withColumn("lang", F.lit(None).cast("string"))).collect())


@pytest.mark.parametrize("long_label", [0, 1])
def test_toxicity_long_text_first(spark, long_label):
    """A 4 MB text whose id hashes first of its class leaves the class's other documents in the sample."""
    from strata.llm.toxicity import score_toxicity
    ids = [r.id for r in spark.range(400).where(F.crc32(F.col("id").cast("string").cast("binary")) % 4 != 2)
           .orderBy(F.xxhash64("id")).collect()]
    label = {i: k % 2 for k, i in enumerate(ids)}
    long = next(i for i in ids if label[i] == long_label)
    rng = random.Random(3)
    calm, bad = ["meadow", "river", "garden", "window", "paper"], ["scumbag", "vermin", "wretch", "filth", "swine"]

    def text(i, n=40):
        return " ".join(rng.choice(calm + bad * label[i]) for _ in range(n))
    df = table(spark, [(i, text(i, 750_000 if i == long else 40), "en") for i in ids])
    assert df.where(F.col("doc_id") == long).select(F.octet_length("text")).first()[0] > 4_000_000
    out = score_toxicity(df, spark.createDataFrame([(i, 0, y) for i, y in label.items()], LABELS)).collect()
    wrong = [r.doc_id for r in out if r.predicted != label[r.doc_id]]
    assert len(out) == len(ids) and len(wrong) <= len(ids) // 20


def brute_components(rows):
    sets = {}
    for k, (i, t, _) in enumerate(rows):
        words = (t or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))).split()
        sets[k] = {tuple(words[j:j + 5]) for j in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k
    live = [k for k in sets if sets[k] and rows[k][0] is not None]
    for a in live:
        for b in live:
            if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least = {}
    for k in live:
        least[root(k)] = min(least.get(root(k), rows[k][0]), rows[k][0])
    return sorted((i or 0, len(sets[k]), (least[root(k)] if k in live else i) or 0) for k, (i, _, _) in enumerate(rows))


def test_near(spark, docs):
    from strata.llm.near import near_components
    rows, df = docs
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in near_components(df).collect())
    assert got == brute_components(rows)


def test_near_groups_of_edited_copies(spark):
    """Chains of edits, groups larger than a task, and short texts, against all pairs."""
    from strata.llm.near import near_components
    rng = random.Random(8)
    vocabulary = [f"w{k}" for k in range(300)]
    rows = []
    for g in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 6, 12, 60, 150]))]
        for _ in range(rng.randint(1, 14)):
            if rng.random() < 0.6:  # a chain: each copy edits the last one
                base = list(base)
                for _ in range(max(1, len(base) // 50)):
                    base[rng.randrange(len(base))] = rng.choice(vocabulary)
            rows.append((1000 - len(rows), " ".join(base), "en"))
    shared = " ".join(rng.choice(vocabulary) for _ in range(30))
    rows += [(2000 + k, shared + " " + " ".join(rng.choice(vocabulary) for _ in range(rng.randint(2, 14))), "en") for k in range(40)]
    want = brute_components(rows)
    assert len({c for _, _, c in want}) > 20
    for task_classes in (1500, 4):
        got = near_components(table(spark, rows), task_classes=task_classes).collect()
        assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == want


def test_interpolation(spark, docs):
    from strata.llm.scoring import interpolated_scores
    rows, df = docs
    lower = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
    tokens = [[*(t or "").encode().translate(lower).split(), None] for _, t, _ in rows]
    count = {}
    for (i, _, _), ws in zip(rows, tokens, strict=True):
        for w in ws if crc_fold(i, 5) != 1 else ():
            count[w] = count.get(w, 0) + 1
    total, kinds = sum(count.values()), len(count)
    want = sorted((i or 0, crc_fold(i, 5) == 1, len(ws), sum(w in count for w in ws), total,
                   round(sum(np.log10((count.get(w, 0) + 0.5) / (total + 0.5 * (kinds + 1))) for w in ws), 4))
                  for (i, _, _), ws in zip(rows, tokens, strict=True))
    for order in (2, 3):
        out = interpolated_scores(df, order=order).collect()
        got = sorted((r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in out)
        assert got == want
        assert all(np.isfinite(r.score) and r.score < 0 for r in out)


def test_registered_mixture_has_trigrams(spark, tmp_path):
    """The word after "b" follows from the word before it, which bigrams cannot tell."""
    from strata.llm.queries import QUERIES
    from strata.llm.scoring import interpolated_scores
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(["a b c", "d b e"]) for _ in range(30)), "en") for i in range(200)]
    table(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.score for r in QUERIES["op1_deleted_interpolation"](spark, str(tmp_path)).collect()}
    want = {k: {r.doc_id: r.score for r in interpolated_scores(table(spark, rows), order=k).collect()} for k in (2, 3)}
    assert all(abs(got[i] - want[3][i]) < 1e-9 and got[i] > want[2][i] + 5 for i in got) and len(got) == 200


def test_sums_of_asked_n_grams():
    """Keys and counts survive their narrow form, and every shard is told the sums over all shards."""
    import pyarrow as pa
    import pyarrow.compute
    import zstandard

    from strata.llm.scoring import Shard, _ask, _pack, _tell, counts_told, narrow, small, unnarrow, unsmall
    press, unpress = zstandard.ZstdCompressor(), zstandard.ZstdDecompressor()
    keys = np.unique(np.random.default_rng(5).integers(0, 2**61, 1000, dtype=np.uint64))
    assert (unnarrow(narrow(keys, press), len(keys), unpress) == keys).all()
    counts = np.array([0, 1, 254, 255, 256, 10**12])
    assert (unsmall(small(counts, press), 6, unpress) == counts).all()
    some = [["a b a b", "b c"], ["a b c", None, "a b a"]]
    asked = []
    for k, texts_ in enumerate(some):
        n = len(texts_)
        batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(n), pa.int64()), "text": texts_, "train": [True] * n,
                                            "tune": [k == 1] * n, "shard": pa.array([k] * n, pa.int32())})
        asked.append(_ask(3, 8)(pa.Table.from_batches(list(_pack([batch])))))
    asked = pa.concat_tables(asked)
    told = pa.concat_tables([_tell(asked.filter(pa.compute.equal(asked["bucket"], b))) for b in set(asked["bucket"].to_pylist())])
    flat = [["^", *(t or "").split(), "$"] for texts_ in some for t in texts_]
    for core, used in ((False, flat), (True, flat[:2])):
        shard = Shard(some[0], 3)
        sums = counts_told(told.filter(pa.compute.equal(told["shard"], 0)), shard, 8, core)
        at = 0
        for words in flat[:2]:
            for j in range(2, len(words)):
                for m in (1, 2, 3):
                    gram = words[j - m + 1:j + 1]
                    assert sums[shard.at[m - 1][at + j]] == sum(w[x:x + m] == gram for w in used for x in range(len(w)))
            at += len(words)


def test_digest_of_items(spark):
    from strata.llm.queries import decontamination
    docs = spark.createDataFrame([(1, "one two three"), (2, None)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(10, "two three"), (9, "one two")], "item_id bigint, text string")
    out = {r.doc_id: r for r in decontamination(docs, bench).collect()}
    assert out[1].items_sha256 == hashlib.sha256(b"10,9").hexdigest() and out[1].contaminated and out[1].n_hit == 3
    assert out[2].items_sha256 == hashlib.sha256(b"").hexdigest() and not out[2].contaminated


def test_token_store_spreads_rows_that_share_an_id(spark):
    """Rows without an id, or of one id, are dealt to several files and keep ascending order."""
    from strata.llm.queries import pattern, tokenizer_file
    from strata.llm.wavelet import read_shards, write_shards
    spec = tokenizer_file("byte_bpe_50k.json").decode()
    rows = [(None if k % 3 else 7, f"text {k} " * 20, "en") for k in range(300)]
    folder, shards = write_shards(table(spark, rows), spec, pattern(), shard_bytes=5_000)
    sizes = [r.n_docs for r in shards.collect()]
    assert sum(sizes) == 300 and max(sizes) < 100
    got = sorted(read_shards(folder, shards).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None] * 200 + [7] * 100
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:]))
