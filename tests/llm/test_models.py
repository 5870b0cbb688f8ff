"""The learned operators on the given tables, against held-out labels, and the search against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm.queries import QUERIES

SF01 = "/root/testdata/sf0.01"


def held(spark, name, label):
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    rows = QUERIES[name](spark, SF01).where("held_out").join(labels, "doc_id").select("score", F.col(label).alias("y")).collect()
    return np.array([r.score for r in rows]), np.array([r.y for r in rows])


def auc(score, y):
    order = np.argsort(np.argsort(score)) + 1
    return (order[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() + 1) / 2) / ((y == 1).sum() * (y == 0).sum())


def test_quality(spark):
    score, y = held(spark, "op8_quality_mil", "quality")
    assert auc(score, y) > 0.9


def test_toxicity(spark):
    score, y = held(spark, "op6_toxicity_kneser_ney", "toxic")
    assert auc(score, y) > 0.75


def test_language(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op3_language_svm"](spark, SF01).where("held_out").join(docs, "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97


def test_mixture_beats_the_base(spark):
    total = QUERIES["op1_deleted_interpolation"](spark, SF01).where("held_out").agg(F.sum("base_score"), F.sum("score")).first()
    assert total[1] > total[0]


def em(cells, n, kinds, rounds=60):
    """Expectation-maximisation over plain arrays."""
    from strata.llm.scoring import LEVELS, STEPS
    weights = np.full((LEVELS, cells.shape[1]), 1 / cells.shape[1])
    p = np.where(cells[:, 1:] >= 0, np.exp2(-np.maximum(cells[:, 1:], 0) / STEPS), 0.0)
    p = np.concatenate([p, np.full((len(p), 1), 1 / (kinds + 1))], axis=1)
    for _ in range(rounds):
        share = weights[cells[:, 0]] * p
        share *= (n / share.sum(axis=1))[:, None]
        mass = np.zeros_like(weights)
        np.add.at(mass, cells[:, 0], share)
        mass += mass.sum(axis=0) / mass.sum() * 0.5 + 1e-3
        weights = mass / mass.sum(axis=1, keepdims=True)
    return weights


def test_weights_by_expectation_maximisation(spark):
    from strata.llm.scoring import STEPS, learn_weights
    rng = np.random.default_rng(1)
    p = np.array([[0.5, 0.02], [0.0, 0.1], [0.2, 0.2]])
    steps = np.where(p > 0, np.round(-np.log2(np.maximum(p, 1e-9)) * STEPS), -1).astype(int)
    cells = np.concatenate([np.full((3, 1), 4), steps], axis=1)
    n = rng.integers(100, 200, 3).astype(float)
    frame = spark.createDataFrame([(*map(int, c), int(k)) for c, k in zip(cells, n, strict=True)],
                                  "context int, step0 int, step1 int, n bigint")
    learned = learn_weights(frame, 2, 1000, gain=-np.inf)
    assert np.allclose(learned, em(cells, n, 1000), atol=1e-9)
    w = learned[4]

    def likelihood(w):
        q = np.concatenate([np.where(steps >= 0, np.exp2(-steps / STEPS), 0), np.full((3, 1), 1 / 1001)], axis=1)
        return (n * np.log(q @ w)).sum()
    assert abs(w.sum() - 1) < 1e-9
    for _ in range(200):
        other = np.abs(w + rng.normal(0, 0.05, 3)) + 1e-6
        assert likelihood(w) > likelihood(other / other.sum()) - 0.5
    # stopped where nothing is gained any more, it is the same mixture
    assert np.allclose(learn_weights(frame, 2, 1000, rounds=500)[4], w, atol=0.02)
    assert np.allclose(learn_weights(frame.limit(0), 2, 1000), 1 / 3)


def test_interpolation_equals_a_dictionary_version(spark):
    from collections import Counter
    from zlib import crc32

    from strata.llm.scoring import LEVELS, STEPS, interpolated_scores
    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in range(12)]
    texts_ = {i: " ".join(rng.choice(words, int(rng.integers(0, 30)), p=np.arange(12, 0, -1) / 78)) for i in range(50)}
    texts_[50], texts_[51] = None, texts_[7]
    order = 3
    fold = {i: crc32(str(i).encode()) % 5 for i in texts_}
    runs = {i: [f"<{m}>" for m in range(order - 1, 0, -1)] + (t or "").lower().split() + ["</>"] for i, t in texts_.items()}

    def counted(ids):
        grams = Counter()
        for i in ids:
            for end in range(order - 1, len(runs[i])):
                grams.update(tuple(runs[i][end - m:end + 1]) for m in range(order))
            for m in range(1, order):  # beginnings, as contexts
                grams.update([tuple(runs[i][order - 1 - m:order - 1])])
        tokens = [w for i in ids for w in runs[i][order - 1:]]
        return grams, len(tokens), len(set(tokens))

    def estimates(grams, total, kinds, i):
        for end in range(order - 1, len(runs[i])):
            p, depth = [], 0
            for m in range(order - 1, 0, -1):
                context, gram = tuple(runs[i][end - m:end]), tuple(runs[i][end - m:end + 1])
                p.append(grams[gram] / grams[context] if grams[context] else 0.0)
                if m == order - 1 and grams[context]:
                    depth = min(LEVELS - 1, 1 + int(np.log2(grams[context])))
            yield depth, [*p, grams[(runs[i][end],)] / total, 1 / (kinds + 1)]

    core = counted([i for i in texts_ if fold[i] not in (0, 1)])
    tally = Counter()
    for i in texts_:
        if fold[i] == 0:
            for depth, p in estimates(*core, i):
                tally[(depth, *[int(np.round(-np.log2(q) * STEPS)) if q > 0 else -1 for q in p[:-1]])] += 1
    weights = em(np.array(list(tally)), np.array(list(tally.values()), float), core[2])
    whole = counted([i for i in texts_ if fold[i] != 1])
    want = {i: sum(np.log10(np.dot(weights[d], p)) for d, p in estimates(*whole, i)) for i in texts_}
    frame = spark.createDataFrame(list(texts_.items()), "doc_id bigint, text string")
    got = {r.doc_id: r.score for r in interpolated_scores(frame, order).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[i] - want[i]) < 1e-6 for i in want), max(abs(got[i] - want[i]) for i in want)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, block string, v string, rank string")


def brute(rows, k):
    good = [(i, np.array(v, np.float64)) for i, v, *_ in rows
            if i is not None and v is not None and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    good = list({(i, tuple(v)): (i, v) for i, v in good}.values())
    out = {}
    for i, v in good:
        if i % 20 == 0:
            near = sorted(((-float(np.float64((v * x).sum())), j) for j, x in good if j != i))[:k]
            out[i] = [(j, -s) for s, j in near]
    return out


def test_forest_recall_and_ties(spark):
    from strata.llm.forest import nearest
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 8))
    rows = [(k, (centres[k % 12] + 0.4 * rng.normal(size=8)).astype(np.float32).tolist(), "a", "b", "c") for k in range(1500)]
    rows += [(2000 + k, np.array([3 * x for x in rows[40][1]], np.float32).tolist(), "a", "b", "c") for k in range(60)]
    rows += [(3000, None, "", "", ""), (3020, [0.0] * 8, "", "", ""), (3040, [float("nan")] * 8, "", "", ""), (3060, [None] * 8, "", "", ""),
             (3080, [1.0] * 7, "", "", ""), (None, [1.0] * 8, "", "", ""), (0, rows[0][1], "a", "b", "c")]
    want = brute(rows, 20)
    out = nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0, block_rows=400, task_queries=30, sample_queries=40).collect()
    got = {}
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == set(want)
    found = [len({j for j, _ in got[q]} & {j for j, _ in want[q]}) / len(want[q]) for q in want]
    assert np.mean(found) >= 0.9
    score = {(q, j): s for q in want for j, s in want[q]}
    for q, near in got.items():
        assert near == sorted(near, key=lambda x: (-x[1], x[0])) and all(j != q for j, _ in near) and len(near) == 20
        assert all(abs(score.get((q, j), s) - s) < 1e-9 for j, s in near)
    for q, near in got.items():  # of equal vectors the smallest ids
        copies = [j for j, _ in near if j >= 2000]
        assert copies == [j for j in range(2000, 2060) if j != q][:len(copies)]
    assert any(j >= 2000 for near in got.values() for j, _ in near)


def test_forest_few_and_none(spark):
    from strata.llm.forest import nearest
    assert nearest(vectors(spark, []), F.col("vec_id") % 20 == 0).collect() == []
    one = vectors(spark, [(20, [1.0, 2.0], "", "", "")])
    assert nearest(one, F.col("vec_id") % 20 == 0).collect() == []
    two = vectors(spark, [(20, [1.0, 2.0], "", "", ""), (21, [-1.0, 0.0], "", "", "")])
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in nearest(two, F.col("vec_id") % 20 == 0).collect()] == [(20, 1, 21, -1.0)]


def test_recall_on_the_given_vectors(spark):
    rows = spark.read.parquet(f"{SF01}/embeddings.parquet").collect()
    x, ids = np.array([r.embedding for r in rows], np.float64), np.array([r.vec_id for r in rows])
    got = {}
    for r in QUERIES["op7_prefix_forest"](spark, SF01).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    found = []
    for q in np.flatnonzero(ids % 20 == 0):
        s = np.where(ids == ids[q], -np.inf, x @ x[q])
        want = set(ids[np.lexsort((ids, -s))[:20]].tolist())
        found.append(len(want & got[ids[q]]) / 20)
    assert np.mean(found) >= 0.9


@pytest.mark.parametrize("n", [0, 1, 7, 5000])
def test_wavelet_matrix(n):
    from strata.llm.wavelet import WaveletMatrix, pack, unpack
    ids = np.random.default_rng(n).integers(0, 300, n).astype(np.uint32)
    matrix, names, ends = unpack(pack(ids, [5, None], np.array([n // 2, n])))
    assert names == [5, None] and ends.tolist() == [n // 2, n] and (matrix.tokens() == ids).all()
    at = np.arange(0, n, 3)
    assert (matrix.access(at) == ids[at]).all()
    for token in (0, 17, 299, 100_000):
        assert matrix.count(token) == (ids == token).sum()
        assert matrix.count(token, n // 3, n // 2) == (ids[n // 3:n // 2] == token).sum()
        assert matrix.occurrences(token) == np.flatnonzero(ids == token).tolist()
    assert isinstance(WaveletMatrix.build(ids), WaveletMatrix)


def test_quality_learns_from_whole_texts(spark):
    """The passage that decides a label may be anywhere in a text of many passages."""
    from strata.llm.quality import PASSAGE, _bags, learn
    text = "plain words of the usual kind " * 2000
    docs = spark.createDataFrame([(k, text if k % 2 else "zq! " * 300 + text, k % 2) for k in range(6)], "doc_id bigint, text string, label int")
    sizes = {r.doc_id: len(r.bag) // 2 for r in docs.mapInArrow(_bags, "doc_id bigint, label int, bag binary").collect()}
    assert all(n // 386 == -(-len(r.text) // PASSAGE) for r in docs.collect() for n in [sizes[r.doc_id]])
    labels = docs.select("doc_id", F.col("label").alias("quality"))
    for most in (1, 10_000):  # one long text of each class is learned from even where all are too long
        assert not isinstance(learn(docs.drop("label"), labels, held=-1, sample_passages=most), float)


def test_language_sample_is_bounded_and_the_first_by_hash(spark, monkeypatch):
    """As many of each language as the bound allows, however uneven; with more languages than that, the most frequent."""
    from strata.llm import language
    seen = []
    made = language.Languages.__init__

    def noted(self, x, langs, families):
        seen.append(sorted(langs))
        made(self, x, langs, families)

    monkeypatch.setattr(language.Languages, "__init__", noted)
    rows = [(k, f"text number {k}", "aa" if k % 10 else "bb") for k in range(3000)]
    language.identify(spark.createDataFrame(rows + rows[:50], "doc_id long, text string, lang string"), sample_rows=100).collect()
    assert seen[0] == ["aa"] * 50 + ["bb"] * 50
    many = [(k, f"text {k}", f"l{k // 2 if k < 80 else k}") for k in range(200)]
    language.identify(spark.createDataFrame(many, "doc_id long, text string, lang string"), sample_rows=10).collect()
    assert len(seen[1]) == 10 == len(set(seen[1]))
