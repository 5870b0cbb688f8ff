"""Toxicity by class-conditional Kneser-Ney models of spelling.

Two models, one of toxic and one of ordinary text, spell every word byte by byte,
and the log-likelihoods are compared per word.  Each class has counts of its
own for long contexts; below ``SHARED`` bytes both back off to the same
continuation counts, so what is rare in both is about as likely under either.
Spelling rather than whole words lets an unseen inflection of a toxic stem count.

A text's words are told apart by hashes of its bytes, and each distinct word is
spelt once in a worker's life.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, fold, kept, labelled_sample, mix, slices, text_buffer, texts, written
from .pieces import Known, Slices

#: Most labelled documents of each class that the models are learned from, with their whole texts.
SAMPLE_ROWS = 3000
#: Bytes of the longest n-gram; of the longest that is counted for both classes together.
ORDER, SHARED = 7, 2
#: Words of a stretch: beside the whole text, its most toxic stretch is compared.
STRETCH = 12
#: A word whose log-likelihood ratio is above this is a clear case.
CLEAR = 4.0
#: Words a worker remembers before it starts afresh.
MOST_WORDS = 3_000_000
BEGIN, END = 256, 257
#: Bytes of words after lower-casing: digits, a-z and all beyond ASCII.
INSIDE = np.isin(np.arange(256), [*range(48, 58), *range(97, 123), *range(128, 256)])


def lowered(data: np.ndarray) -> np.ndarray:
    """ASCII and accented Latin capitals in lower case."""
    out = data.copy()
    capital = (data >= 65) & (data <= 90)
    capital[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    out[capital] += 32
    return out


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, words per text) of the runs of word bytes."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = INSIDE[data]
    edge = inside[1:] & ~inside[:-1]
    over = inside[:-1] & ~inside[1:]
    # a word ends with its text
    joined = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    joined = joined[inside[joined] & inside[joined + 1]]
    edge[joined] = over[joined] = True
    starts, ends = np.flatnonzero(edge), np.flatnonzero(over)
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


class Table:
    """Sorted keys with a row of counts each; unknown keys have zeros."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, at = np.unique(keys, return_inverse=True)
        self.values = np.stack([np.bincount(at, weights=values[:, k], minlength=len(self.keys))
                                for k in range(values.shape[1])], axis=1).astype(np.float32)

    def get(self, keys: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[at] == keys)[:, None], self.values[at], np.float32(0)).astype(np.float64)


def grams(some: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(word of each symbol, its place in the word, hashes of the n-grams that end there by order)."""
    size = np.fromiter(map(len, some), np.int64, len(some)) + 2
    ends = np.cumsum(size)
    symbols = np.empty(int(size.sum()), np.uint64)
    inner = np.ones(len(symbols), bool)
    inner[ends - size] = inner[ends - 1] = False
    symbols[ends - size], symbols[ends - 1] = BEGIN, END
    symbols[inner] = np.frombuffer(b"".join(some), np.uint8)
    out = [mix(symbols + np.uint64(1))]
    for m in range(2, ORDER + 1):
        out.append(mix(np.roll(out[-1], 1) * np.uint64(0x9E3779B97F4A7C15) + symbols + np.uint64(m)))
    return np.repeat(np.arange(len(some)), size), np.arange(len(symbols)) - np.repeat(ends - size, size), out


class Spelling:
    """Interpolated Kneser-Ney models of classes 0 and 1; ``counts`` are the words' occurrences in either."""

    def __init__(self, some: list[bytes], counts: np.ndarray, discount: float = 0.75):
        self.discount = discount
        of, place, hashes = grams(some)
        types = (counts > 0).astype(np.float64)
        self.levels = []
        for m in range(1, ORDER + 1):
            ends = place >= max(1, m - 1)  # no n-gram is only the beginning, none reaches beyond it
            if m == ORDER:
                keys, values = hashes[m - 1][ends], counts[of[ends]].astype(np.float64)
            else:  # by how many different symbols before it, or words that it begins
                longer = np.flatnonzero(place >= m)
                _, first, at = np.unique(hashes[m][longer], return_index=True, return_inverse=True)
                have = np.stack([np.bincount(at, weights=types[of[longer], k], minlength=len(first)) > 0 for k in (0, 1)], axis=1)
                begins = np.flatnonzero(ends & (place == m - 1))
                keys = np.concatenate([hashes[m - 1][longer[first]], hashes[m - 1][begins]])
                values = np.concatenate([have.astype(np.float64), types[of[begins]]])
            if m <= SHARED:
                values = np.repeat(values.max(axis=1, keepdims=True), 2, axis=1)
            table = Table(keys, values)
            # of each context: occurrences and different symbols after it, by class
            context = np.zeros(len(hashes[0]), np.uint64) if m == 1 else np.roll(hashes[m - 2], 1)
            distinct, first = np.unique(hashes[m - 1][ends], return_index=True)
            held = table.get(distinct)
            self.levels.append((table, Table(context[ends][first], np.concatenate([held, held > 0], axis=1))))

    def ratio(self, some: list[bytes]) -> np.ndarray:
        """Of each word: log-likelihood as a toxic word less that as an ordinary one."""
        of, place, hashes = grams(some)
        d, p = self.discount, np.full((len(of), 2), 1 / 258)
        for m, (table, contexts) in enumerate(self.levels, 1):
            ends = np.flatnonzero(place >= max(1, m - 1))
            context = contexts.get(np.zeros(len(ends), np.uint64) if m == 1 else hashes[m - 2][ends - 1])
            seen = np.maximum(context[:, :2], 1)
            q = np.maximum(table.get(hashes[m - 1][ends]) - d, 0) / seen + d * context[:, 2:] / seen * p[ends]
            p[ends] = np.where(context[:, :2] > 0, q, p[ends])
        told = place >= 1
        each = np.log(p[told, 1]) - np.log(p[told, 0])
        return np.bincount(of[told], weights=each, minlength=len(some))


class Remembered:
    """Ratios of words, each distinct word spelt once."""

    def __init__(self, models: Spelling):
        self.models, self.known, self.ratios = models, Known(), np.zeros(0)

    def spelt(self, some: list[bytes]) -> np.ndarray:
        return np.concatenate([np.zeros(0), *(self.models.ratio(some[k:k + 20000]) for k in range(0, len(some), 20000))])

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if self.known.places.count > MOST_WORDS:
            self.known, self.ratios = Known(), np.zeros(0)

        def word(k: int) -> bytes:
            return data[starts[k]:ends[k]].tobytes()

        at, new = self.known.numbers(Slices(data, starts, ends))
        self.ratios = np.append(self.ratios, self.spelt(list(map(word, new.tolist()))))
        other = np.flatnonzero(at < 0)  # a hash that belongs to another word
        out = self.ratios[at]
        out[other] = self.spelt(list(map(word, other.tolist())))
        return out


def features(ratios, array: pa.Array) -> np.ndarray:
    """Per text: log-likelihood ratio per word, of its most toxic stretch and word, clear cases, length."""
    data, offsets = text_buffer(array)
    data = lowered(data)
    starts, ends, counts = words(data, offsets)
    ratio = ratios(data, starts, ends) if len(starts) else np.zeros(0)
    out = np.zeros((len(counts), 5))
    some = np.flatnonzero(counts > 0)
    run, stop = np.append(0, np.cumsum(ratio)), np.cumsum(counts)
    begin = stop - counts
    if len(some):
        out[some, 0] = (run[stop] - run[begin])[some] / counts[some]
        out[some, 1] = (run[np.minimum(begin + STRETCH, stop)] - run[begin])[some] / STRETCH
        out[some, 2] = np.maximum.reduceat(ratio, begin[some])
        out[some, 3] = np.log1p(np.add.reduceat((ratio > CLEAR).astype(np.float64), begin[some]))
        out[some, 4] = np.log1p(counts[some])
        long = np.flatnonzero(counts >= STRETCH)
        if len(long):
            stretch = np.append((run[STRETCH:] - run[:-STRETCH]) / STRETCH, -np.inf)
            edges = np.stack([begin[long], stop[long] - STRETCH + 1], axis=1).ravel()
            out[long, 1] = np.maximum.reduceat(stretch, np.minimum(edges, len(stretch) - 1))[::2]
    return out


class Calibrated:
    """The logistic function that turns the comparison of the two models into a score."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray):
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        z = self.spread(x)
        self.w = np.zeros(z.shape[1])
        for _ in range(40):  # Newton's method with a small ridge
            p = 1 / (1 + np.exp(-np.clip(z @ self.w, -30, 30)))
            h = (z * (weight * p * (1 - p))[:, None]).T @ z + 0.1 * np.eye(z.shape[1])
            self.w -= np.linalg.solve(h, z.T @ (weight * (p - y)) + 0.1 * self.w)

    def spread(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.concatenate([z, z[:, :4] * z[:, 4:], np.ones((len(z), 1))], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.spread(x) @ self.w, -30, 30)))


def word_counts(sample: DataFrame) -> DataFrame:
    """(word, ordinary, toxic): how often each word occurs in the texts of either class, summed on Spark."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter
        for batch in slices(batches, most=2 << 20):
            data, offsets = text_buffer(column(batch, "text"))
            data = lowered(data)
            starts, ends, counts = words(data, offsets)
            raw, label = data.tobytes(), np.repeat(column(batch, "label").to_numpy(zero_copy_only=False), counts)
            for k in (0, 1):
                mine = label == k
                seen = Counter(raw[a:b] for a, b in zip(starts[mine].tolist(), ends[mine].tolist(), strict=True))
                n, none = pa.array(seen.values(), pa.int64()), pa.array(np.zeros(len(seen), np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.binary()), none if k else n, n if k else none],
                                                 ["word", "ordinary", "toxic"])

    counted = sample.select("label", "text").mapInArrow(run, "word binary, ordinary bigint, toxic bigint")
    return counted.groupBy("word").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))


def featured(rows: DataFrame, models, name: str, keep: list[str], then=None) -> DataFrame:
    """The columns ``keep`` of every row and its text's features, or what ``then`` makes of them, as ``x``."""
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratios = kept("toxicity", name, lambda: Remembered(models.value))
        for batch in slices(batches, most=2 << 20):
            x = features(ratios, column(batch, "text"))
            told = pa.array(x.tolist(), pa.list_(pa.float64())) if then is None else pa.array(then(x))
            yield pa.RecordBatch.from_arrays([*[column(batch, c) for c in keep], told], [*keep, "x"])

    return rows.mapInArrow(run, f"{kinds}, x {'array<double>' if then is None else 'double'}")


def score_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", modulus: int = 4, held: int = 2,
                   threshold: float = 0.3, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document, from its whole text alone.

    The models are learned from the whole texts of at most ``sample_rows``
    labelled documents of each class outside the held-out fold; a quarter of them
    fits the score.  Their words are counted on Spark, and the driver gets each
    distinct word once.  Null and empty texts have no words and are scored by
    that.  Null labels are unused; with one class only the score is that class,
    without labels 0.
    """
    rows = texts(docs, id_col, text_col)
    sample, shares = labelled_sample(rows, labels, label, modulus, held, sample_rows)
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(4)) == 0
    sample = written(sample.withColumn("part", part), "toxicity-sample")
    have = {(r["label"], r["part"]): r["count"] for r in sample.groupBy("label", "part").count().collect()}
    sizes = {k: have.get((k, False), 0) + have.get((k, True), 0) for k in (0, 1)}
    split = len(have) == 4  # else the models and the score are learned from all of it
    scored = None
    if not all(sizes.values()):
        scored = rows.withColumn("score", F.lit(1.0 if sizes[1] else 0.0))
    else:
        found = word_counts(sample.where(~F.col("part")) if split else sample).toArrow().sort_by("word")
        if not found.num_rows:
            mean = shares[1] * sizes[1] / (shares[0] * sizes[0] + shares[1] * sizes[1])
            scored = rows.withColumn("score", F.lit(float(mean)))
    if scored is None:
        seen = np.stack([found["ordinary"].to_numpy(), found["toxic"].to_numpy()], axis=1)
        models = docs.sparkSession.sparkContext.broadcast(Spelling(found["word"].to_pylist(), seen))
        name = uuid.uuid4().hex
        fit = featured(sample.where("part") if split else sample, models, name, ["doc_id", "label"]).collect()
        fit.sort(key=lambda r: r.doc_id)
        y = np.array([r.label for r in fit], np.int64)
        weight = np.where(y == 1, shares[1] / (y == 1).sum(), shares[0] / (y == 0).sum())
        calibrated = Calibrated(np.array([r.x for r in fit]), y, weight * len(y) / weight.sum())
        scored = featured(rows, models, name, ["doc_id"], calibrated.score).withColumnRenamed("x", "score")
    return scored.select("doc_id", (fold(modulus) == held).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
