"""Language identification: the family first, then linear support vector machines within it.

A multinomial linear model tells the language family; between the languages
of the predicted family one support vector machine per pair votes.  Features
are hashed byte n-grams of the lower-cased text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import column, fold, slices, texts

#: Families of some languages by code (fixed values); any other language is a family of its own.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "is", "nl", "no", "sv"],
    "romance": ["ca", "es", "fr", "gl", "it", "pt", "ro"],
    "slavic": ["be", "bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
}
DIMS = 2048
#: Most documents that the models are learned from, all languages together.
SAMPLE_ROWS = 4000
UNKNOWN = "und"


def features(texts_: list[str]) -> np.ndarray:
    """Unit vectors of square-rooted counts of hashed byte 1- to 3-grams, a row per text."""
    raw = [f" {t.lower()} ".encode("utf-8", "surrogatepass") for t in texts_]
    n, size = len(raw), np.fromiter(map(len, raw), np.int64, len(raw))
    x = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint32)
    row = np.repeat(np.arange(n, dtype=np.int64), size) * DIMS
    out = np.zeros(n * DIMS, np.int64)
    gram = np.zeros(len(x), np.uint32)
    for k in range(1, 4):
        gram = gram[:len(x) - k + 1] * np.uint32(0x01000193) + x[k - 1:] + np.uint32(k)
        slot = (gram * np.uint32(0x9E3779B1)) >> np.uint32(32 - 11)
        inside = row[:len(slot)] == row[k - 1:]
        out += np.bincount(row[:len(slot)][inside] + slot[inside], minlength=n * DIMS)
    dense = np.sqrt(out.reshape(n, DIMS).astype(np.float32))
    return dense / np.maximum(1e-6, np.linalg.norm(dense, axis=1, keepdims=True))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def multinomial(x: np.ndarray, y: np.ndarray, classes: int, epochs: int = 40, rate: float = 8.0, size: int = 64) -> np.ndarray:
    """Weights of a softmax classifier, learned by averaged stochastic gradients on balanced classes."""
    rng = np.random.default_rng(3)
    w, mean = np.zeros((x.shape[1], classes), np.float32), np.zeros((x.shape[1], classes), np.float32)
    weight = (len(y) / classes / np.maximum(1, np.bincount(y, minlength=classes)))[y].astype(np.float32)
    one = np.eye(classes, dtype=np.float32)[y]
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), size):
            b = order[at:at + size]
            w -= rate / (1 + 0.1 * epoch) * (x[b].T @ ((softmax(x[b] @ w) - one[b]) * weight[b, None])) / len(b) + 1e-5 * w
        mean += w / epochs
    return mean


def machine(x: np.ndarray, sign: np.ndarray, epochs: int = 40, decay: float = 1e-4, size: int = 32) -> np.ndarray:
    """A linear support vector machine by stochastic subgradients of the hinge loss (Pegasos), averaged."""
    rng = np.random.default_rng(5)
    w, mean, step = np.zeros(x.shape[1], np.float32), np.zeros(x.shape[1], np.float32), 100
    weight = np.where(sign > 0, 0.5 / max(1, (sign > 0).sum()), 0.5 / max(1, (sign < 0).sum())) * len(sign)
    for _ in range(epochs):
        order = rng.permutation(len(sign))
        for at in range(0, len(sign), size):
            b, step = order[at:at + size], step + 1
            pace = 1 / (decay * step)
            wrong = b[sign[b] * (x[b] @ w) < 1]
            w = (1 - pace * decay) * w
            if len(wrong):
                w += pace / len(b) * ((weight[wrong] * sign[wrong]) @ x[wrong]).astype(np.float32)
            w *= min(1, 1 / (np.sqrt(decay) * np.linalg.norm(w) + 1e-12))
        mean += w / epochs
    return mean.astype(np.float32)


class Languages:
    def __init__(self, x: np.ndarray, langs: list[str], families: dict[str, list[str]]):
        of = {lang: family for family, some in families.items() for lang in some}
        self.families: dict[str, list[str]] = {}
        for lang in sorted(set(langs)):
            self.families.setdefault(of.get(lang, f"only {lang}"), []).append(lang)
        self.names = sorted(self.families)
        y = np.array([self.names.index(of.get(lang, f"only {lang}")) for lang in langs])
        self.family = multinomial(x, y, len(self.names)) if len(self.names) > 1 else None
        names, self.pairs = np.array(langs), {}
        for some in self.families.values():
            for a, b in combinations(some, 2):
                rows = np.flatnonzero((names == a) | (names == b))
                self.pairs[a, b] = machine(x[rows], np.where(names[rows] == a, 1.0, -1.0))

    def predict(self, texts_: list[str]) -> tuple[list[str], np.ndarray]:
        """Per text its language and the product of the family's probability and the language's mean margin, squashed."""
        x = features(texts_)
        p = softmax(x @ self.family) if self.family is not None else np.ones((len(x), 1))
        best = p.argmax(axis=1)
        lang, score = np.empty(len(x), object), p.max(axis=1).astype(np.float64)
        for f in set(best.tolist()):
            rows, some = np.flatnonzero(best == f), self.families[self.names[f]]
            if len(some) == 1:
                lang[rows] = some[0]
                continue
            votes, margins = np.zeros((len(rows), len(some))), np.zeros((len(rows), len(some)))
            for i, j in combinations(range(len(some)), 2):
                m = x[rows] @ self.pairs[some[i], some[j]]
                votes[:, i] += m > 0
                votes[:, j] += m <= 0
                m = np.clip(m, -15, 15)
                margins[:, i] += m
                margins[:, j] -= m
            pick = (votes + 1e-3 * np.tanh(margins)).argmax(axis=1)
            lang[rows] = np.array(some, object)[pick]
            score[rows] *= 1 / (1 + np.exp(-2 * margins[np.arange(len(rows)), pick] / (len(some) - 1)))
        return lang.tolist(), score


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def identify(docs: DataFrame, modulus: int = 4, held: int = 2, sample_rows: int = SAMPLE_ROWS,
             families: dict[str, list[str]] | None = None, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document, from its whole text alone.

    Learned on the driver from at most ``sample_rows`` texts, as many of each
    language (those with the smallest hashes of their ids), outside the held-out
    fold; with more languages than that, of the most frequent ones.  A text that
    is null or has no letter is ``und`` with score 0, and so is every text when
    there is nothing to learn from.
    """
    spark = docs.sparkSession
    known = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"),
                        F.col(text_col).isNotNull().alias("_some")).where(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("_some") & (fold(modulus) != held))
    known = known.select("doc_id", "lang").distinct().withColumn("_h", F.xxhash64("doc_id"))
    # the languages, a row each, those of most documents first; beyond the bound a sample holds no more of them
    langs = known.groupBy("lang").agg(F.count(F.lit(1)).alias("_rows")).orderBy(F.desc("_rows"), "lang").limit(sample_rows)
    most = max(1, sample_rows // max(1, langs.count()))
    # hashes low enough to be among the first of a language, half as many again and some, are all that a task gets
    share = F.least(F.lit(1.0), (1.5 * most + 64) / F.col("_rows"))
    low = known.join(F.broadcast(langs), "lang").where(F.col("_h").cast("double") <= share * 2.0 ** 64 - 2.0 ** 63)
    ordered = Window.partitionBy("lang").orderBy("_h", "doc_id")
    picked = low.withColumn("_n", F.row_number().over(ordered)).where(F.col("_n") <= most).select("doc_id", "lang")
    rows = texts(docs, id_col, text_col)
    found = (rows.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
             .mapInArrow(_vectors, "doc_id bigint, lang string, vector binary").collect())
    found.sort(key=lambda r: (r.doc_id, r.lang))
    model = Languages(np.stack([np.frombuffer(r.vector, np.float16) for r in found]).astype(np.float32),
                      [r.lang for r in found], FAMILIES if families is None else families) if found else None
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches, most=2 << 20):
            texts_ = column(batch, "text").to_pylist()
            lang, score = np.full(len(texts_), UNKNOWN, object), np.zeros(len(texts_))
            told = [k for k, t in enumerate(texts_) if model is not None and has_letter(t)]
            for at in range(0, len(told), 512):
                some = told[at:at + 512]
                lang[some], score[some] = model.predict([texts_[k] for k in some])
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(lang.tolist(), pa.string()), pa.array(score)],
                                             ["doc_id", "lang_pred", "score"])

    out = rows.mapInArrow(run, "doc_id bigint, lang_pred string, score double")
    return out.select("doc_id", (fold(modulus) == held).alias("held_out"), "lang_pred", "score")


def _vectors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, most=1 << 20):
        some = [k for k, t in enumerate(column(batch, "text").to_pylist()) if has_letter(t)]
        if not some:
            continue
        batch = batch.take(pa.array(some))
        x = features(column(batch, "text").to_pylist()).astype(np.float16)
        yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), column(batch, "lang"),
                                          pa.array([r.tobytes() for r in x], pa.binary())], ["doc_id", "lang", "vector"])
