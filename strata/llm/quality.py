"""Quality classifier: attention-based multiple-instance learning over passages.

A document is a bag of passages.  Every passage is encoded from its byte and
hashed byte-trigram counts, gated attention weighs the encodings, and the
document's score is a logistic function of their weighted sum.  Encoder,
attention and output are learned together from document labels alone.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import column, fold, labelled_sample, slices, text_buffer, texts
from .pieces import WHITE, Slices

#: Bytes of a passage; the last one of a text is shorter.
PASSAGE = 512
#: Features of a passage: counts of 128 ASCII bytes, of other bytes and of hashed
#: trigrams, then the shares of words that are the word one and two before.
BYTES, TRIGRAMS, DIMS = 129, 255, 386
#: Most labelled documents of each class that the model is learned from; of a class, one text at most that is longer
#: than so many passages.
SAMPLE_ROWS, SAMPLE_PASSAGES = 2000, 1024


def passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features, passages per document); a text without bytes is one passage without counts."""
    lengths = np.diff(offsets)
    per_doc = np.maximum(1, -(-lengths // PASSAGE))
    n = int(per_doc.sum())
    size = np.full(n, PASSAGE)  # of each passage; a text's last one has the rest
    size[np.cumsum(per_doc) - 1] = lengths - (per_doc - 1) * PASSAGE
    base = np.repeat(np.arange(n, dtype=np.int64) * DIMS, size)
    counts = np.bincount(base + np.minimum(data, 128), minlength=n * DIMS)
    if len(data) > 2:
        x = data.astype(np.uint32)
        tri = (x[:-2] * np.uint32(0x01000193) ^ x[1:-1]) * np.uint32(0x01000193) ^ x[2:]
        tri = (tri * np.uint32(0x9E3779B1) >> np.uint32(12)) % np.uint32(TRIGRAMS)
        within = np.ones(len(data) + 2, bool)  # a trigram begins here and ends in the same text
        within[np.maximum(offsets[1:] - 1, 0)] = within[np.maximum(offsets[1:] - 2, 0)] = False
        counts += np.bincount((base[:-2] + BYTES + tri)[within[:len(tri)]], minlength=n * DIMS)
    counts = counts.reshape(n, DIMS).astype(np.float32)
    x = np.sqrt(counts / np.maximum(1, counts[:, :BYTES].sum(axis=1, keepdims=True)))
    x[:, BYTES + TRIGRAMS:] = repeated_words(data, offsets, base // DIMS, n)
    return x, per_doc


def repeated_words(data: np.ndarray, offsets: np.ndarray, passage: np.ndarray, n: int) -> np.ndarray:
    """Per passage: shares of its words that are the word one and two before in the text."""
    out = np.zeros((n, 2), np.float32)
    white = np.ones(len(data) + 1, bool)
    white[:-1] = WHITE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    begins = ~white[:-1]
    begins[1:] &= white[:-2] | first[1:-1]
    stops = ~white[:-1] & (white[1:] | first[1:])
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    if len(starts) < 3:
        return out
    hashes = Slices(data, starts, ends).hashes()
    text = np.searchsorted(offsets, starts, side="right")
    total = np.maximum(np.bincount(passage[starts], minlength=n), 1)
    for k in (1, 2):
        same = (hashes[k:] == hashes[:-k]) & (text[k:] == text[:-k])
        out[:, k - 1] = np.bincount(passage[starts[k:]][same], minlength=n) / total
    return out


def softmax_by(values: np.ndarray, starts: np.ndarray, per_doc: np.ndarray) -> np.ndarray:
    top = np.repeat(np.maximum.reduceat(values, starts), per_doc)
    e = np.exp(values - top)
    return e / np.repeat(np.add.reduceat(e, starts), per_doc)


class AttentionBags:
    """h = tanh(x W + b); a = softmax of (tanh(h V) * sigmoid(h U)) w; score = sigmoid(sum(a h) c + d)."""

    def __init__(self, dims: int, hidden: int = 24, gate: int = 12, seed: int = 7):
        rng = np.random.default_rng(seed)
        scale = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.p = {"W": 2 * scale(dims, hidden), "b": np.zeros(hidden, np.float32), "V": scale(hidden, gate),
                  "U": scale(hidden, gate), "w": scale(gate), "c": scale(hidden), "d": np.zeros(1, np.float32)}

    def forward(self, x: np.ndarray, per_doc: np.ndarray) -> dict[str, np.ndarray]:
        p, starts = self.p, np.cumsum(per_doc) - per_doc
        h = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        a = softmax_by((t * s) @ p["w"], starts, per_doc)
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        y = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))
        return {"h": h, "t": t, "s": s, "a": a, "z": z, "y": y, "starts": starts}

    def gradients(self, x, per_doc, label, weight) -> dict[str, np.ndarray]:
        p, f = self.p, self.forward(x, per_doc)
        dy = weight * (f["y"] - label) / weight.sum()
        dz = np.repeat(dy[:, None] * p["c"], per_doc, axis=0)
        da = (dz * f["h"]).sum(axis=1)
        de = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, f["starts"]), per_doc))
        dt = de[:, None] * p["w"] * f["s"] * (1 - f["t"] ** 2)
        ds = de[:, None] * p["w"] * f["t"] * f["s"] * (1 - f["s"])
        dh = (f["a"][:, None] * dz + dt @ p["V"].T + ds @ p["U"].T) * (1 - f["h"] ** 2)
        return {"W": x.T @ dh, "b": dh.sum(axis=0), "V": f["h"].T @ dt, "U": f["h"].T @ ds,
                "w": (f["t"] * f["s"]).T @ de, "c": f["z"].T @ dy, "d": np.array([dy.sum()])}

    def fit(self, bags: list[np.ndarray], label: np.ndarray, weight: np.ndarray, epochs: int = 12,
            size: int = 64, rate: float = 6e-3, decay: float = 1e-4, seed: int = 7) -> None:
        rng, step = np.random.default_rng(seed), 0
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        for epoch in range(epochs):
            order = rng.permutation(len(bags))
            pace = rate * (1 - epoch / epochs)
            for at in range(0, len(order), size):
                some, step = order[at:at + size], step + 1
                grads = self.gradients(np.concatenate([bags[k] for k in some]), np.array([len(bags[k]) for k in some]),
                                       label[some], weight[some])
                for k, g in grads.items():
                    g = g + decay * self.p[k]
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] = (self.p[k] - pace * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
                                 ).astype(np.float32)


def _bags(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All passages of a document, for learning."""
    for batch in slices(batches, most=1 << 20):
        x, per_doc = passages(*text_buffer(column(batch, "text")))
        ends = np.cumsum(per_doc)
        out = [x[end - n:end].astype(np.float16).tobytes() for n, end in zip(per_doc, ends, strict=True)]
        yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), column(batch, "label"), pa.array(out, pa.binary())],
                                         ["doc_id", "label", "bag"])


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", modulus: int = 5, held: int = 0,
          sample_rows: int = SAMPLE_ROWS, sample_passages: int = SAMPLE_PASSAGES) -> AttentionBags | float:
    """The model, or the constant score where fewer than two classes are labelled (0.5 without labels).

    Whole texts are learned from.  Those above ``sample_passages`` passages are left
    out of the sample, but for one where a class has no others.
    """
    sample, sizes = labelled_sample(docs, labels, label, modulus, held, sample_rows)
    long = F.coalesce(F.octet_length("text"), F.lit(0)) > sample_passages * PASSAGE
    # a window over the sample only, whose rows are bounded
    first = F.row_number().over(Window.partitionBy("label").orderBy("_long", F.xxhash64("doc_id"), "doc_id"))
    sample = sample.withColumn("_long", long).withColumn("_n", first).where(~F.col("_long") | (F.col("_n") == 1)).drop("_long", "_n")
    rows = sorted(sample.mapInArrow(_bags, "doc_id bigint, label int, bag binary").collect(), key=lambda r: r.doc_id)
    y = np.array([r.label for r in rows], np.float32)
    if len(set(y.tolist())) < 2:
        return float(y[0]) if len(y) else 0.5
    bags = [np.frombuffer(r.bag, np.float16).reshape(-1, DIMS).astype(np.float32) for r in rows]
    # the classes are sampled apart: weights give them their shares again
    weight = np.where(y == 1, sizes[1] / (y == 1).sum(), sizes[0] / (y == 0).sum()).astype(np.float32)
    model = AttentionBags(DIMS)
    model.fit(bags, y, weight / weight.mean())
    return model


def score_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", modulus: int = 5, held: int = 0,
                  threshold: float = 0.3, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document, from its whole text alone.

    The model is learned on the driver from all passages of at most ``sample_rows``
    labelled documents of each class outside the held-out fold; every passage of
    every text is scored.  Null and empty texts are one passage without counts.
    Labels that are null are unused; without two classes the score is constant.
    """
    rows = texts(docs, id_col, text_col)
    model = learn(rows, labels, label, modulus, held, sample_rows)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches, most=1 << 20):
            if isinstance(model, float):
                score = np.full(batch.num_rows, model)
            else:
                score = model.forward(*passages(*text_buffer(column(batch, "text"))))["y"].astype(np.float64)
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(score)], ["doc_id", "score"])

    scored = rows.mapInArrow(run, "doc_id bigint, score double")
    return scored.select("doc_id", (fold(modulus) == held).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
