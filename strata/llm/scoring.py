"""Language-model scoring by deleted interpolation.

The probability of a word is a mixture of maximum-likelihood estimates of all
orders and a uniform one.  The mixture weights depend on how often the context
occurred (by powers of two) and are learned by expectation-maximisation on a
held-out part of the training texts, whose n-grams the estimates then leave out.

N-grams are identified by 64-bit hashes.  Texts are dealt into shards; each shard
asks for the counts of its distinct n-grams, the n-grams are summed where they
meet, in buckets, and every shard gets the sums of what it asked for.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bytes_of, column, fold, mix, slices, texts, word_hashes, written

#: Bytes of text in one shard, distinct n-grams (before they meet) in one bucket, about.
SHARD_BYTES, BUCKET_GRAMS = 13 << 19, 1 << 20
#: Bits of a key that tell n-grams apart; bit SEEN marks what is no word.
SEEN = 60
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
BEGIN, END = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)
#: Steps of the logarithm of an estimate in the held-out counts: an eighth of a power of two.
STEPS, LEVELS = 8, 40


class Shard:
    """The n-grams of some texts. ``grams[m]``: of order m + 1, ending at every token, a text's BEGIN first."""

    def __init__(self, texts_: list[str | None], order: int):
        words = [bytes_of(t).translate(LOWER).split() for t in texts_]
        self.counts = np.fromiter(map(len, words), np.int64, len(words)) + 1  # with the end
        size = self.counts + 1  # and the beginning
        flat = np.empty(int(size.sum()), np.uint64)
        ends = np.cumsum(size)
        inner = np.ones(len(flat), bool)
        inner[ends - size] = inner[ends - 1] = False
        flat[ends - size], flat[ends - 1] = BEGIN, END
        flat[inner] = word_hashes([w for ws in words for w in ws])
        self.text = np.repeat(np.arange(len(words)), size)
        self.is_begin = np.zeros(len(flat), bool)
        self.is_begin[ends - size] = True
        self.is_end = np.zeros(len(flat), bool)
        self.is_end[ends - 1] = True
        place = np.arange(len(flat)) - np.repeat(ends - size, size)
        self.grams = [flat]
        for m in range(1, order):
            before = np.where(place >= 1, np.roll(self.grams[-1], 1), mix(np.full(1, BEGIN + np.uint64(m)))[0])
            self.grams.append(mix(before * np.uint64(0x9E3779B97F4A7C15) + flat + np.uint64(m)))
        keys = [np.where(self.is_begin, mix(g + np.uint64(99)), g) if m == 0 else g for m, g in enumerate(self.grams)]
        # words first, so that a bucket can tell them from longer n-grams and beginnings
        self.words, at0 = np.unique(flat[~self.is_begin], return_inverse=True)
        rest = np.concatenate([keys[0][self.is_begin], *keys[1:]])
        self.others, at1 = np.unique(rest, return_inverse=True)
        self.at = [np.empty(len(flat), np.int64) for _ in range(order)]
        self.at[0][~self.is_begin] = at0
        n_begin = int(self.is_begin.sum())
        self.at[0][self.is_begin] = len(self.words) + at1[:n_begin]
        for m in range(1, order):
            self.at[m] = len(self.words) + at1[n_begin + (m - 1) * len(flat):n_begin + m * len(flat)]
        self.keys = np.concatenate([self.words, self.others])

    def deal(self, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """(order of the keys by bucket, words before other n-grams, both ascending; bounds of the buckets)."""
        bucket = ((self.keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)  # ranges of keys
        return np.argsort(bucket, kind="stable"), np.append(0, np.cumsum(np.bincount(bucket, minlength=buckets)))

    def occurrences(self, of_text: np.ndarray) -> np.ndarray:
        """How often each key occurs in the texts where ``of_text`` holds."""
        inside = of_text[self.text]
        return sum(np.bincount(at[inside], minlength=len(self.keys)) for at in self.at)


def small(values: np.ndarray, press) -> bytes:
    """Counts as bytes, those from 255 apart, compressed."""
    large = values >= 255
    return press.compress(np.where(large, 255, values).astype(np.uint8).tobytes() + values[large].astype("<u8").tobytes())


def unsmall(data: bytes, n: int, press) -> np.ndarray:
    data = press.decompress(data)
    out = np.frombuffer(data, np.uint8, n).astype(np.int64)
    out[out == 255] = np.frombuffer(data, "<u8", offset=n).astype(np.int64)
    return out


def narrow(keys: np.ndarray, press) -> bytes:
    """Ascending keys by their differences: the low five bytes as they are, the rest, which is mostly zero, compressed."""
    planes = np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T
    return planes[:5].tobytes() + press.compress(planes[5:].tobytes())


def unnarrow(data: bytes, n: int, press) -> np.ndarray:
    planes = np.empty((n, 8), np.uint8)
    planes[:, :5] = np.frombuffer(data, np.uint8, 5 * n).reshape(5, n).T
    planes[:, 5:] = np.frombuffer(press.decompress(data[5 * n:]), np.uint8, 3 * n).reshape(3, n).T
    return np.cumsum(planes.view("<u8").ravel(), dtype=np.uint64)


def _pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one shard in a batch of rows become one compressed blob."""
    import zstandard
    for batch in slices(batches, most=32 << 20):
        shards = column(batch, "shard").to_numpy(zero_copy_only=False)
        press, rows = zstandard.ZstdCompressor(level=3), batch.drop_columns(["shard"])
        order = np.argsort(shards, kind="stable")
        names, starts = np.unique(shards[order], return_index=True)
        blobs = []
        for some in np.split(order, starts[1:]):
            sink = pa.BufferOutputStream()
            part = rows.take(pa.array(some))
            with pa.ipc.new_stream(sink, part.schema) as out:
                out.write_batch(part)
            blobs.append(press.compress(sink.getvalue().to_pybytes()))
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(blobs, pa.binary())], ["shard", "blob"])


def rows_of(table: pa.Table) -> pa.Table:
    import zstandard
    press = zstandard.ZstdDecompressor()
    parts = [pa.ipc.open_stream(press.decompress(b)).read_all() for b in table["blob"].to_pylist()]
    return pa.concat_tables(parts).sort_by([("doc_id", "ascending"), ("text", "ascending")])


def _ask(order: int, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        import zstandard
        shard, rows = table["shard"][0].as_py(), rows_of(table)
        train = rows["train"].to_numpy()
        grams = Shard(rows["text"].to_pylist(), order)
        total = grams.occurrences(train)
        core = grams.occurrences(train & ~rows["tune"].to_numpy())
        by, at = grams.deal(buckets)
        keys = grams.keys[by] >> np.uint64(64 - SEEN) | (by >= len(grams.words)).astype(np.uint64) << np.uint64(SEEN)
        total, tuned = total[by], (total - core)[by]
        out, press = [], zstandard.ZstdCompressor(level=1)
        for b in range(buckets):
            some = slice(at[b], at[b + 1])
            if at[b + 1] > at[b]:
                out.append((b, shard, int(at[b + 1] - at[b]), narrow(keys[some], press), small(total[some], press), small(tuned[some], press)))
        return _table(out, ASKED)

    return run


ASKED = [("bucket", pa.int32()), ("shard", pa.int32()), ("n", pa.int32()), ("keys", pa.binary()),
         ("total", pa.binary()), ("tuned", pa.binary())]
TOLD = [("bucket", pa.int32()), ("shard", pa.int32()), ("n", pa.int32()), ("total", pa.binary()), ("tuned", pa.binary()),
        ("word_total", pa.int64()), ("word_kinds", pa.int64()), ("core_total", pa.int64()), ("core_kinds", pa.int64())]
SQL_TYPE = {pa.int32(): "int", pa.int64(): "bigint", pa.binary(): "binary", pa.float64(): "double"}


def _table(rows: list[tuple], fields: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    return pa.table([pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def _ddl(fields: list[tuple]) -> str:
    return ", ".join(f"{n} {SQL_TYPE[t]}" for n, t in fields)


def _tell(table: pa.Table) -> pa.Table:
    """Of one bucket: the sums of every asked n-gram, and the totals of its words."""
    import zstandard
    asked, press, unpress = table.to_pylist(), zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
    flat = np.concatenate([unnarrow(r["keys"], r["n"], unpress) for r in asked])
    distinct, at = np.unique(flat, return_inverse=True)
    total, tuned = (np.bincount(at, weights=np.concatenate([unsmall(r[c], r["n"], unpress) for r in asked]),
                                minlength=len(distinct)).astype(np.int64) for c in ("total", "tuned"))
    core, is_word = total - tuned, distinct >> np.uint64(SEEN) == 0
    sums = [int(total[is_word].sum()), int((total[is_word] > 0).sum()), int(core[is_word].sum()), int((core[is_word] > 0).sum())]
    out, begin = [], 0
    for r in asked:
        mine = at[begin:begin + r["n"]]
        begin += r["n"]
        out.append((r["bucket"], r["shard"], r["n"], small(total[mine], press), small(tuned[mine], press), *sums))
        sums = [0, 0, 0, 0]  # once a bucket
    return _table(out, TOLD)


class Estimates:
    """Of each token of a shard (beginnings left out): its estimates by order, the highest first, and its context's bucket."""

    def __init__(self, shard: Shard, counts: np.ndarray, order: int, total: int, kinds: int):
        token = ~shard.is_begin
        before = np.flatnonzero(token) - 1
        estimates, context = [], None
        for m in range(order - 1, 0, -1):
            held = counts[shard.at[m - 1]][before]  # the context is the n-gram that ends one token earlier
            context = held if context is None else context
            estimates.append(np.where(held > 0, counts[shard.at[m]][token] / np.maximum(held, 1), 0.0))
        self.word_counts = counts[shard.at[0]][token]
        estimates.append(self.word_counts / max(total, 1))
        self.context = np.zeros(len(estimates[0]), np.int64) if context is None else np.where(
            context > 0, np.minimum(LEVELS - 1, 1 + np.log2(np.maximum(context, 1)).astype(np.int64)), 0)
        self.by_order = np.stack([*estimates, np.full(len(estimates[0]), 1 / (kinds + 1))], axis=1)
        self.text = shard.text[token]


def counts_told(told: pa.Table, shard: Shard, buckets: int, core: bool = False) -> np.ndarray:
    """Of each key of the shard: its sum over all training texts, for ``core`` without the tuning fold."""
    import zstandard
    by, _ = shard.deal(buckets)
    press, rows = zstandard.ZstdDecompressor(), sorted(told.to_pylist(), key=lambda r: r["bucket"])
    out = np.empty(len(by), np.int64)
    out[by] = np.concatenate([unsmall(r["total"], r["n"], press) - (unsmall(r["tuned"], r["n"], press) if core else 0) for r in rows])
    return out


def _held_out(order: int, buckets: int, total: int, kinds: int):
    """Held-out counts of a shard: tokens by context bucket and estimates, in steps of their logarithms."""

    def run(told: pa.Table, docs: pa.Table) -> pa.Table:
        rows = rows_of(docs)
        shard = Shard(rows["text"].to_pylist(), order)
        e = Estimates(shard, counts_told(told, shard, buckets, core=True), order, total, kinds)
        steps = np.where(e.by_order > 0, np.round(-np.log2(np.maximum(e.by_order, 1e-300)) * STEPS).astype(np.int64), -1)
        cells, n = np.unique(np.concatenate([e.context[:, None], steps[:, :-1]], axis=1), axis=0, return_counts=True)
        return pa.table([pa.array(c, pa.int32()) for c in cells.T] + [pa.array(n, pa.int64())],
                        names=["context", *_steps(order), "n"])

    return run


def _steps(order: int) -> list[str]:
    """Columns of a cell: the steps of its estimates, the highest order first; -1 where one is zero."""
    return [f"step{m}" for m in range(order)]


def maximised(mass: np.ndarray) -> np.ndarray:
    """Mixture weights by context bucket, in proportion to the mass that each order took.

    A little of the overall mixture keeps every weight above zero and serves
    buckets without held-out tokens.
    """
    mass = mass + mass.sum(axis=0) / mass.sum() * 0.5 + 1e-3
    return mass / mass.sum(axis=1, keepdims=True)


def learn_weights(cells: DataFrame, order: int, kinds: int, rounds: int = 60, gain: float = 1e-7) -> np.ndarray:
    """Mixture weights by context bucket, by expectation-maximisation on held-out counts.

    ``cells`` has the columns context, step0 .. and n.  An expectation is one
    aggregate over all cells, of which a row per context bucket comes back.  The
    rounds end when the log-likelihood of a token grows by less than ``gain``.
    """
    weights = np.full((LEVELS, order + 1), 1 / (order + 1))
    estimates = [F.when(F.col(c) >= 0, F.pow(F.lit(2.0), -F.col(c) / STEPS)).otherwise(0.0).alias(f"p{m}")
                 for m, c in enumerate(_steps(order))]
    cells = written(cells.select("context", "n", *estimates, F.lit(1 / (kinds + 1)).alias(f"p{order}")), "held-out-cells")
    before = None
    for _ in range(rounds):
        by_context = [F.expr("array({})".format(", ".join(f"{float(w)!r}D" for w in column_))) for column_ in weights.T]
        shares = [f"p{m} * w{m}" for m in range(order + 1)]
        found = (cells.select("n", "context", *[f"p{m}" for m in range(order + 1)],
                              *[w[F.col("context")].alias(f"w{m}") for m, w in enumerate(by_context)])
                 .select("n", "context", *[F.expr(f"n * {share}").alias(f"s{m}") for m, share in enumerate(shares)],
                         F.expr(" + ".join(shares)).alias("p"))
                 .groupBy("context").agg(F.sum("n"), F.sum(F.col("n") * F.ln("p")),
                                         *[F.sum(F.col(f"s{m}") / F.col("p")) for m in range(order + 1)]).collect())
        if not found:
            break
        tokens, likelihood = sum(r[1] for r in found), sum(r[2] for r in found)
        mass = np.zeros_like(weights)
        for r in found:
            mass[r["context"]] = r[3:]
        weights = maximised(mass)
        if before is not None and likelihood - before < gain * tokens:
            break
        before = likelihood
    return weights


SCORED = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]


def _score(order: int, buckets: int, total: int, kinds: int, weights: np.ndarray):
    def run(told: pa.Table, docs: pa.Table) -> pa.Table:
        rows = rows_of(docs)
        shard = Shard(rows["text"].to_pylist(), order)
        e = Estimates(shard, counts_told(told, shard, buckets), order, total, kinds)
        p = (weights[e.context] * e.by_order).sum(axis=1)
        base = np.log10((e.word_counts + 0.5) / (total + 0.5 * (kinds + 1)))
        n = rows.num_rows
        return pa.table([rows["doc_id"], pa.array(shard.counts),
                         pa.array(np.bincount(e.text, weights=e.word_counts > 0, minlength=n).astype(np.int64)),
                         pa.array(np.bincount(e.text, weights=base, minlength=n)),
                         pa.array(np.bincount(e.text, weights=np.log10(p), minlength=n))], names=[f for f, _ in SCORED])

    return run


def interpolated_scores(docs: DataFrame, order: int = 2, modulus: int = 5, held: int = 1, tune: int = 0,
                        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document.

    Counts come from all documents whose fold is not ``held``; those of fold
    ``tune`` teach the mixture weights, with counts that leave them out.  Null
    and empty texts are one token, the end.  Repeated rows are counted and
    scored each; a row without an id is in the fold of the empty text.  With
    nothing to learn from every token has probability 1 / (0 + 1).
    """
    rows = texts(docs, id_col, text_col)
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = int(max(4, size // SHARD_BYTES + 1))
    buckets = int(max(8, order * size // 8 // BUCKET_GRAMS + 1))
    # the tuning fold has shards of its own
    apart = max(1, shards // modulus)
    own = rows.select("doc_id", "text", (fold(modulus) != held).alias("train"), (fold(modulus) == tune).alias("tune"))
    spot = F.xxhash64("doc_id", "text")
    own = own.withColumn("shard", F.when(F.col("tune"), F.pmod(spot, F.lit(apart))).otherwise(apart + F.pmod(spot, F.lit(shards))).cast("int"))
    packed = own.mapInArrow(_pack, "shard int, blob binary")

    told = written(packed.groupBy("shard").applyInArrow(_ask(order, buckets), _ddl(ASKED))
                   .groupBy("bucket").applyInArrow(_tell, _ddl(TOLD)), "gram-counts")
    sums = told.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("word_total", "word_kinds", "core_total", "core_kinds")]).first()
    total, kinds, core_total, core_kinds = map(int, sums)

    tuning = own.where(F.col("tune")).mapInArrow(_pack, "shard int, blob binary")
    cells = (told.where(F.col("shard") < apart).groupBy("shard").cogroup(tuning.groupBy("shard"))
             .applyInArrow(_held_out(order, buckets, core_total, core_kinds),
                           ", ".join(f"{c} int" for c in ("context", *_steps(order))) + ", n bigint")
             .groupBy("context", *_steps(order)).agg(F.sum("n").alias("n")))
    weights = learn_weights(cells, order, core_kinds)

    scored = (told.groupBy("shard").cogroup(packed.groupBy("shard"))
              .applyInArrow(_score(order, buckets, total, kinds, weights), _ddl(SCORED)))
    return scored.select("doc_id", (fold(modulus) == held).alias("held_out"), "n_tokens", "n_known",
                         F.lit(total).cast("bigint").alias("train_tokens"), "base_score", "score")
