"""Which tokens of two tokenizers cover the same bytes, by merge-path partitioning.

Both tokenizers cut the same bytes; the ends of their tokens, A's and B's, are two
ascending lists.  Merged, every distinct end closes one overlap of an A token with
a B token, and an end of both closes a group.  The merge is cut into pieces of
equal work: a diagonal of the merge grid is searched for the place where the
merged order crosses it, for all diagonals at once, and every piece then merges
its own stretches of either list.  A common end whose two halves fall in different
pieces is stitched afterwards.

A task aligns the texts of a shard and keeps, of each text, how often it links
which pairs of ids.  The pairs' counts over the corpus are summed on Spark and
go back to the shards that asked for them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, kept, ragged, slices, text_buffer, texts, written
from .pieces import PieceEncoder, cut

#: Ends that a piece of the merge has, of both lists together.
PIECE = 1 << 16
#: Bytes of text that are encoded and aligned at once, and of a shard.
WINDOW, SHARD_BYTES = 1 << 20, 8 << 20
#: Different words that each encoder of a worker remembers.
MOST_PIECES = 250_000


def diagonals(a: np.ndarray, b: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each diagonal d in ``at``, how many of the first d merged ends are A's; of equal ends A's comes first."""
    low, high = np.maximum(at - len(b), 0), np.minimum(at, len(a))
    while (low < high).any():
        mid = (low + high) // 2
        # A's end number mid is among the first d if it is not above the last B end they would have without it
        inside = a[np.minimum(mid, len(a) - 1)] <= b[np.clip(at - mid - 1, 0, len(b) - 1)]
        low, high = np.where((low < high) & inside, mid + 1, low), np.where((low < high) & ~inside, mid, high)
    return low


def piece(a: np.ndarray, b: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A piece's overlaps (A tokens, B tokens) and common ends (A tokens, B tokens); i and j number its first ends."""
    at = np.searchsorted(b, a, "left")
    common = np.flatnonzero(np.append(b, -1)[np.minimum(at, len(b))] == a) if len(b) else np.zeros(0, np.int64)
    alone = np.ones(len(b), bool)
    alone[at[common]] = False  # an end of both closes one overlap
    j_alone = np.flatnonzero(alone)
    i_alone = np.searchsorted(a, b[j_alone], "left")
    return (np.concatenate([i + np.arange(len(a)), i + i_alone]), np.concatenate([j + at, j + j_alone]),
            i + common, j + at[common])


def merged(a: np.ndarray, b: np.ndarray, size: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Overlaps (A token, B token) and the last tokens of every group (A's, B's), in ascending order of groups.

    ``a`` and ``b`` are strictly ascending ends with the same last one.
    """
    total = len(a) + len(b)
    at = np.append(np.arange(0, total, size), total)
    i = diagonals(a, b, at)
    j = at - i
    found = [piece(a[i[k]:i[k + 1]], b[j[k]:j[k + 1]], int(i[k]), int(j[k])) for k in range(len(at) - 1)]
    left, right, close_a, close_b = (np.concatenate(x) for x in zip(*found, strict=True))
    # A's end is the last of one piece and the same end of B's the first of the next: the overlap is counted already
    inner = np.arange(1, len(at) - 1)
    inner = inner[(i[inner] > 0) & (j[inner] < len(b))]
    torn = inner[a[i[inner] - 1] == b[j[inner]]]
    if len(torn):
        gone = np.zeros(len(left), bool)
        twice = np.flatnonzero(np.isin(right, j[torn]))
        gone[twice[left[twice] == i[torn][np.searchsorted(j[torn], right[twice])]]] = True
        left, right = left[~gone], right[~gone]
        close_a, close_b = np.sort(np.append(close_a, i[torn] - 1)), np.sort(np.append(close_b, j[torn]))
    return left, right, close_a, close_b


def word_cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``pieces.cut``, but only at single spaces, which begin a piece of any vocabulary without inner spaces."""
    begins = np.zeros(len(data) + 1, bool)
    gaps = np.flatnonzero(data[1:-1] == 32) + 1
    begins[gaps[(data[gaps - 1] != 32) & (data[gaps + 1] != 32)]] = True
    begins[offsets] = True
    starts = np.flatnonzero(begins[:len(data)])
    return starts, np.diff(np.searchsorted(starts, offsets))


class Side:
    """A tokenizer: its encoder of texts that begin with a space, and the bytes of its tokens."""

    def __init__(self, encoder: PieceEncoder, tokens: list[bytes]):
        self.encoder, self.tokens = encoder, tokens
        self.length = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.start = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, ids per text, whether a text's tokens spell its bytes)."""
        ids, counts = self.encoder.batch(data, offsets)
        size = np.diff(offsets)
        ends = np.append(0, np.cumsum(self.length[ids]))
        spelt = np.diff(ends[np.append(0, np.cumsum(counts))])
        good = spelt == size
        own, text = np.repeat(good, counts), ragged(offsets[:-1][good], size[good])
        same = self.bytes[ragged(self.start[ids[own]], self.length[ids[own]])] == data[text]
        good[np.repeat(np.flatnonzero(good), size[good])[~same]] = False
        return ids, counts, good


def byte_side(tokenizer_json: str, pattern: str) -> Side:
    from tokenizers import Tokenizer

    from .wavelet import byte_letters, piece_encoder
    encoder = piece_encoder(tokenizer_json, pattern).plain  # special tokens spelt out are plain text
    encoder.most = MOST_PIECES
    value = {letter: b for b, letter in enumerate(byte_letters())}
    vocabulary = Tokenizer.from_str(tokenizer_json).get_vocab()
    tokens = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        tokens[i] = bytes(value[c] for c in token) if all(c in value for c in token) else token.encode()
    return Side(encoder, tokens)


def piece_side(model: bytes) -> Side:
    """A sentencepiece model, which adds the first space itself."""
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_proto=model)
    names = [m.id_to_piece(i) for i in range(len(m))]
    tokens = [bytes([int(name[3:5], 16)]) if m.is_byte(i) else name.replace("▁", " ").encode() for i, name in enumerate(names)]

    def encode(some: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = m.encode([s[1:] for s in some], num_threads=1) if some else []
        return np.array([i for ids in found for i in ids], np.uint32), np.fromiter(map(len, found), np.int64, len(found))

    # merges never cross a space where no piece has one behind another character
    free = all("▁" not in name.lstrip("▁") for name in names)
    return Side(PieceEncoder(lambda piece: [piece], encode, MOST_PIECES, cut=word_cut if free else whole_cut), tokens)


def whole_cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.unique(offsets[:-1][np.diff(offsets) > 0])
    return starts, np.diff(np.searchsorted(starts, offsets))


class Aligner:
    def __init__(self, a: Side, b: Side):
        self.a, self.b = a, b
        comma = [[f"{i}{end}".encode() for i in range(len(side.tokens))] for side in (a, b) for end in (",", "|;"[side is b])]
        self.spelt = [s for part in comma for s in part]

    def parts(self, data: np.ndarray) -> Iterator[np.ndarray]:
        """A long text cut where a token of either ends for certain."""
        at, size = 0, WINDOW
        while at < len(data):
            stop = min(at + size, len(data))
            if stop < len(data):
                edges = np.array([0, stop - at])
                both = np.intersect1d(cut(data[at:stop], edges)[0], self.b.encoder.cut(data[at:stop], edges)[0])
                if both[-1] == 0:
                    size *= 2
                    continue
                stop = at + int(both[-1])
            yield data[at:stop]
            at, size = stop, WINDOW

    def align(self, data: np.ndarray, offsets: np.ndarray):
        """Of texts that are not empty: (whether aligned, A tokens, B tokens, groups, links, the groups spelt out, text and pair of each link)."""
        a, n_a, good_a = self.a.encode(data, offsets)
        b, n_b, good_b = self.b.encode(data, offsets)
        good = good_a & good_b
        a, b = a[np.repeat(good, n_a)].astype(np.int64), b[np.repeat(good, n_b)].astype(np.int64)
        n_a, n_b = np.where(good, n_a, 0), np.where(good, n_b, 0)
        if not len(a):
            none = np.zeros(0, np.int64)
            return good, n_a, n_b, n_a, n_a, [b""] * len(good), none, none
        left, right, close_a, close_b = merged(np.cumsum(self.a.length[a]), np.cumsum(self.b.length[b]))
        last = np.cumsum(n_a)
        n_groups = np.diff(np.append(0, np.searchsorted(close_a, last, "left")))
        text = np.searchsorted(last, left, "right")
        # spelt out: the A tokens of a group, then its B tokens
        in_a, in_b = np.diff(close_a, prepend=-1), np.diff(close_b, prepend=-1)
        codes = np.empty(len(a) + len(b), np.int64)
        place_a = np.arange(len(a)) + np.repeat(np.cumsum(in_b) - in_b, in_a)
        place_b = np.arange(len(b)) + np.repeat(np.cumsum(in_a), in_b)
        k, m = len(self.a.tokens), len(self.b.tokens)
        codes[place_a], codes[place_b] = a, 2 * k + b
        codes[place_a[close_a]] += k
        codes[place_b[close_b]] += m
        bounds = np.append(0, np.cumsum(n_a + n_b)).tolist()
        words = list(map(self.spelt.__getitem__, codes.tolist()))
        spelt = [b"".join(words[x:y])[:-1] for x, y in zip(bounds, bounds[1:], strict=False)]
        links = np.bincount(text, minlength=len(good))
        return good, n_a, n_b, n_groups, links, spelt, text, b[right] << 32 | a[left]


class Shard:
    """Texts aligned so far: their figures, and how often each links which pair."""

    def __init__(self):
        self.ids, self.figures, self.digests = [], [], []
        self.pairs, self.entries, self.times, self.per_text = [], [], [], []
        self.bytes = 0

    def add(self, doc_ids: list, figures: np.ndarray, digests: list[str], text: np.ndarray, keys: np.ndarray, times: np.ndarray | None = None) -> None:
        self.ids += doc_ids
        self.figures.append(figures)
        self.digests += digests
        pairs, at = np.unique(keys, return_inverse=True)
        both = text * max(1, len(pairs)) + at
        cells, back = np.unique(both, return_inverse=True)
        self.pairs.append(pairs)
        self.entries.append(cells % max(1, len(pairs)))
        self.times.append(np.bincount(back, weights=times, minlength=len(cells)).astype(np.int64))
        self.per_text.append(np.bincount(cells // max(1, len(pairs)), minlength=len(doc_ids)))

    def row(self, number: int) -> pa.RecordBatch:
        import zstandard
        pairs = np.unique(np.concatenate(self.pairs))
        entries = np.concatenate([np.searchsorted(pairs, p)[e] for p, e in zip(self.pairs, self.entries, strict=True)])
        times, per_text = np.concatenate(self.times), np.concatenate(self.per_text)
        counts = np.bincount(entries, weights=times, minlength=len(pairs)).astype(np.int64)
        steps = np.diff(entries, prepend=0)  # ascending within a text
        packed = [zstandard.compress(x.astype(t).tobytes(), 1) for x, t in ((steps, "<i4"), (times, "<u4"), (per_text, "<u4"))]
        figures = np.concatenate(self.figures).astype("<i8")
        return pa.RecordBatch.from_pydict({
            "shard": pa.array([number], pa.int64()), "ids": pa.array([self.ids], pa.list_(pa.int64())),
            "figures": pa.array([figures.tobytes()], pa.binary()), "digests": pa.array([self.digests], pa.list_(pa.string())),
            "keys": pa.array([pairs], pa.list_(pa.int64())), "counts": pa.array([counts], pa.list_(pa.int64())),
            "steps": pa.array([packed[0]], pa.binary()), "times": pa.array([packed[1]], pa.binary()),
            "per_text": pa.array([packed[2]], pa.binary())})


SHARDS = ("shard bigint, ids array<bigint>, figures binary, digests array<string>, keys array<bigint>, counts array<bigint>, "
          "steps binary, times binary, per_text binary")
FIGURES = ("n_a", "n_b", "n_groups", "n_links")
ALIGNED = "doc_id bigint, " + "".join(f"{f} bigint, " for f in FIGURES) + "n_best bigint, count_sum bigint, groups_sha256 string"


def with_space(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts that are not empty, each behind a space."""
    size = np.diff(offsets)
    bounds = np.append(0, np.cumsum(size[size > 0] + 1))
    out = np.empty(int(bounds[-1]), np.uint8)
    first = np.zeros(len(out), bool)
    first[bounds[:-1]] = True
    out[first], out[~first] = 32, data
    return out, bounds


def _digest(spelt: bytes) -> str:
    return hashlib.sha256(spelt).hexdigest() if spelt else ""


def add_batch(shard: Shard, aligner: Aligner, doc_ids: list, data: np.ndarray, offsets: np.ndarray) -> None:
    """Aligns the texts of a batch; one beyond a window is worked through in parts and counted as one."""
    full = np.flatnonzero(np.diff(offsets) > 0)
    figures = np.zeros((len(doc_ids), len(FIGURES)), np.int64)
    digests = [""] * len(doc_ids)
    out, bounds = with_space(data, offsets)
    if len(doc_ids) == 1 and len(out) > WINDOW:
        digest, good, begun = hashlib.sha256(), True, False
        pairs, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for part in aligner.parts(out):
            ok, *numbers, spelt, _, keys = aligner.align(part, np.array([0, len(part)]))
            good = good and bool(ok[0])
            if not good:
                break
            digest.update(b";" * begun + spelt[0])
            begun = True
            figures[0] += [int(x[0]) for x in numbers]
            pairs, at = np.unique(np.append(pairs, keys), return_inverse=True)
            times = np.bincount(at, weights=np.append(times, np.ones(len(keys))), minlength=len(pairs))
        if good:
            shard.add(doc_ids, figures, [digest.hexdigest()], np.zeros(len(pairs), np.int64), pairs, times)
            return
        figures[:] = 0
        full = full[:0]
    text = keys = np.zeros(0, np.int64)
    if len(full):
        _, *numbers, spelt, text, keys = aligner.align(out, bounds)
        figures[full] = np.stack(numbers, axis=1)
        for k, s in zip(full.tolist(), spelt, strict=True):
            digests[k] = _digest(s)
        text = full[text]
    shard.add(doc_ids, figures, digests, text, keys)


def aligned(docs: DataFrame, tokenizer_json: str, pattern: str, model: bytes, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """Aligns a byte-level tokenizer's tokens (A) of space + text with a sentencepiece model's (B) of the text.

    A row per row of ``docs``: doc_id, n_a and n_b tokens, n_groups between common
    ends, n_links overlapping pairs of tokens, n_best links whose pair of ids is
    linked as often over the corpus as any pair of that B id, count_sum of the
    links' pairs' counts over the corpus, groups_sha256 of the groups' ids spelt
    ``a1,a2|b1;a3|b2,b3``.  A text that is null, empty, or not spelt by
    either's tokens has zeros and an empty digest, and links nothing.  Repeated rows
    count each; a row without an id is a text like others.
    """
    spark = docs.sparkSession
    content = spark.sparkContext.broadcast((tokenizer_json, pattern, model))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        aligner = kept("align", hash(content.value), lambda: Aligner(byte_side(*content.value[:2]), piece_side(content.value[2])))
        number, shard = TaskContext.get().partitionId() << 24, Shard()
        for batch in slices(batches, most=WINDOW):
            data, offsets = text_buffer(column(batch, "text"))
            add_batch(shard, aligner, column(batch, "doc_id").to_pylist(), data, offsets)
            shard.bytes += len(data) + 1
            if shard.bytes >= SHARD_BYTES:
                yield shard.row(number)
                number, shard = number + 1, Shard()
        if shard.ids:
            yield shard.row(number)

    shards = written(texts(docs, id_col, text_col).mapInArrow(run, SHARDS), "align-shards")
    each = shards.select(F.explode(F.arrays_zip("keys", "counts")).alias("p")).select(F.col("p.keys").alias("key"), F.col("p.counts").alias("count"))
    pairs = written(each.groupBy("key").agg(F.sum("count").alias("count")), "align-pairs")
    # at most as many rows as B has ids
    top = pairs.groupBy(F.shiftright("key", 32).alias("b")).agg(F.max("count").alias("most"))
    told = pairs.join(top, F.shiftright("key", 32) == F.col("b")).select("key", "count", (F.col("count") == F.col("most")).alias("best"))
    asked = shards.select(F.col("shard").alias("of"), F.posexplode("keys").alias("at", "key"))
    answers = asked.join(told, "key").select("of", "at", "count", "best")

    def tell(mine: pa.Table, answered: pa.Table) -> pa.Table:
        import zstandard
        out = []
        for row in mine.to_pylist():
            steps, times, per_text = (np.frombuffer(zstandard.decompress(row[name]), t)
                                      for name, t in (("steps", "<i4"), ("times", "<u4"), ("per_text", "<u4")))
            entries, times = np.cumsum(steps, dtype=np.int64), times.astype(np.int64)
            counts, best = np.zeros(len(answered), np.int64), np.zeros(len(answered), np.int64)
            at = answered.column("at").to_numpy()
            counts[at], best[at] = answered.column("count").to_numpy(), answered.column("best").to_numpy()
            bounds = np.append(0, np.cumsum(per_text.astype(np.int64)))
            sums = [np.diff(np.append(0, np.cumsum(times * x[entries]))[bounds]) for x in (best, counts)]
            figures = np.frombuffer(row["figures"], "<i8").reshape(-1, len(FIGURES))
            columns = [pa.array(row["ids"], pa.int64()), *map(pa.array, figures.T.copy()), *map(pa.array, sums), pa.array(row["digests"], pa.string())]
            out.append(pa.Table.from_arrays(columns, [f.split()[0] for f in ALIGNED.split(", ")]))
        return pa.concat_tables(out)

    return shards.drop("keys", "counts").groupBy("shard").cogroup(answers.groupBy("of")).applyInArrow(tell, ALIGNED)
