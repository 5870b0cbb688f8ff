"""Byte-level BPE encoding and decoding by a rank file, in numpy matrices.

The distinct matches of the splitting pattern are bucketed by length and laid
out as padded matrices of token ids, a match per row.  Every round each row
merges its leftmost pair of minimum rank; pairs are looked up in an open
addressing hash table held in arrays, and the gaps are closed by compaction.  A
match of many bytes is a row of several blocks.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bytes_of, column, kept, ragged, slices, text_buffer, texts
from .pieces import PieceEncoder

#: What tiktoken's pattern means by white space, spelled out for Python's ``regex``.
NEVER = np.int32(2**31 - 1)
#: Cells of a block: a match longer than this has a matrix of its own, a block per row.
BLOCK = 512
#: Cells of one matrix.
CELLS = 1 << 19


def read_ranks(content: bytes) -> list[bytes]:
    """The tokens of a rank file by id."""
    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines()) if token}
    out = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out


class PairTable:
    """(left id, right id) -> id of the joined token, by open addressing in arrays."""

    def __init__(self, tokens: list[bytes]):
        ids = {t: i for i, t in enumerate(tokens) if t}
        keys, values = [], []
        for token, i in ids.items():
            for cut in range(1, len(token)):
                left, right = ids.get(token[:cut]), ids.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(i)
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NEVER, np.int32)
        todo, ranks = np.array(keys, np.int64), np.array(values, np.int32)
        at = self.slot(todo)
        while len(todo):
            free = self.keys[at] < 0
            self.keys[at[free]] = todo[free]  # the last of those that want the same slot has it
            mine = self.keys[at] == todo
            self.values[at[mine]] = ranks[mine]
            todo, ranks, at = todo[~mine], ranks[~mine], (at[~mine] + 1) & ((1 << self.bits) - 1)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The joined token's id, which is its rank, or NEVER."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        at = self.slot(keys)
        out = np.where(self.keys[at] == keys, self.values[at], NEVER)
        open_ = np.flatnonzero((self.keys[at] != keys) & (self.keys[at] >= 0))
        at = at[open_]
        while len(open_):
            at = (at + 1) & ((1 << self.bits) - 1)
            seen = self.keys[at]
            hit = seen == keys[open_]
            out[open_[hit]] = self.values[at[hit]]
            more = ~hit & (seen >= 0)
            open_, at = open_[more], at[more]
        return out


class Bpe:
    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.pairs = PairTable(tokens)
        of_byte = {t[0]: i for i, t in enumerate(tokens) if len(t) == 1}
        self.byte_ids = np.array([of_byte.get(b, -1) for b in range(256)], np.int32)
        if (self.byte_ids < 0).any():
            raise ValueError("the rank file lacks a single-byte token")
        self.whole = {t: i for i, t in enumerate(tokens) if t}
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.token_length, self.token_start = lengths, np.cumsum(lengths) - lengths
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def matrix(self, rows: list[bytes], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Encodes matches of at most ``width`` bytes, all at once: (rows, ids of each, all their ids) as rows get done."""
        n = len(rows)
        size = np.fromiter(map(len, rows), np.int64, n)
        ids = np.full((n, width + 1), -1, np.int32)  # the last column stays empty
        flat = np.frombuffer(b"".join(rows), np.uint8)
        ids[np.repeat(np.arange(n), size), ragged(np.zeros(n, np.int64), size)] = self.byte_ids[flat]
        rank = np.full((n, width), NEVER, np.int32)
        valid = ids[:, 1:] >= 0
        rank[valid] = self.pairs.find(ids[:, :-1][valid], ids[:, 1:][valid])
        live = np.arange(n)
        while len(live):
            best = rank.argmin(axis=1)  # the leftmost minimum
            low = rank[np.arange(len(live)), best]
            done = low == NEVER
            if done.any():
                length = size[live[done]]
                yield live[done], length, ids[done][np.arange(ids.shape[1]) < length[:, None]].astype(np.uint32)
            keep = ~done
            live, ids, rank, best, low = live[keep], ids[keep], rank[keep], best[keep], low[keep]
            if not len(live):
                break
            r = np.arange(len(live))
            ids[r, best] = low
            cols = np.arange(ids.shape[1])
            source = cols + (cols > best[:, None])  # closes the gap right of the merge
            source[:, -1] = ids.shape[1] - 1
            ids = np.take_along_axis(ids, source, axis=1)
            ids[:, -1] = -1
            source = cols[:-1] + (cols[:-1] > best[:, None])
            source[:, -1] = np.minimum(source[:, -1], rank.shape[1] - 1)
            rank = np.take_along_axis(rank, source, axis=1)
            size[live] -= 1
            used = int(size[live].max())
            rank[r, np.minimum(size[live] - 1, rank.shape[1] - 1)] = NEVER
            for side in (best - 1, best):
                ok = np.flatnonzero((side >= 0) & (side + 1 < size[live]))
                rank[ok, side[ok]] = self.pairs.find(ids[ok, side[ok]], ids[ok, side[ok] + 1])
            ids, rank = ids[:, :used + 1], rank[:, :used]

    def blocks(self, row: bytes) -> np.ndarray:
        """One long match, its ids laid out in a matrix of blocks with each block's minimum kept.

        A round merges the leftmost pair of minimum rank of the whole match, as in
        ``matrix``, but closes the gap and looks for the new minimum only in the
        blocks that it touches.  A block's last pair reaches into the next block.
        """
        n = -(-len(row) // BLOCK)
        size = np.full(n, BLOCK)
        size[-1] = len(row) - (n - 1) * BLOCK
        flat = np.full(n * BLOCK + 1, -1, np.int32)
        flat[:len(row)] = self.byte_ids[np.frombuffer(row, np.uint8)]
        ranks = np.full(n * BLOCK, NEVER, np.int32)
        ranks[:len(row) - 1] = self.pairs.find(flat[:len(row) - 1], flat[1:len(row)])
        ids, rank = flat[:-1].reshape(n, BLOCK), ranks.reshape(n, BLOCK)
        low = rank.min(axis=1)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))  # blocks that hold ids yet
        tokens, whole = self.tokens, self.whole

        def removed(b: int, k: int) -> None:
            last = size[b] - 1
            for cells in (ids, rank):
                cells[b, k:last] = cells[b, k + 1:last + 1]
            rank[b, last] = NEVER
            size[b] = last
            if not last:
                after[before[b]] = after[b]  # never the first block, whose first id stays
                if after[b] < n:
                    before[after[b]] = before[b]

        def ranked(b: int, k: int) -> None:
            """The rank of the pair that begins at place k of block b."""
            c, j = (b, k + 1) if k + 1 < size[b] else (after[b], 0)
            joined = whole.get(tokens[ids[b, k]] + tokens[ids[c, j]]) if c < n else None
            rank[b, k] = NEVER if joined is None else joined

        while True:
            b = int(low.argmin())
            if low[b] == NEVER:
                break
            k = int(rank[b].argmin())
            ids[b, k] = low[b]
            c, j = (b, k + 1) if k + 1 < size[b] else (after[b], 0)
            removed(c, j)
            ranked(b, k)
            p, i = (b, k - 1) if k else (before[b], size[before[b]] - 1)
            if p >= 0:
                ranked(p, i)
            for x in {b, c, p} - {-1}:
                low[x] = rank[x].min()
        return ids[np.arange(BLOCK) < size[:, None]].astype(np.uint32)

    def encode(self, matches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids of the matches one after the other, ids of each)."""
        whole: list[tuple[int, int]] = []
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        buckets: dict[int, list[int]] = {}
        for k, match in enumerate(matches):
            if (i := self.whole.get(match)) is not None:  # a match that is a token is that token
                whole.append((k, i))
            elif len(match) > BLOCK:
                ids = self.blocks(match)
                parts.append((np.array([k]), np.array([len(ids)]), ids))
            else:
                buckets.setdefault(max(4, 1 << (len(match) - 1).bit_length()), []).append(k)
        for width, rows in buckets.items():
            step = max(1, CELLS // width)
            for at in range(0, len(rows), step):
                some = np.array(rows[at:at + step])
                parts += [(some[done], length, ids) for done, length, ids in self.matrix([matches[k] for k in some], width)]
        if whole:
            k, i = np.array(whole).T
            parts.append((k, np.ones(len(k), np.int64), i.astype(np.uint32)))
        if not parts:
            return np.zeros(0, np.uint32), np.zeros(len(matches), np.int64)
        row, length, ids = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(row)
        return ids[ragged((np.cumsum(length) - length)[order], length[order])], length[order]

    def decode(self, ids: np.ndarray) -> bytes:
        return self.token_bytes[ragged(self.token_start[ids], self.token_length[ids])].tobytes()


def piece_encoder(bpe: Bpe, pattern: str) -> PieceEncoder:
    import regex
    return PieceEncoder(regex.compile(pattern).findall, lambda some: bpe.encode([bytes_of(m) for m in some]))


def _tables(ranks: bytes, pattern: str) -> tuple[Bpe, PieceEncoder]:
    bpe = Bpe(read_ranks(ranks))
    return bpe, piece_encoder(bpe, pattern)


def encode(docs: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           decoded: bool = False) -> DataFrame:
    """(doc_id, ids binary: little-endian unsigned 32-bit token ids), a row per document.

    With ``decoded`` also what ``decode`` would add, in the same pass.

    ``ranks`` is the content of a rank file, ``pattern`` its splitting pattern
    (of the GPT-2 kind, where a space before a word begins a match).  Null and
    empty texts have no ids; repeated rows are encoded each.
    """
    content = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, encoder = kept("bpe", hash((content.value, pattern)), lambda: _tables(content.value, pattern))
        for batch in slices(batches, most=1 << 20):
            ids, counts = encoder.batch(*text_buffer(column(batch, "text")))
            ends = np.append(0, np.cumsum(counts)) * 4
            data = pa.Array.from_buffers(pa.binary(), batch.num_rows, [
                None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(ids.astype("<u4"))])
            columns = {"doc_id": column(batch, "doc_id"), "ids": data}
            if decoded:
                columns["decoded"] = pa.array([bpe.decode(ids[a // 4:b // 4]) for a, b in zip(ends, ends[1:], strict=False)], pa.binary())
            yield pa.RecordBatch.from_arrays([*columns.values()], [*columns])

    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, ids binary" + ", decoded binary" * decoded)


def decode(encoded: DataFrame, ranks: bytes) -> DataFrame:
    """``encoded`` with the column ``decoded`` (binary): the bytes of each row's ids, null for null."""
    content = encoded.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(read_ranks(content.value))
        for batch in slices(batches, "ids"):
            decoded = [None if b is None else bpe.decode(np.frombuffer(b, "<u4")) for b in column(batch, "ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.binary())],
                                             [*batch.schema.names, "decoded"])

    return encoded.drop("decoded").mapInArrow(run, encoded.drop("decoded").select("*").schema.add("decoded", "binary"))
