"""Token ids in succinct files: one wavelet matrix per shard.

A shard's ids are stored as bit planes, the highest bit first.  Each plane is
in the order that the planes above leave: all positions with bit 0, then those
with bit 1, each in their old order.  With counts of ones before every block a
plane answers rank and select, from which follow token access, counting a token
in a range and finding its occurrences, without unpacking the ids.  The file
holds the document ids and ends beside the planes; every section is a zstd frame.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.session import scratch_path

from .common import bytes_of, column, kept, slices, text_buffer, texts, written
from .pieces import PieceEncoder

MAGIC = b"WVM1"
#: Words of 64 bits between two stored counts.
BLOCK = 8
#: Bytes of text in one shard, about.
SHARD_BYTES = 24 << 20


class WaveletMatrix:
    """Immutable sequence of unsigned ids below 2**bits."""

    def __init__(self, n: int, planes: list[np.ndarray], counts: list[np.ndarray], zeros: list[int]):
        self.n, self.planes, self.counts, self.zeros = n, planes, counts, zeros
        self.bits = len(planes)

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        ids = np.ascontiguousarray(ids, np.uint32)
        n = len(ids)
        bits = max(1, int(ids.max()).bit_length()) if n else 1
        ids = ids.astype(np.uint16) if bits <= 16 else ids
        planes, counts, zeros = [], [], []
        for level in range(bits - 1, -1, -1):
            one = (ids & ids.dtype.type(1 << level)).astype(bool)
            packed = np.packbits(one, bitorder="little")
            words = -(-len(packed) // (8 * BLOCK)) * BLOCK
            plane = np.zeros(words * 8, np.uint8)
            plane[:len(packed)] = packed
            plane = plane.view("<u8")
            ones = np.bitwise_count(plane).reshape(-1, BLOCK).sum(axis=1, dtype=np.int64)
            planes.append(plane)
            counts.append(np.append(0, np.cumsum(ones)).astype("<u4"))
            zeros.append(n - int(np.bitwise_count(plane).sum()))
            parted = np.empty_like(ids)
            parted[:zeros[-1]] = ids[~one]
            parted[zeros[-1]:] = ids[one]
            ids = parted
        return cls(n, planes, counts, zeros)

    def rank1(self, level: int, i: np.ndarray) -> np.ndarray:
        """Ones before position i."""
        i = np.asarray(i, np.int64)
        plane, word = self.planes[level], i >> 6
        block = word // BLOCK
        out = self.counts[level][block].astype(np.int64)
        for k in range(BLOCK):
            at = block * BLOCK + k
            inside = at < word
            out += np.where(inside, np.bitwise_count(plane[np.where(inside, at, 0)]).astype(np.int64), 0) if len(plane) else 0
        if len(plane):
            rest = (i & 63).astype(np.uint64)
            last = plane[np.minimum(word, len(plane) - 1)] & ((np.uint64(1) << rest) - np.uint64(1))
            out += np.where(rest > 0, np.bitwise_count(last).astype(np.int64), 0)
        return out

    def access(self, positions: np.ndarray) -> np.ndarray:
        at = np.array(positions, np.int64)
        out = np.zeros(len(at), np.uint32)
        for level in range(self.bits):
            bit = (self.planes[level][at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
            ones = self.rank1(level, at)
            at = np.where(bit == 1, self.zeros[level] + ones, at - ones)
            out = out << np.uint32(1) | bit.astype(np.uint32)
        return out

    def tokens(self) -> np.ndarray:
        """All ids, from the lowest plane up: each plane tells how the one above was parted."""
        ids = np.zeros(self.n, np.uint16 if self.bits <= 16 else np.uint32)
        for level in range(self.bits - 1, -1, -1):
            one = np.unpackbits(self.planes[level].view(np.uint8), count=self.n, bitorder="little").view(bool)
            up = np.empty_like(ids)
            up[~one] = ids[:self.zeros[level]]
            up[one] = ids[self.zeros[level]:] | ids.dtype.type(1 << (self.bits - 1 - level))
            ids = up
        return ids.astype(np.uint32)

    def _range(self, token: int, low: int, high: int) -> tuple[int, int]:
        """Where the occurrences of ``token`` in [low, high) lie below the last plane."""
        if token >> self.bits:
            return 0, 0
        for level in range(self.bits):
            a, b = self.rank1(level, np.array([low, high]))
            one = token >> (self.bits - 1 - level) & 1
            low, high = (self.zeros[level] + a, self.zeros[level] + b) if one else (low - a, high - b)
        return int(low), int(high)

    def count(self, token: int, low: int = 0, high: int | None = None) -> int:
        a, b = self._range(token, low, self.n if high is None else high)
        return b - a

    def select(self, level: int, one: int, k: int) -> int:
        """Position of the k-th (from 0) bit ``one`` of a plane."""
        low, high = 0, self.n
        while low < high:  # the least i with more than k such bits before i + 1
            mid = (low + high) // 2
            ones = int(self.rank1(level, np.array([mid + 1]))[0])
            if (ones if one else mid + 1 - ones) > k:
                high = mid
            else:
                low = mid + 1
        return low

    def occurrences(self, token: int, most: int | None = None) -> list[int]:
        """Positions of ``token``, ascending."""
        low, high = self._range(token, 0, self.n)
        out = []
        for at in range(low, high if most is None else min(high, low + most)):
            for level in range(self.bits - 1, -1, -1):
                one = token >> (self.bits - 1 - level) & 1
                at = self.select(level, one, at - self.zeros[level] if one else at)
            out.append(at)
        return out


def pack(ids: np.ndarray, doc_ids: list[int | None], ends: np.ndarray) -> bytes:
    """The file of one shard. ``ends``: ids up to and with each document."""
    import zstandard
    matrix, press = WaveletMatrix.build(ids), zstandard.ZstdCompressor(level=1).compress
    sections = [np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
                np.array([d is None for d in doc_ids], np.uint8).tobytes(), np.asarray(ends, "<i8").tobytes(),
                np.array(matrix.zeros, "<i8").tobytes()]
    for plane, counts in zip(matrix.planes, matrix.counts, strict=True):
        sections += [plane.tobytes(), counts.tobytes()]
    frames = [press(s) for s in sections]
    head = struct.pack("<4sQII", MAGIC, matrix.n, matrix.bits, len(frames))
    return head + struct.pack(f"<{len(frames)}Q", *map(len, frames)) + b"".join(frames)


def unpack(data: bytes) -> tuple[WaveletMatrix, list[int | None], np.ndarray]:
    import zstandard
    magic, n, bits, k = struct.unpack_from("<4sQII", data)
    if magic != MAGIC:
        raise ValueError("not a wavelet matrix file")
    at = struct.calcsize("<4sQII")
    sizes = struct.unpack_from(f"<{k}Q", data, at)
    at += 8 * k
    parts, press = [], zstandard.ZstdDecompressor()
    for size in sizes:
        parts.append(press.decompress(data[at:at + size]))
        at += size
    ids, null, ends, zeros = (np.frombuffer(p, t) for p, t in zip(parts, ("<i8", np.uint8, "<i8", "<i8"), strict=False))
    matrix = WaveletMatrix(n, [np.frombuffer(p, "<u8") for p in parts[4::2]],
                           [np.frombuffer(p, "<u4") for p in parts[5::2]], zeros.tolist())
    return matrix, [None if x else i for i, x in zip(ids.tolist(), null.tolist(), strict=True)], ends


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    return [chr(b) if b in own else chr(256 + b - sum(o < b for o in own)) for b in range(256)]


class MarkedEncoder:
    """Encodes the text between added tokens by ``plain``; an added token, wherever it is spelt out, is its id."""

    def __init__(self, plain: PieceEncoder, marks: dict[bytes, int]):
        import re
        self.plain, self.marks = plain, marks
        # of those that begin at a place the longest
        self.find = re.compile(b"|".join(map(re.escape, sorted(marks, key=len, reverse=True)))) if marks else None

    def batch(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(all ids of the texts one after the other, number of ids of each text)."""
        raw = data.tobytes() if self.find else b""
        if not self.find or not self.find.search(raw):
            return self.plain.batch(data, offsets)
        spans = [(*m.span(), self.marks[m.group()]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
                 for m in self.find.finditer(raw, a, b)]
        begin, end, ids = np.array(spans, np.int64).reshape(-1, 3).T
        edge = np.zeros(len(data) + 1, np.int64)
        np.add.at(edge, begin, 1)
        np.add.at(edge, end, -1)
        gone = np.cumsum(edge[:-1]) > 0
        before = np.append(0, np.cumsum(gone))  # bytes of added tokens before each place
        limits, cuts = offsets - before[offsets], begin - before[begin]
        bounds = np.sort(np.concatenate([limits, cuts]))
        found, lengths = self.plain.batch(data[~gone], bounds)
        total = np.append(0, np.cumsum(lengths))
        counts = np.diff(total[np.searchsorted(bounds, limits)]) + np.diff(np.searchsorted(begin, offsets))
        return np.insert(found, total[np.searchsorted(bounds, cuts)], ids.astype(np.uint32)), counts


def piece_encoder(tokenizer_json: str, pattern: str) -> MarkedEncoder:
    """Encodes with the tokenizers library, which gets each distinct match of ``pattern`` once.

    Texts are first cut at the added tokens, as the library does.  The matches,
    spelt in the vocabulary's letters, go to the library's model one by one, as
    its own splitter would hand them on.
    """
    import json

    import regex
    from tokenizers import Tokenizer
    spec = json.loads(tokenizer_json)
    cutter = spec.get("pre_tokenizer") or {}
    if spec.get("normalizer") or cutter.get("type") != "ByteLevel" or not cutter.get("use_regex") or cutter.get("add_prefix_space"):
        raise ValueError("a byte-level tokenizer without normaliser is expected")
    added = [t for t in spec.get("added_tokens") or [] if t["content"]]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added) or len({t["normalized"] for t in added}) > 1:
        raise ValueError("added tokens that match exactly, and all alike, are expected")
    tokenize = Tokenizer.from_str(tokenizer_json).model.tokenize
    letters = dict(enumerate(byte_letters()))
    space = letters[32]

    def encode(some: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids: list[int] = []
        ends = []
        for match in some:
            plain = match.isascii() and match[0] == " " and match[1:].isalpha()
            spelt = space + match[1:] if plain else bytes_of(match).decode("latin-1").translate(letters)
            ids += [t.id for t in tokenize(spelt)]
            ends.append(len(ids))
        return np.array(ids, np.uint32), np.diff(np.array(ends, np.int64), prepend=0)

    return MarkedEncoder(PieceEncoder(regex.compile(pattern).findall, encode),
                         {bytes_of(t["content"]): t["id"] for t in added})


def write_shards(docs: DataFrame, tokenizer_json: str, pattern: str, end_id: int = 0, id_col: str = "doc_id",
                 text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> tuple[str, DataFrame]:
    """Writes the shards; returns their folder and a table (shard, n_docs, n_tokens) of all shards.

    Documents are dealt into ranges of ascending id (ties by a hash of the text,
    null ids first) and each range becomes one file.  Each document's ids end with
    ``end_id``; null and empty texts have only that.  An added token
    that a text spells out is that token, as by the library's default.  A task writes under a
    name of its own and then renames, so a retried task leaves the same file.
    """
    spark = docs.sparkSession
    rows = texts(docs, id_col, text_col)
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)) + 8 * F.count(F.lit(1))).first()[0]
    folder = scratch_path(spark, "wavelet")
    content = spark.sparkContext.broadcast(tokenizer_json)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        from pyarrow import fs
        from pyspark import TaskContext
        encoder = kept("wavelet", hash((content.value, pattern)), lambda: piece_encoder(content.value, pattern))
        ids, doc_ids, counts = [], [], []
        for batch in slices(batches, most=1 << 20):
            found, lengths = encoder.batch(*text_buffer(column(batch, "text")))
            ends = np.cumsum(lengths)
            some = np.full(len(found) + len(lengths), end_id, np.uint32)
            holds = np.ones(len(some), bool)
            holds[ends + np.arange(len(ends))] = False
            some[holds] = found
            ids.append(some)
            counts.append(lengths + 1)
            doc_ids += column(batch, "doc_id").to_pylist()
        if not doc_ids:
            return
        shard = TaskContext.get().partitionId()
        ends = np.cumsum(np.concatenate(counts))
        store, path = fs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        own = f"{path}/_{uuid.uuid4().hex}"
        with store.open_output_stream(own) as out:
            out.write(pack(np.concatenate(ids), doc_ids, ends))
        store.move(own, f"{path}/{shard:08d}.wvm")
        yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int64()),
                                          "n_docs": pa.array([len(doc_ids)], pa.int64()),
                                          "n_tokens": pa.array([int(ends[-1])], pa.int64())})

    # shards are numbered by their partition, so the ranges must not be merged
    # rows that share an id, or have none, are spread by a hash of their text
    ranges = (rows.withColumn("_h", F.xxhash64("text")).repartitionByRange(max(1, -(-size // shard_bytes)), "doc_id", "_h")
              .sortWithinPartitions("doc_id", "_h", "text"))
    return folder, written(ranges.mapInArrow(run, "shard bigint, n_docs bigint, n_tokens bigint"), "wavelet-shards")


def read_shards(folder: str, shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids binary) of every document, read from the files alone.

    ``start`` counts the ids of all documents before it over all shards.
    """
    spark = shards.sparkSession

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(column(batch, "path").to_pylist(), column(batch, "content"), strict=True):
                matrix, doc_ids, ends = unpack(data.as_buffer().to_pybytes())
                ids, shard = matrix.tokens().astype("<u4"), int(path.rpartition("/")[2].partition(".")[0])
                starts = np.append(0, ends[:-1])
                step = 4096
                for at in range(0, len(doc_ids), step):
                    some = slice(at, at + step)
                    a, b = starts[some], ends[some]
                    data_ = pa.Array.from_buffers(pa.binary(), len(a), [
                        None, pa.py_buffer((np.append(a[:1], b) * 4 - a[0] * 4).astype(np.int32)),
                        pa.py_buffer(ids[a[0]:b[-1]])])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([shard] * len(a), pa.int64()), pa.array(doc_ids[some], pa.int64()),
                         pa.array(a, pa.int64()), pa.array(b - a, pa.int64()), data_],
                        ["shard", "doc_id", "inside", "n_tokens", "ids"])

    if not shards.limit(1).count():
        return spark.createDataFrame([], "doc_id bigint, start bigint, n_tokens bigint, ids binary")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wvm").load(folder).select("path", "content")
    held = files.mapInArrow(run, "shard bigint, doc_id bigint, inside bigint, n_tokens bigint, ids binary")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard
    at = shards.select("shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("_before"))
    return held.join(at, "shard").select("doc_id", (F.col("_before") + F.col("inside")).alias("start"), "n_tokens", "ids")
