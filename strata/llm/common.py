"""Helpers shared by the text operators: input frames, batches, word hashes, array packing."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path

#: Bytes of text handled at once inside a Python worker.
BATCH_BYTES = 8 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator works on, as (doc_id bigint, text string); others stay behind."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def fold(modulus: int, id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back, which cuts its lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bytes_of(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def give_back() -> None:
    """Returns memory that Arrow and the C library hold free to the system, where they can."""
    import ctypes
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(batches: Iterable[pa.RecordBatch], column: str = "text",
           most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about ``most`` bytes of ``column``, a row at least.

    What is free meanwhile goes back to the system, since workers outlive tasks.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        size = batch.column(batch.schema.get_field_index(column)).nbytes
        step = max(1, batch.num_rows * most // max(size, 1))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)
        del batch
        give_back()


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser for 64-bit hashes."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_hashes(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh3_64_intdigest
    return np.fromiter(map(xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def rolling(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every ``n`` consecutive entries; shorter input gives none."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    m = len(hashes) - n + 1
    out = mix(hashes[:m] + np.uint64(n))
    for k in range(1, n):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[k:m + k])
    return out


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions starts[i] .. starts[i]+lengths[i]-1 for every i, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def kept(kind: str, key: object, make):
    """``make()``, kept in a Python worker for its later tasks, one of each kind.

    Only for what any task with this key would make alike, such as a tokenizer's tables.
    """
    import sys
    from types import ModuleType
    home = sys.modules.setdefault("_strata_kept", ModuleType("_strata_kept")).__dict__
    if home.get(kind, (None,))[0] != key:
        home[kind] = key, make()
    return home[kind][1]


def text_buffer(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, n + 1 offsets into them) of a string or binary array, without copying; nulls are empty."""
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32, len(array) + 1 + array.offset)[array.offset:]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[at[0]:at[-1]], at.astype(np.int64) - at[0]


def label_per_document(labels: DataFrame, label: str, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, label 0/1), a row per labelled id; of contradicting labels the majority holds, 1 at a tie."""
    return (labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull())
            .groupBy(F.col(id_col).cast("bigint").alias("doc_id"))
            .agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias("label")))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held: int,
                    rows: int) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, text, label) of at most ``rows`` training documents of each label, and how many each label has.

    Training documents are those whose fold is not ``held``.  The sample is the
    documents with the smallest hashes of their ids, so it is the same at every
    run.  Of rows that share an id the smallest text counts.
    """
    known = label_per_document(labels, label).where(fold(modulus) != held)
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    picked = [known.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for k in sorted(sizes)]
    if not picked:
        return docs.select("doc_id", "text", F.lit(0).alias("label")).limit(0), sizes
    some = picked[0]
    for more in picked[1:]:
        some = some.unionByName(more)
    # a row per picked id on this side: its size is bounded by ``rows``
    found = docs.join(F.broadcast(some), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    return found.select("doc_id", "text", "label"), sizes
