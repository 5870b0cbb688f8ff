"""JSON array documents read by byte ranges, so that one large document takes many tasks.

A file is cut into units of bytes.  A first pass counts, per unit, unescaped
quotes and brackets, the latter for both cases: the unit begins inside a string
or outside.  Prefix sums over a file's units (a row per unit) tell each unit
where it begins.  A second pass finds the elements: a unit emits those that
begin in it and reads on to the end of its last one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import scratch_path

#: Bytes of a unit, which one task reads, and of the blocks it reads them in.
UNIT_BYTES, BLOCK_BYTES = 64 << 20, 1 << 20


def _passes(block: int):
    """The two functions for ``mapInArrow``; they travel to the workers by value."""

    def opened(path: str):
        from urllib.parse import unquote

        from pyarrow import fs
        store, inner = fs.FileSystem.from_uri(path.replace(" ", "%20"))
        return store.open_input_file(unquote(inner) if "%" in inner else inner)

    def backslashes_before(file, at: int) -> int:
        """How many backslashes stand right before ``at``."""
        run, step = 0, 64
        while at:
            step = min(at, step * 2)
            file.seek(at - step)
            part = file.read(step)
            left = len(part.rstrip(b"\\"))
            run += step - left
            if left:
                break
            at -= step
        return run

    def quotes(b: np.ndarray, run: int) -> tuple[np.ndarray, int]:
        """(marks of unescaped quotes, backslashes at the end) where ``run`` backslashes stand before ``b``."""
        found = b == 34
        slash = b == 92
        if not run and not slash.any():
            return found, 0
        places = np.arange(len(b))
        other = np.maximum.accumulate(np.where(slash, -1, places))
        before = np.append(run, places - other + np.where(other < 0, run, 0))
        found &= before[:-1] % 2 == 0
        return found, int(before[-1])

    def blocks(file, start: int, end: int | None):
        """Bytes from ``start`` on, block by block, up to ``end`` or the end of the file."""
        while end is None or start < end:
            file.seek(start)
            part = file.read(block if end is None else min(block, end - start))
            if not part:
                return
            yield start, part
            start += len(part)

    def summaries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for path, unit, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                odd, outer, inner, first = 0, 0, 0, None
                with opened(path) as file:
                    run = backslashes_before(file, start)
                    for at, part in blocks(file, start, end):
                        b = np.frombuffer(part, np.uint8)
                        quote, run = quotes(b, run)
                        inside = (np.cumsum(quote) + odd) % 2 == 1
                        step = np.isin(b, (91, 123)).astype(np.int64) - np.isin(b, (93, 125))
                        outer, inner = outer + int(step[~inside].sum()), inner + int(step[inside].sum())
                        odd = (odd + int(quote.sum())) % 2
                        text = (part[3:] if at == 0 and part[:3] == b"\xef\xbb\xbf" else part).lstrip(b" \t\r\n")
                        if first is None and text:
                            first = text[0]
                out.append((path, unit, start, end, odd, outer, inner, first))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.string() if k == 0 else pa.int64()) for k, c in enumerate(zip(*out, strict=True))],
                ["file", "unit", "start", "end", "odd", "outer", "inner", "first"])

    def elements(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = np.isin(np.arange(256), list(b" \t\r\n,[]{}"))

        def found(path: str, start: int, end: int, odd: int, depth: int, base: int):
            """(offset, bytes) of the elements that begin in the range."""
            begun, parts = -1, []
            with opened(path) as file:
                run = backslashes_before(file, start)
                for at, part in blocks(file, start, None):
                    if at >= end and begun < 0:
                        return
                    b = np.frombuffer(part, np.uint8)
                    quote, run = quotes(b, run)
                    inside = (np.cumsum(quote) + odd) % 2 == 1
                    step = np.isin(b, (91, 123)).astype(np.int64) - np.isin(b, (93, 125))
                    step[inside] = 0
                    level = depth + np.cumsum(step)
                    strange = (level <= base) & ((~inside & ~plain[b]) | quote) | (level < 0)
                    strange |= (step > 0) & (level == base + 1) & (b != 123)
                    if at == 0 and part[:3] == b"\xef\xbb\xbf":
                        strange[:3] = False
                    wrong = np.flatnonzero(strange[:max(0, end - at)])
                    if len(wrong):
                        raise ValueError(f"{path}: no array of JSON objects at byte {at + int(wrong[0])}")
                    odd, depth = (odd + int(quote.sum())) % 2, int(level[-1])
                    edges = np.flatnonzero(((step > 0) & (level == base + 1)) | ((step < 0) & (level == base)))
                    for k in edges.tolist():
                        if step[k] > 0:
                            if at + k >= end:
                                return
                            begun, parts = at + k, []
                        elif begun >= 0 and b[k] == 125:
                            parts.append(part[max(begun - at, 0):k + 1])
                            yield begun, b"".join(parts)
                            begun, parts = -1, []
                    if begun >= 0:
                        parts.append(part[max(begun - at, 0):])
            if begun >= 0 or depth:
                raise ValueError(f"{path}: the JSON document ends too early")

        for batch in batches:
            for path, *unit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                offsets, values, size = [], [], 0

                def taken() -> pa.RecordBatch:
                    return pa.RecordBatch.from_arrays(
                        [pa.array([path] * len(offsets), pa.string()), pa.array(offsets, pa.int64()),  # noqa: B023
                         pa.array(values, pa.binary()).cast(pa.string())], ["file", "offset", "value"])  # noqa: B023

                for offset, value in found(path, *unit):
                    offsets.append(offset)
                    values.append(value)
                    size += len(value)
                    if size >= block:
                        yield taken()
                        offsets, values, size = [], [], 0
                if offsets:
                    yield taken()

    return summaries, elements


def json_array_elements(spark: SparkSession, path: str, unit_bytes: int = UNIT_BYTES,
                        block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(file, offset, value): the text of every element of the JSON arrays under ``path``.

    ``offset`` is the element's first byte in its file, so (file, offset) is
    the order of the elements.  Elements are objects, in UTF-8; a document that is one object
    is its own element.  Anything else between elements and a document
    that ends too early are errors.  Empty files and empty arrays have no rows.
    A task holds a block and one element.  The files must be open to ``pyarrow.fs``.
    """
    files = (spark.read.format("binaryFile").load(path).where(F.col("length") > 0)
             .select(F.col("path").alias("file"), F.col("length").cast("bigint").alias("length")))
    units = files.select("file", "length", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(
        f"(length - 1) div {unit_bytes}"))).alias("unit")).select(
        "file", "unit", (F.col("unit") * unit_bytes).alias("start"),
        F.least("length", (F.col("unit") + 1) * unit_bytes).alias("end"))
    n = max(1, min(units.count(), 100_000))  # a task per unit; beyond that several units a task
    summaries, elements = _passes(block_bytes)
    counted = units.repartition(n).mapInArrow(
        summaries, "file string, unit bigint, start bigint, end bigint, odd bigint, outer bigint, inner bigint, first bigint")
    before = Window.partitionBy("file").orderBy("unit").rowsBetween(Window.unboundedPreceding, -1)  # a row per unit
    whole = Window.partitionBy("file").orderBy("unit").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = (counted.withColumn("_in", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
              .withColumn("_step", F.when(F.col("_in") == 0, F.col("outer")).otherwise(F.col("inner")))
              .withColumn("_depth", F.coalesce(F.sum("_step").over(before), F.lit(0)))
              .withColumn("_base", F.when(F.first("first", ignorenulls=True).over(whole) == ord("["), 1).otherwise(0)))
    return (placed.select("file", "start", "end", "_in", "_depth", F.col("_base").cast("bigint"))
            .repartition(n).mapInArrow(elements, "file string, offset bigint, value string"))


def read_json_array_split(spark: SparkSession, path: str, schema: T.StructType | None = None,
                          place: tuple[str, str] | None = None, unit_bytes: int = UNIT_BYTES,
                          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of JSON array documents, read by as many tasks as there are units.

    Without a schema one pass writes the elements as JSON lines to the shared folder and infers it there.
    ``place`` names two columns for an element's file and offset.
    """
    found = json_array_elements(spark, path, unit_bytes, block_bytes)
    if schema is None:
        lines = scratch_path(spark, "json-elements")
        found.select(F.translate("value", "\r\n", "  ").alias("value")).write.text(lines)
        schema = spark.read.json(lines).schema
    if not schema:
        return found.select(*[F.col(c).alias(n) for c, n in zip(("file", "offset"), place or (), strict=False)])
    names = [F.col(c).alias(n) for c, n in zip(("file", "offset"), place, strict=True)] if place else []
    return found.select(*names, F.inline(F.array(F.from_json("value", schema))))  # parsed once a row
