"""Connected components by alternating star rounds, on DataFrames."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import written


def least_roots(edges: Iterable[tuple]) -> dict:
    """Node -> least node of its component, for edges that fit in memory."""
    parent: dict = {}

    def root(x):
        top = x
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for a, b in edges:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent}


def _contract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of each batch as stars around the least node of each of their components."""
    for batch in batches:
        roots = least_roots(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        pairs = [(x, r) for x, r in roots.items() if x != r]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in pairs], batch.schema.field(0).type),
                                          pa.array([r for _, r in pairs], batch.schema.field(0).type)], ["a", "b"])


def _kept(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges written and read back, and a mark that tells edge sets apart."""
    seen = Observation()
    marked = edges.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"))
    out = written(marked, "edges")
    return out, (seen.get["n"], seen.get["x"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected ``edges`` (a, b) that has another neighbour; root is the least node reachable.

    Batches of edges are contracted to stars first.  Then each round links
    nodes to the least of their neighbours, the larger neighbours before the
    smaller ones (Kiveris et al., 2014); the number of rounds grows with the
    logarithm of the graph.  A hot node's edges are joined to one row with its
    least neighbour, never gathered.
    """
    schema = edges.select("a", "b").schema
    now, seen = _kept(edges.where(F.col("a") != F.col("b")).select("a", "b").mapInArrow(_contract, schema).distinct())
    while seen[0]:
        both = now.union(now.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select("v", "m").union(least.select("u", "m")).toDF("a", "b")
        now, mark = _kept(small.where(F.col("a") != F.col("b")).distinct())
        if mark == seen:
            break
        seen = mark
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
