"""Approximate nearest neighbours by a hash-prefix forest.

Vectors are hashed to long bit strings, one per tree, by random hyperplanes; a
tree is the sorted array of its strings.  A query descends each tree to its
longest-prefix matches, an interval of the array, and then all trees ascend
together, a bit at a time, until the intervals hold enough candidates.
Candidates are scored on the original vectors.

Rows are dealt into blocks with a forest each, and every query visits every
block; the best of each block meet at the end.  How many candidates are enough
is measured: a bounded sample of queries is answered exactly, and the forests
ascend as far as those answers need.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import column, written

TREES, BITS = 24, 32
#: Rows of a block, queries of one task.
BLOCK_ROWS, TASK_QUERIES = 8192, 1024
#: Queries answered exactly to learn how far to ascend, and the part of their answers that must be reached.
SAMPLE_QUERIES, SAMPLE_RECALL = 192, 0.96


class Forest:
    """Sorted strings of one block. Vectors get a coordinate that makes their lengths equal, so that hashing ranks inner products."""

    def __init__(self, vectors: np.ndarray, longest: float, seed: int = 11):
        self.vectors = vectors
        rng = np.random.default_rng(seed)
        self.planes = rng.standard_normal((vectors.shape[1] + 1, TREES * BITS))
        x = vectors / longest
        x = np.concatenate([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1, keepdims=True)))], axis=1)
        strings = self.strings(x)
        self.order = np.argsort(strings, axis=1, kind="stable")
        self.sorted = np.take_along_axis(strings, self.order, axis=1)

    def strings(self, x: np.ndarray) -> np.ndarray:
        bits = (x @ self.planes > 0).reshape(len(x), TREES, BITS)
        weight = (np.uint64(1) << np.arange(BITS - 1, -1, -1, dtype=np.uint64))
        return (bits * weight).sum(axis=2, dtype=np.uint64).T.copy()

    def intervals(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end of the interval of every query in every tree by prefix length: [BITS + 1, TREES, queries]."""
        q = queries / np.linalg.norm(queries, axis=1, keepdims=True)
        strings = self.strings(np.concatenate([q, np.zeros((len(q), 1))], axis=1))
        low, high = np.empty((2, BITS + 1, TREES, len(q)), np.int64)
        for t in range(TREES):
            for length in range(BITS + 1):
                free = np.uint64(BITS - length)
                floor = strings[t] >> free << free
                low[length, t] = np.searchsorted(self.sorted[t], floor, "left")
                high[length, t] = np.searchsorted(self.sorted[t], floor + (np.uint64(1) << free) - np.uint64(1), "right")
        return low, high

    def steps(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Candidates held after each step of the ascent (a tree up by one bit), trees counted apart: [step, queries]."""
        size = (high - low)[::-1]  # the longest prefixes first
        gain = np.diff(size, axis=0).reshape(-1, size.shape[2])
        return size[0].sum(axis=0) + np.concatenate([np.zeros((1, size.shape[2]), np.int64), np.cumsum(gain, axis=0)])

    def candidates(self, low, high, step: int, query: int) -> np.ndarray:
        """Rows in the query's intervals after ``step`` steps."""
        up, trees = divmod(step, TREES)
        mark = np.zeros(len(self.vectors), bool)
        for t in range(TREES):
            length = BITS - up - (t < trees)
            mark[self.order[t, low[length, t, query]:high[length, t, query]]] = True
        return np.flatnonzero(mark)


def usable(vector: Column) -> Column:
    """Not null, without null or non-finite components, not zero."""
    x = F.transform(vector, lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(x, lambda v: v != 0)


def matrix(array: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(array.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dims)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= edge)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some]))[:k]]


FOUND = "query_id bigint, vec_id bigint, score double"


def _found(query, ids, scores) -> pa.Table:
    return pa.table({"query_id": pa.array(query, pa.int64()), "vec_id": pa.array(ids, pa.int64()), "score": pa.array(scores, pa.float64())})


def dot(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products summed in the same order for every row, so that equal vectors have equal scores."""
    return np.einsum("ij,j->i", rows, query)


def _exact(dims: int, k: int):
    """The k nearest of a block by comparing all, for the sample of queries."""

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not rows.num_rows or not queries.num_rows:
            return _found([], [], [])
        ids, x = rows["vec_id"].to_numpy(), matrix(rows["v"].combine_chunks(), dims)
        out = ([], [], [])
        for q, v in zip(queries["vec_id"].to_pylist(), matrix(queries["v"].combine_chunks(), dims), strict=True):
            scores = np.where(ids == q, -np.inf, dot(x, v))
            some = [i for i in best(ids, scores, k) if ids[i] != q]
            out[0].extend([q] * len(some))
            out[1].extend(ids[some])
            out[2].extend(scores[some])
        return _found(*out)

    return run


def _needed(dims: int, longest: float):
    """For each exact neighbour in this block, the share of its strings that the ascent holds when it is first met."""

    def run(rows: pa.Table, wanted: pa.Table) -> pa.Table:
        out: list[float] = []
        if rows.num_rows and wanted.num_rows:
            ids = rows["vec_id"].to_numpy()
            forest = Forest(matrix(rows["v"].combine_chunks(), dims), longest)
            place = {i: k for k, i in enumerate(ids.tolist())}
            rank = np.empty_like(forest.order)
            np.put_along_axis(rank, forest.order, np.arange(len(ids))[None, :], axis=1)
            queries = matrix(wanted["v"].combine_chunks(), dims)
            low, high = forest.intervals(queries)
            held = forest.steps(low, high)
            for q, neighbours in enumerate(wanted["near"].to_pylist()):
                for i in neighbours:
                    if (k := place.get(i)) is None:
                        continue
                    at = rank[:, k]
                    inside = (low[:, :, q] <= at) & (at < high[:, :, q])
                    longest_match = inside.sum(axis=0) - 1  # intervals are nested
                    step = min((BITS - m) * TREES - (TREES - 1 - t) if m < BITS else 0 for t, m in enumerate(longest_match.tolist()))
                    out.append(held[step, q] / (len(ids) * TREES))
        return pa.table({"share": pa.array(out, pa.float64())})

    return run


def _search(dims: int, k: int, longest: float, share: float):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not rows.num_rows or not queries.num_rows:
            return _found([], [], [])
        ids = rows["vec_id"].to_numpy()
        forest = Forest(matrix(rows["v"].combine_chunks(), dims), longest)
        names, vectors = queries["vec_id"].to_numpy(), matrix(queries["v"].combine_chunks(), dims)
        out = ([], [], [])
        for begin in range(0, len(names), 128):
            some = vectors[begin:begin + 128]
            low, high = forest.intervals(some)
            held = forest.steps(low, high)
            enough = np.minimum((held < max(share * len(ids) * TREES, 2 * k)).sum(axis=0), len(held) - 1)
            for q, step in enumerate(enough.tolist()):
                name = names[begin + q]
                near = forest.candidates(low, high, step, q)
                near = near[ids[near] != name]
                scores = dot(forest.vectors[near], some[q])
                top = best(ids[near], scores, k)
                out[0].extend([name] * len(top))
                out[1].extend(ids[near[top]])
                out[2].extend(scores[top])
        return _found(*out)

    return run


def _norms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    top = 0.0
    for batch in batches:
        for v in column(batch, "v").to_pylist():
            top = max(top, float(np.linalg.norm(np.array(v))))
    yield pa.RecordBatch.from_pydict({"norm": pa.array([top])})


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
            block_rows: int = BLOCK_ROWS, task_queries: int = TASK_QUERIES, sample_queries: int = SAMPLE_QUERIES,
            sample_recall: float = SAMPLE_RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for every row where ``is_query`` holds.

    Nearest by inner product, in double precision; ties to the smaller id.  A
    row is never its own neighbour, nor is another row of the same id.  Rows
    without an id and vectors that are null, zero or hold null or non-finite
    components take no part, nor do vectors of another length than most have
    (the largest of equally frequent lengths).  Of rows that share an id and a
    vector one counts.  All rows are indexed; ``sample_queries`` bounds only what
    the depth of the search is learned from.
    """
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("_v"), is_query.alias("is_query"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("_v")))
    rows = rows.select("vec_id", F.transform("_v", lambda x: x.cast("double")).alias("v"), "is_query")
    common = rows.groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    if common is None:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    dims = common["dims"]
    rows = written(rows.where(F.size("v") == dims).dropDuplicates(["vec_id", "v"]), "vectors")
    n = rows.count()
    longest = rows.select("v").mapInArrow(_norms, "norm double").agg(F.max("norm")).first()[0]
    blocks = max(1, -(-n // block_rows))
    index = rows.select("vec_id", "v", F.pmod(F.xxhash64("vec_id", F.lit("block")), F.lit(blocks)).cast("int").alias("block"))
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    queries = rows.where("is_query").select("vec_id", "v")

    sample = queries.orderBy(F.xxhash64("vec_id", F.lit("sample")), "vec_id").limit(sample_queries)
    sample = written(sample, "sample-queries")
    top = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    exact = (index.groupBy("block").cogroup(sample.select("vec_id", "v", every).groupBy("block")).applyInArrow(_exact(dims, k), FOUND)
             .withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= k)
             .groupBy("query_id").agg(F.collect_list("vec_id").alias("near")))
    wanted = sample.join(exact, sample["vec_id"] == exact["query_id"]).select("v", "near", every)
    shares = [r.share for r in index.groupBy("block").cogroup(wanted.groupBy("block"))
              .applyInArrow(_needed(dims, longest), "share double").collect()]  # sample_queries * k at most
    share = float(np.quantile(shares, sample_recall)) if shares else 1.0

    # a block meets the queries in portions, each a task
    portions = max(1, -(-queries.count() // task_queries))
    asked = queries.select("vec_id", "v", F.pmod(F.xxhash64("vec_id", F.lit("portion")), F.lit(portions)).cast("int").alias("portion"), every)
    held = index.select("vec_id", "v", "block", F.explode(F.sequence(F.lit(0), F.lit(portions - 1))).alias("portion"))
    found = held.groupBy("block", "portion").cogroup(asked.groupBy("block", "portion")).applyInArrow(_search(dims, k, longest, share), FOUND)
    return (found.withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
