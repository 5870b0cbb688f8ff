"""N-gram Jaccard join by count-vector R-trees.

Two documents link when their sets of word shingles have a Jaccard similarity
of at least ``percent`` hundredths.  Every shingle is hashed into one of
``GROUPS`` groups; a document's counts by group are a point, and the overlap of
two documents is at most the sum over the groups of the smaller count.  Points
are packed into an R-tree whose boxes bound the overlap of all points inside,
and only pairs that no bound excludes are verified on their full sets.

Hashed counts of unrelated documents differ too little for one tree over the
whole corpus to exclude much, so trees are built inside clusters that no link
can cross.  They come from three exact steps: a document with too few shingles
found elsewhere links with nothing; equal sets become one class; and of two
classes that link, the prefixes (the rarest shingles, few enough that the rest
cannot reach the threshold) share a shingle.  Inside a cluster classes already
connected are not compared again, so a group of copies costs a comparison each,
not one per pair.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bytes_of, column, mix, rolling, slices, texts, word_hashes, written
from .graph import components, least_roots

#: Groups of the count vectors, children of an R-tree node.
GROUPS, FANOUT = 64, 16
#: Shingles that one counting task holds; classes of one cluster, and
#: bytes of their sets, that one join task holds of either side.
BUCKET_SHINGLES, TASK_CLASSES, TASK_BYTES = 1 << 20, 1500, 24 << 20
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingles(text: str | None, k: int = 5) -> np.ndarray:
    """Sorted hashes of the distinct ``k``-word shingles; a shorter text is one, a text without words none."""
    words = bytes_of(text).translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = word_hashes(words)
    return np.unique(rolling(hashes, k) if len(words) >= k else rolling(hashes, len(words)))


def by_bucket(tokens: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(order of the tokens by bucket, bounds of the buckets in that order)."""
    bucket = ((tokens >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, np.append(0, np.cumsum(np.bincount(bucket, minlength=buckets)))


EXCHANGE = "bucket int, part int, seq int, kind int, data binary, more binary"


def _exchange_rows(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    names = ["bucket", "part", "seq", "kind", "data", "more"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def _ask_shared(k: int, buckets: int):
    """A batch of texts: its shingles dealt to the buckets, and one row with what is known of its documents."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from xxhash import xxh3_128_digest
        part = TaskContext.get().partitionId()
        for seq, batch in enumerate(slices(batches, most=3 << 20)):
            sets = [shingles(t, k) for t in column(batch, "text").to_pylist()]
            size = np.fromiter(map(len, sets), np.int64, len(sets))
            tokens, doc = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
            order, at = by_bucket(tokens, buckets)
            low, doc = (tokens & np.uint64(0xFFFFFFFF)).astype("<u4")[order], doc[order]
            rows = []
            for b in range(buckets):
                if at[b + 1] > at[b]:
                    counts = np.bincount(doc[at[b]:at[b + 1]], minlength=len(sets)).astype("<u4")
                    rows.append((b, part, seq, 1, low[at[b]:at[b + 1]].tobytes(), counts.tobytes()))
            ids = pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), pa.array(size), pa.array([xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())],
                ["doc_id", "n", "class"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, ids.schema) as out:
                out.write_batch(ids)
            rows.append(((part * 31 + seq) % buckets, part, seq, 0, sink.getvalue().to_pybytes(), None))
            yield _exchange_rows(rows)

    return run


def _tell_shared(table: pa.Table) -> pa.Table:
    """Of one bucket: for every batch and document, how many of its shingles here occur twice or more."""
    asked = [r for r in table.to_pylist()]
    tokens = [np.frombuffer(r["data"], "<u4") for r in asked if r["kind"] == 1]
    rows = [(r["bucket"], r["part"], r["seq"], 0, r["data"], None) for r in asked if r["kind"] == 0]
    if tokens:
        _, at, count = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
        twice, begin = np.append(0, np.cumsum(count[at] > 1)), 0
        for r in asked:
            if r["kind"] == 1:
                ends = begin + np.cumsum(np.frombuffer(r["more"], "<u4").astype(np.int64))
                shared = np.diff(twice[np.append(begin, ends)]).astype("<u4")
                rows.append((r["bucket"], r["part"], r["seq"], 1, shared.tobytes(), None))
                begin = int(ends[-1])
    return pa.Table.from_batches([_exchange_rows(rows)])


def _sum_shared(table: pa.Table) -> pa.Table:
    """Of one batch: its documents with the number of their shared shingles."""
    ids, total = None, 0
    for r in table.to_pylist():
        if r["kind"] == 0:
            ids = pa.ipc.open_stream(r["data"]).read_all()
        else:
            total = total + np.frombuffer(r["data"], "<u4").astype(np.int64)
    total = np.zeros(ids.num_rows, np.int64) + total
    return ids.append_column("shared", pa.array(total, pa.int64())).combine_chunks()


def document_sets(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n, class, shared): size and hash of every document's set, and its shingles that occur elsewhere too.

    ``shared`` may count a few too many (32 bits of a hash inside a bucket), never too few.
    """
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = int(max(16, size // 7 // BUCKET_SHINGLES + 1))
    asked = docs.mapInArrow(_ask_shared(k, buckets), EXCHANGE)
    told = asked.groupBy("bucket").applyInArrow(_tell_shared, EXCHANGE)
    return told.groupBy("part", "seq").applyInArrow(_sum_shared, "doc_id bigint, n bigint, class binary, shared bigint")


def _sets(k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest
        for batch in slices(batches, most=4 << 20):
            sets = [shingles(t, k).tobytes() for t in column(batch, "text").to_pylist()]
            same = [xxh3_128_digest(s) == c for s, c in zip(sets, column(batch, "class").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([column(batch, "class"), pa.array(sets, pa.binary())],
                                             ["class", "tokens"]).filter(pa.array(same))
    return run


def _ask_counts(buckets: int):
    """A batch of classes: their shingles dealt to the buckets, and the batch itself."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        for seq, batch in enumerate(slices(batches, "tokens", 8 << 20)):
            tokens = np.concatenate([np.frombuffer(b, np.uint64) for b in column(batch, "tokens").to_pylist()])
            order, at = by_bucket(tokens, buckets)
            low = (tokens & np.uint64(0xFFFFFFFF)).astype("<u4")[order]
            rows = [(b, part, seq, 1, low[at[b]:at[b + 1]].tobytes(), None) for b in range(buckets) if at[b + 1] > at[b]]
            plain = pa.RecordBatch.from_arrays([pa.array(c.to_pylist(), c.type) for c in batch.columns], batch.schema.names)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, plain.schema) as out:
                out.write_batch(plain)
            rows.append(((part * 31 + seq) % buckets, part, seq, 0, sink.getvalue().to_pybytes(), None))
            yield _exchange_rows(rows)

    return run


def _tell_counts(table: pa.Table) -> pa.Table:
    asked = table.to_pylist()
    tokens = [np.frombuffer(r["data"], "<u4") for r in asked if r["kind"] == 1]
    rows = [(r["bucket"], r["part"], r["seq"], 0, r["data"], None) for r in asked if r["kind"] == 0]
    if tokens:
        _, at, count = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
        told, begin = count[at].astype("<u4"), 0
        for r in asked:
            if r["kind"] == 1:
                end = begin + len(r["data"]) // 4
                rows.append((r["bucket"], r["part"], r["seq"], 1, told[begin:end].tobytes(), None))
                begin = end
    return pa.Table.from_batches([_exchange_rows(rows)])


def _prefixes(percent: int, buckets: int):
    """Of one batch: (token, class) of each class's prefix, less the shingles that no other class has."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: (r["kind"], r["bucket"]))
        batch = pa.ipc.open_stream(rows[0]["data"]).read_all()
        sets = [np.frombuffer(b, np.uint64) for b in batch["tokens"].to_pylist()]
        order, _ = by_bucket(np.concatenate(sets), buckets)
        counts = np.empty(len(order), np.int64)
        counts[order] = np.concatenate([np.frombuffer(r["data"], "<u4") for r in rows[1:]])
        token, owner, begin = [], [], 0
        for c, s in zip(batch["class"].to_pylist(), sets, strict=True):
            count, n = counts[begin:begin + len(s)], len(s)
            begin += n
            least = -(-percent * n // 100)  # a partner shares so many of these shingles
            rare = np.lexsort((s, count))[:n - least + 1]
            rare = rare[count[rare] > 1]
            token.append(s[rare].view(np.int64))
            owner += [c] * len(rare)
        return pa.table({"token": pa.array(np.concatenate(token), pa.int64()), "class": pa.array(owner, pa.binary())})

    return run


def points(sets: list[np.ndarray]) -> np.ndarray:
    """Counts of each set by group."""
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    group = (mix(np.concatenate(sets)) % np.uint64(GROUPS)).astype(np.int64)
    flat = np.bincount(np.repeat(np.arange(len(sets)) * GROUPS, size) + group, minlength=len(sets) * GROUPS)
    return flat.reshape(len(sets), GROUPS).astype(np.int32)


class RTree:
    """Packed R-tree over count vectors; boxes keep each group's largest count and the sets' smallest and largest size.

    The smaller sides of the boxes would not tighten the bound, which only
    grows with the coordinates, so they are not stored.
    """

    def __init__(self, vectors: np.ndarray, sizes: np.ndarray):
        self.levels = [(vectors, sizes, sizes)]  # the leaves' entries first
        while len(self.levels[-1][0]) > FANOUT:
            top, small, large = self.levels[-1]
            starts = np.arange(0, len(top), FANOUT)
            self.levels.append((np.maximum.reduceat(top, starts), np.minimum.reduceat(small, starts),
                                np.maximum.reduceat(large, starts)))

    def search(self, vector: np.ndarray, size: int, percent: int) -> np.ndarray:
        """Entries that may reach the threshold with this point."""
        at = np.arange(len(self.levels[-1][0]))
        for level in range(len(self.levels) - 1, -1, -1):
            top, small, large = self.levels[level]
            at = at[(100 * large[at] >= percent * size) & (percent * small[at] <= 100 * size)]
            bound = np.minimum(top[at], vector).sum(axis=1)
            # an overlap o of sizes a and b links when 100 o >= percent (a + b - o)
            at = at[(100 + percent) * bound >= percent * (size + small[at])]
            if level:
                at = (at[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                at = at[at < len(self.levels[level - 1][0])]
        return at


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def join_sets(sets: list[np.ndarray], side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that connect the same sets as all links do between side 0 and side 1, and inside side 2."""
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    order = np.lexsort((size, [s[0] for s in sets]))  # sets that share much often share their least hash
    vectors = points(sets)
    trees = {}
    for s in (0, 1, 2):
        rows = order[side[order] == s]
        if len(rows):
            trees[s] = rows, RTree(vectors[rows], size[rows])
    group = np.arange(len(sets))  # connected sets have the same

    links = []
    for here, there in ((0, 1), (2, 2)):
        if here not in trees or there not in trees:
            continue
        rows, tree = trees[there]
        for place, x in enumerate(trees[here][0]):
            near = tree.search(vectors[x], size[x], percent)
            if here == there:
                near = near[near < place][::-1]
            near = rows[near]
            near = near[group[near] != group[x]]
            while len(near):
                y, near = near[0], near[1:]
                if linked(sets[x], sets[y], percent):
                    links.append((int(x), int(y)))
                    group[group == group[y]] = group[x]
                    near = near[group[near] != group[x]]
    return links


def _join(percent: int):
    """Of one task: its linked classes as stars around the least. Side 2: all with all; else side 0 with side 1."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        sets = [np.frombuffer(b, np.uint64) for b in table["tokens"].to_pylist()]
        names = table["class"].to_pylist()
        links = join_sets(sets, table["side"].to_numpy(), percent) if len(sets) > 1 else []
        stars = [(x, r) for x, r in least_roots([(names[x], names[y]) for x, y in links]).items() if x != r]
        return pa.table({"a": pa.array([x for x, _ in stars], pa.binary()), "b": pa.array([r for _, r in stars], pa.binary())})

    return run


def near_components(docs: DataFrame, percent: int = 75, k: int = 5, id_col: str = "doc_id", text_col: str = "text",
                    task_classes: int = TASK_CLASSES) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document: component_id is the least id reachable by links.

    Null and empty texts and texts without words have no shingles and link with
    nothing.  Rows without an id link with nothing and have no component.  Rows
    that share an id are a document each, linked by their own texts.
    """
    rows = texts(docs, id_col, text_col)
    found = written(document_sets(rows, k), "near-documents")
    alive = found.where(F.col("doc_id").isNotNull() & (F.col("n") > 0) & (100 * F.col("shared") >= percent * F.col("n")))
    reps = alive.groupBy("class").agg(F.min("doc_id").alias("doc_id"))
    classes = written(rows.join(reps, "doc_id").select("class", "text").mapInArrow(_sets(k), "class binary, tokens binary")
                      .dropDuplicates(["class"]), "near-classes")
    size = classes.agg(F.coalesce(F.sum(F.octet_length("tokens")), F.lit(0))).first()[0]
    buckets = int(max(16, size // 8 // BUCKET_SHINGLES + 1))
    prefixes = written(classes.mapInArrow(_ask_counts(buckets), EXCHANGE).groupBy("bucket").applyInArrow(_tell_counts, EXCHANGE)
                       .groupBy("part", "seq").applyInArrow(_prefixes(percent, buckets), "token bigint, class binary"), "near-prefixes")

    # clusters: classes joined by any chain of shared prefix shingles
    centres = prefixes.groupBy("token").agg(F.min("class").alias("b"), F.count(F.lit(1)).alias("_k")).where(F.col("_k") > 1)
    chains = components(prefixes.join(centres, "token").select(F.col("class").alias("a"), "b").distinct())
    sized = written(classes.join(chains.withColumnsRenamed({"node": "class", "root": "cluster"}), "class")
                    .select("class", "cluster", F.octet_length("tokens").alias("_n"), "tokens"), "near-clusters")

    # a cluster of more classes or bytes than a task takes is cut by size into chunks, and chunks are paired
    by_size = Window.partitionBy("cluster").orderBy("_n", "class")
    ranks = sized.select("class", "cluster", "_n").withColumn("chunk", F.floor(F.greatest(
        (F.row_number().over(by_size) - 1) / task_classes, (F.sum("_n").over(by_size) - F.col("_n")) / TASK_BYTES)))
    chunks = ranks.groupBy("cluster", "chunk").agg(F.min("_n").alias("_least"), F.max("_n").alias("_most"))
    right = chunks.select("cluster", F.col("chunk").alias("j"), F.col("_least").alias("_least_j"), F.col("_most").alias("_most_j"))
    pairs = (chunks.withColumnRenamed("chunk", "i").join(right, "cluster")
             .where((F.col("i") <= F.col("j")) & (100 * F.col("_most") >= percent * F.col("_least_j"))))
    # each chunk as the left, as the right, or as both sides of a task
    sides = pairs.select("cluster", "i", "j", F.explode(F.when(F.col("i") == F.col("j"), F.array(F.struct(F.col("i").alias("chunk"), F.lit(2).alias("side"))))
                         .otherwise(F.array(F.struct(F.col("i").alias("chunk"), F.lit(0).alias("side")),
                                            F.struct(F.col("j").alias("chunk"), F.lit(1).alias("side"))))).alias("_s")
                         ).select("cluster", "i", "j", "_s.chunk", "_s.side")
    tasks = (ranks.select("class", "cluster", "chunk").join(sides, ["cluster", "chunk"])
             .join(sized.select("class", "tokens"), "class").select("cluster", "i", "j", "side", "class", "tokens"))
    links = tasks.groupBy("cluster", "i", "j").applyInArrow(_join(percent), "a binary, b binary")
    groups = components(links).withColumnsRenamed({"node": "class", "root": "_root"})

    member = written(alive.select("doc_id", "class").join(groups, "class", "left").select(
        "doc_id", "class", F.coalesce("_root", "class").alias("_root")), "near-members")
    least = member.groupBy("_root").agg(F.min("doc_id").alias("component_id"))
    of_class = member.select("class", "_root").distinct().join(least, "_root").select("class", "component_id")
    return found.join(of_class, "class", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
