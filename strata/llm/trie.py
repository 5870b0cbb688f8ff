"""Prefix trie of conversations as a Z-fast trie.

A conversation is the string of its turns (role, text).  A compacted trie keeps a
node where conversations part or end; a node whose edge runs from depth a to e is
found in a hash table at the prefix of its two-fattest depth in (a, e], the one
with most trailing zero bits.  The same depths, halved again and again, lead a
new conversation to its exit node in a logarithmic number of look-ups.

On Spark every prefix has a 128-bit hash.  Conversations first look for the depth
at which they leave the heavy top of the trie, the prefixes with more turns below
them than a task should hold; this is the same fat binary search, a join per
halving.  What hangs below the top is dealt to tasks, each of which
inserts its conversations in batches into a Z-fast trie of its own and then
expands the edges.  Figures of the top's nodes are summed over tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, written

#: Turns below a prefix beyond which it belongs to the shared top, and turns dealt to a task.
TASK_TURNS = 1 << 16
#: Conversations that look for their exit nodes before any of them is inserted.
BATCH = 512
#: Bits of an id within a row of ids.
ID_BITS = 16
HASH = 16


def fattest(a: int, b: int) -> int:
    """The number in (a, b] with the most trailing zero bits."""
    return b & (-1 << ((a ^ b).bit_length() - 1))


def fattest_column(a: str, b: str) -> Column:
    bits = f"length(bin({a} ^ {b})) - 1"
    return F.expr(f"shiftleft(shiftright({b}, {bits}), {bits})")


def turns_of(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """(conv_id, turns array<struct<key binary, size bigint>>) of every id, in ascending order of turn, null first.

    ``key`` has 128 bits of a hash of role and text, ``size`` is the text's length
    in bytes.  Null roles and texts are empty; turns of one number follow each
    other by their keys.  Rows without an id belong to no conversation.  The turns
    of one conversation, some 40 bytes each, are held by one task.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("conv_id"), F.struct(
            F.col(turn_col).cast("bigint").alias("turn"), F.unhex(F.substring(F.sha2(named, 256), 1, 2 * HASH)).alias("key"),
            F.octet_length(text).cast("bigint").alias("size")).alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t")).select(
        "conv_id", F.transform("t", lambda t: F.struct(t["key"].alias("key"), t["size"].alias("size"))).alias("turns"))


def chained(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, path binary, sizes): ``path`` holds the hashes of all prefixes, 16 bytes each."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, depths = [], []
            for keys in column(batch, "keys").to_pylist():
                at, path = b"", []
                for key in keys:
                    at = hashlib.blake2b(at + key, digest_size=HASH).digest()
                    path.append(at)
                paths.append(b"".join(path))
                depths.append(len(path))
            yield pa.RecordBatch.from_arrays([column(batch, "conv_id"), pa.array(depths, pa.int32()), pa.array(paths, pa.binary()),
                                              column(batch, "sizes")], ["conv_id", "depth", "path", "sizes"])

    return turns.select("conv_id", F.col("turns.key").alias("keys"), F.col("turns.size").alias("sizes")).mapInArrow(
        run, "conv_id bigint, depth int, path binary, sizes array<bigint>")


def prefix(depth: Column) -> Column:
    return F.substring("path", (depth - 1) * HASH + 1, HASH)


def ids_digest(members: DataFrame) -> DataFrame:
    """(end, ends_sha256): SHA-256 of each ``end``'s ids in ascending order, comma-joined.

    Ids are packed by ranges of 65,536; a task reads the rows of an ``end`` in
    order and keeps only the running hash, so no group is held.
    """
    packed = members.groupBy("end", F.shiftright("conv_id", ID_BITS).alias("range")).agg(
        F.sort_array(F.collect_list("conv_id")).alias("ids"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest = None, None
        for batch in batches:
            out = []
            for end, ids in zip(column(batch, "end").to_pylist(), column(batch, "ids").to_pylist(), strict=True):
                if end != at or digest is None:
                    if digest is not None:
                        out.append((at, digest.hexdigest()))
                    at, digest = end, hashlib.sha256()
                    digest.update(",".join(map(str, ids)).encode())
                else:
                    digest.update(("," + ",".join(map(str, ids))).encode())
            yield rows_of(out)
        if digest is not None:
            yield rows_of([(at, digest.hexdigest())])

    def rows_of(some: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([e for e, _ in some], pa.binary()), pa.array([d for _, d in some], pa.string())],
                                          ["end", "ends_sha256"])

    return packed.repartition("end").sortWithinPartitions("end", "range").mapInArrow(run, "end binary, ends_sha256 string")


def classes_of(paths: DataFrame) -> DataFrame:
    """A row per distinct conversation: end (its hash), depth, path, sizes, n, conv_id (the smallest) and ends_sha256."""
    ended = written(paths.withColumn("end", F.when(F.col("depth") == 0, F.lit(b"")).otherwise(prefix(F.col("depth")))), "trie-paths")
    same = ended.groupBy("end").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"),
                                    F.first("depth").alias("depth"), F.first("path").alias("path"), F.first("sizes").alias("sizes"))
    return written(same.join(ids_digest(ended.select("end", "conv_id")), "end"), "trie-classes")


def with_exits(classes: DataFrame, task_turns: int) -> DataFrame:
    """``classes`` with ``lo``, the depth of the deepest heavy prefix of each (0: none but the root).

    A prefix is heavy if it begins two different conversations at least whose turns
    are more than ``task_turns`` together; all shorter ones then are too.  So each
    conversation finds its exit by probing the heavy prefixes at two-fattest depths,
    a join per halving of its interval (lo, hi].  At any depth the heavy prefixes
    number less than all turns / ``task_turns``.
    """
    deepest, total = classes.agg(F.max("depth"), F.sum("depth")).first()
    state = classes.withColumns({"lo": F.lit(0), "hi": F.col("depth")})
    if (total or 0) <= task_turns:
        return state.drop("hi")
    every = classes.where("depth > 0").select("path", "depth", F.explode(F.sequence(F.lit(1), "depth")).alias("d"))
    heavy = written(every.select(prefix(F.col("d")).alias("at"), "depth").groupBy("at")
                    .agg(F.count(F.lit(1)).alias("k"), F.sum("depth").alias("w"))
                    .where((F.col("k") > 1) & (F.col("w") > task_turns)).select("at", F.lit(True).alias("heavy")), "trie-heavy")
    for _ in range(int(deepest).bit_length()):
        probed = state.withColumn("probe", F.when(F.col("lo") < F.col("hi"), fattest_column("lo", "hi")))
        joined = probed.withColumn("at", prefix(F.col("probe"))).join(heavy, "at", "left")
        found = F.coalesce("heavy", F.lit(False))
        state = joined.withColumns({
            "lo": F.when(found, F.col("probe")).otherwise(F.col("lo")),
            "hi": F.when(found | F.col("probe").isNull(), F.col("hi")).otherwise(F.col("probe") - 1)}).drop("probe", "at", "heavy")
    return written(state.drop("hi"), "trie-exits")


class ZFastTrie:
    """A compacted trie of paths (lists of prefix hashes), its nodes hashed at their two-fattest handles.

    Node v has the first ``extent[v]`` turns of path ``of[v]`` and hangs below
    ``parent[v]``; ``end[v]`` is the path that ends there, or -1.
    """

    def __init__(self, paths: list[list[bytes]]):
        self.paths = paths
        self.extent, self.of, self.parent, self.end = [0], [-1], [-1], [-1]
        self.below: list[dict[bytes, int]] = [{}]  # children by their first prefix
        self.handles: dict[bytes, int] = {}

    def handle(self, v: int) -> bytes:
        return self.paths[self.of[v]][fattest(self.extent[self.parent[v]], self.extent[v]) - 1]

    def locate(self, x: list[bytes], v: int = 0) -> int:
        """The node at or above whose extent ``x`` leaves the trie, from a node v on its way."""
        a, b = self.extent[v], len(x)
        while a < b:
            f = fattest(a, b)
            u = self.handles.get(x[f - 1])
            if u is None:
                b = f - 1
                continue
            e = self.extent[u]
            if e > len(x) or self.paths[self.of[u]][e - 1] != x[e - 1]:
                return u  # x leaves, or ends, within u's edge
            v, a = u, e
        if self.extent[v] < len(x):  # it may leave within an edge before the edge's handle
            return self.below[v].get(x[self.extent[v]], v)
        return v

    def node(self, extent: int, of: int, parent: int) -> int:
        v = len(self.extent)
        for cells, value in ((self.extent, extent), (self.of, of), (self.parent, parent), (self.end, -1), (self.below, {})):
            cells.append(value)
        self.below[parent][self.paths[of][self.extent[parent]]] = v
        self.handles[self.handle(v)] = v
        return v

    def split(self, v: int, depth: int) -> int:
        """A new node on v's edge at ``depth``."""
        del self.handles[self.handle(v)]
        u = self.node(depth, self.of[v], self.parent[v])
        self.parent[v] = u
        self.below[u][self.paths[self.of[v]][depth]] = v
        self.handles[self.handle(v)] = v
        return u

    def put(self, k: int, v: int) -> None:
        """Inserts path k, whose exit node is v."""
        x = self.paths[k]
        e = self.extent[v]
        if e > len(x) or (e and self.paths[self.of[v]][e - 1] != x[e - 1]):
            y = self.paths[self.of[v]]
            low, high = self.extent[self.parent[v]], min(e, len(x))
            while low < high:  # how many turns they share
                mid = (low + high + 1) // 2
                low, high = (mid, high) if x[mid - 1] == y[mid - 1] else (low, mid - 1)
            v = self.split(v, low)
        if self.extent[v] < len(x):
            v = self.node(len(x), k, v)
        self.end[v] = k

    def insert(self, batch: Iterable[int]) -> None:
        """Paths that are all different and new: all look for their exits, then each goes on from there."""
        batch = list(batch)
        exits = [self.locate(self.paths[k]) for k in batch]
        for k, v in zip(batch, exits, strict=True):
            # what the batch has inserted meanwhile lies below an ancestor of the exit node that x passes
            while self.extent[v] > len(self.paths[k]) or (v and self.paths[self.of[v]][self.extent[v] - 1] != self.paths[k][self.extent[v] - 1]):
                v = self.parent[v]
            self.put(k, self.locate(self.paths[k], v))


NODE = ("key binary, heavy boolean, conv_id bigint, depth bigint, parent_key binary, parent_conv_id bigint, n_convs bigint, "
        "n_children bigint, n_leaves bigint, passed decimal(38,0), distinct decimal(38,0), last bigint, ends_sha256 string")


def expanded(bucket: pa.Table) -> pa.Table:
    """The nodes of the trie of a table of classes: final figures below the top, a share of them within it.

    A subtree's saved bytes are those its conversations pass through from the
    node on (``passed``) without those of its distinct nodes (``distinct``).
    """
    rows = bucket.to_pydict()
    paths = [[p[k:k + HASH] for k in range(0, len(p), HASH)] for p in rows["path"]]
    order = sorted(range(len(paths)), key=lambda k: rows["path"][k])
    trie = ZFastTrie(paths)
    for at in range(0, len(order), BATCH):
        trie.insert(order[at:at + BATCH])
    nodes = len(trie.extent)
    n, first, lo = [0] * nodes, [None] * nodes, [0] * nodes
    leaves, passed, distinct, light = ([0] * nodes for _ in range(4))
    run = [np.append(0, np.cumsum(np.array(s, np.int64))).tolist() for s in rows["sizes"]]  # bytes of the first d turns
    out: dict[str, list] = {name.split()[0]: [] for name in NODE.split(", ")}

    def emit(*values) -> None:
        for cells, value in zip(out.values(), values, strict=True):
            cells.append(value)

    pending: list[tuple] = []  # rows whose parent's smallest id is told later
    for v in sorted(range(nodes), key=lambda v: -trie.extent[v]):
        k, e, up = trie.end[v], trie.extent[v], trie.parent[v]
        if k >= 0:
            n[v] += rows["n"][k]
            first[v] = min(x for x in (first[v], rows["conv_id"][k]) if x is not None)
            lo[v] = max(lo[v], rows["lo"][k])
        if first[v] is None:
            continue  # the root of a table without rows
        if not trie.below[v] and trie.extent[v] > lo[v]:  # a node of the top goes on elsewhere
            leaves[v] += 1
        path, total = (paths[trie.of[v]], run[trie.of[v]]) if v else ([], [0])
        begin = trie.extent[up] if v else -1
        for d in range(e, begin, -1):
            size = total[d] - total[d - 1] if d else 0
            heavy = d <= lo[v]
            passed[v] += n[v] * size
            # the top's own nodes are counted once for all tasks
            distinct[v] += 0 if heavy else size
            children = light[v] if heavy and d == e else len(trie.below[v]) if d == e else int(d + 1 > lo[v]) if heavy else 1
            parent = path[d - 2] if d > 1 else b"" if d else None
            row = [path[d - 1] if d else b"", heavy, first[v], d, parent, None, n[v], children, leaves[v], passed[v],
                   distinct[v], size, rows["ends_sha256"][k] if k >= 0 and d == e else None]
            if not heavy and d - 1 > lo[v]:
                row[4] = None
                if d - 1 > begin:
                    row[5] = first[v]
                else:
                    pending.append((len(out["key"]), up))
            emit(*row)
        if v:
            n[up] += n[v]
            first[up] = min(x for x in (first[up], first[v]) if x is not None)
            lo[up] = max(lo[up], min(lo[v], trie.extent[up]))
            leaves[up] += leaves[v]
            passed[up] += passed[v]
            distinct[up] += distinct[v]
            light[up] += begin + 1 > lo[v]
    for at, up in pending:
        out["parent_conv_id"][at] = first[up]
    types = {"binary": pa.binary(), "boolean": pa.bool_(), "bigint": pa.int64(), "string": pa.string(), "decimal(38,0)": pa.decimal128(38, 0)}
    spec = [f.rsplit(" ", 1) for f in NODE.split(", ")]
    return pa.table({name: pa.array(out[name], types[kind]) for name, kind in spec})


def prefix_nodes(turns: DataFrame, task_turns: int = TASK_TURNS) -> DataFrame:
    """The nodes of the trie of ``turns`` (conv_id, turns: see ``turns_of``), a row per distinct prefix of turns.

    conv_id is the smallest member, parent_conv_id the parent's (null for the
    root), n_convs the conversations that begin with the prefix, n_children and
    n_leaves its next prefixes and the childless nodes in its subtree (its top
    included), saved_tokens the sum over the subtree of (n_convs - 1) times the bytes
    of a node's last text, ends_sha256 the SHA-256 of the ids of the conversations that
    end there.  Conversations without turns end at the root.  An empty table has
    no nodes.  Each id is one conversation, so rows that repeat are turns of it.
    """
    classes = with_exits(classes_of(chained(turns)), task_turns)
    total = classes.agg(F.sum("depth")).first()[0] or 0
    tasks = max(1, -(-total // task_turns))
    # below the top, conversations that share a first prefix go to one task
    group = F.when(F.col("depth") > F.col("lo"), prefix(F.col("lo") + 1)).otherwise(F.col("end"))
    dealt = classes.select(F.pmod(F.xxhash64(group), F.lit(tasks)).alias("task"), "path", "sizes", "n", "conv_id", "lo", "ends_sha256")
    nodes = written(dealt.groupBy("task").applyInArrow(expanded, NODE), "trie-nodes")

    top = written(nodes.where("heavy").groupBy("key", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.first("parent_key").alias("parent_key"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("light"), F.sum("n_leaves").alias("n_leaves"), F.sum("passed").alias("passed"),
        F.sum("distinct").alias("distinct"), F.max("last").alias("last"), F.max("ends_sha256").alias("ends_sha256")), "trie-top")
    # the conversation that gives a node of the top its id counts the node's bytes, once, for it and all above it
    owned = top.where("depth > 0").groupBy("conv_id").agg(F.min("depth").alias("from"), F.max("depth").alias("to"))
    owners = classes.select("conv_id", "path", "sizes").join(owned, "conv_id")
    depths = owners.select("path", "sizes", "from", "to", F.explode(F.sequence(F.lit(0).cast("bigint"), "to")).alias("d"))
    summed = F.aggregate(F.slice("sizes", F.greatest("d", "from").cast("int"), (F.col("to") - F.greatest("d", "from") + 1).cast("int")),
                         F.lit(0).cast("decimal(38,0)"), lambda s, x: (s + x).cast("decimal(38,0)"))
    own = depths.select(F.when(F.col("d") == 0, F.lit(b"")).otherwise(prefix(F.col("d").cast("int"))).alias("key"), summed.alias("own"))
    own = own.groupBy("key").agg(F.sum("own").alias("own"))
    heavy_children = top.where("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("deep"))
    parents = top.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    saved = F.col("passed") - F.col("distinct")
    upper = (top.join(own, "key", "left").join(heavy_children, "key", "left")
             .select("conv_id", "depth", "parent_key", F.lit(None).cast("bigint").alias("parent_conv_id"), "n_convs",
                     (F.col("light") + F.coalesce("deep", F.lit(0))).alias("n_children"),
                     F.when(F.col("light") + F.coalesce("deep", F.lit(0)) == 0, 1).otherwise(F.col("n_leaves")).alias("n_leaves"),
                     (saved - F.coalesce("own", F.lit(0))).cast("bigint").alias("saved_tokens"), "ends_sha256"))
    lower = nodes.where(~F.col("heavy")).select("conv_id", "depth", "parent_key", "parent_conv_id", "n_convs", "n_children",
                                                "n_leaves", saved.cast("bigint").alias("saved_tokens"), "ends_sha256")
    nothing = hashlib.sha256().hexdigest()
    return upper.unionByName(lower).join(parents, "parent_key", "left").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "above").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))


def with_shared_heads(turns: DataFrame, family: int = 5, modulus: int = 9) -> DataFrame:
    """``turns`` with each conversation's head taken from its family's first one.

    Conversation c gets the first h turns of c - c % ``family`` (none if there is no
    such conversation) before its own turns after its first h, where h is the crc32
    of c in decimal, modulo ``modulus``.
    """
    heads = turns.where(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, modulus - 1).alias("head"))
    joined = turns.withColumn("base", F.col("conv_id") - F.col("conv_id") % family).join(heads, "base", "left")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % modulus).cast("int")
    joined = joined.withColumn("h", h)
    empty = F.slice("turns", 1, 0)
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return joined.select("conv_id", F.concat(F.coalesce(F.slice("head", F.lit(1), F.col("h")), empty), own).alias("turns"))
