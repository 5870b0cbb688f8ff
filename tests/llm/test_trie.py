"""The conversation trie against a dictionary of all prefixes."""

import hashlib
import math
import random
import zlib

import pytest

from strata.llm import trie as T

SCHEMA = "conv_id bigint, turn bigint, role string, text string, n_convs string, key string, depth string, lo string"


def frame(spark, rows):
    return spark.createDataFrame([(c, t, r, x, "a", "b", "c", "d") for c, t, r, x in rows], SCHEMA)


def rebuilt(rows):
    own = {}
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            key = hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).hexdigest()
            own.setdefault(c, []).append((t is not None, t or 0, key, r, x))
    own = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = tuple(own.get(c - int(math.fmod(c, 5)), [])[:h] + v[h:])  # the remainder has c's sign, as in SQL
    return out


def brute(seqs):
    nodes = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            nodes.setdefault(s[:d], []).append(c)
    children, below, out = {}, {}, []
    for q in nodes:
        if q:
            children.setdefault(q[:-1], []).append(q)
        for d in range(len(q) + 1):
            below.setdefault(q[:d], []).append(q)
    for p, members in nodes.items():
        leaves = sum(q not in children for q in below[p])
        saved = sum((len(nodes[q]) - 1) * len(q[-1][1].encode()) for q in below[p] if q)
        ends = ",".join(map(str, sorted(c for c in members if len(seqs[c]) == len(p))))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(children.get(p, [])), leaves, saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def awkward():
    rng = random.Random(8)
    rows = []
    for c in range(60):
        for t in range(rng.randrange(1, 9)):
            rows.append((c, rng.choice([t, t, t, None, 3]), rng.choice(["user", "assistant", None]), rng.choice(["", None, "hi", "ça va", "ok"])))
    rows += [(c, t, "user", f"turn {t}") for c in range(100, 140) for t in range(6)]  # copies
    rows += [(200, t, "user", str(t)) for t in range(120)] + [(201, t, "user", str(t)) for t in range(110)]  # long ones
    rows += [(c, 0, "user", "the same first turn") for c in range(300, 330)] + [(c, 1, "user", f"other {c}") for c in range(300, 330)]
    rows += [(None, 0, "user", "nobody"), (7, 0, "user", "hi"), (7, 0, "user", "hi"), (-3, 0, None, None)]
    return rows


@pytest.mark.parametrize("task_turns", [1 << 16, 300, 20, 1])
def test_nodes(spark, task_turns):
    rows = awkward()
    got = T.prefix_nodes(T.with_shared_heads(T.turns_of(frame(spark, rows))), task_turns)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rebuilt(rows))


def test_without_conversations_and_without_turns(spark):
    assert T.prefix_nodes(T.with_shared_heads(T.turns_of(frame(spark, [])))).collect() == []
    # conversation 5 ends before its own turns begin: h is 8, and it has one turn
    alone = [(c, 0, "u", "x") for c in range(1, 40) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 0]
    got = T.prefix_nodes(T.with_shared_heads(T.turns_of(frame(spark, alone))))
    assert sorted(map(tuple, got.collect()), key=str) == brute(rebuilt(alone))


def test_batches_and_fat_search():
    rng = random.Random(5)
    for _ in range(60):
        seqs = list({tuple(rng.choice("abc") for _ in range(rng.randrange(12))) for _ in range(40)})
        paths = [[hashlib.blake2b(repr(s[:d + 1]).encode(), digest_size=16).digest() for d in range(len(s))] for s in seqs]
        t = T.ZFastTrie(paths)
        step = rng.choice([1, 5, 100])
        for at in range(0, len(paths), step):
            t.insert(range(at, min(at + step, len(paths))))
        for k, path in enumerate(paths):
            v = t.locate(path)
            assert t.extent[v] == len(path) and t.end[v] == k
        for v in range(1, len(t.extent)):
            assert t.handles[t.handle(v)] == v and (t.end[v] >= 0 or len(t.below[v]) > 1)
        assert len(t.handles) == len(t.extent) - 1


def test_ids_over_several_rows_are_hashed_in_order(spark):
    from pyspark.sql import functions as F
    ids = [*range(-70000, 70000, 7)]
    some = spark.createDataFrame([(i,) for i in reversed(ids)], "conv_id bigint").withColumn("end", F.lit(b"e"))
    assert T.ids_digest(some).collect()[0].ends_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
