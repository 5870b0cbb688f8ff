"""keep_first / keep_last against a brute-force restatement on random data.

Random keys (some very hot), random order values with nulls (nulls sort first),
and a payload; the survivor per key must be the smallest (largest) by the
order columns, ties broken by the remaining columns.
"""

import random

from strata.operators.dedup import keep_first, keep_last


def _key(v):
    # ascending with nulls first, as struct comparison does
    return (0, 0) if v is None else (1, v)


def test_random_keep_first_and_last(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(4000):
        k = "HOT" if rnd.random() < 0.33 else f"k{rnd.randrange(300)}"
        a = None if rnd.random() < 0.1 else rnd.randrange(50)
        b = None if rnd.random() < 0.1 else rnd.choice(["x", "y", "z"])
        rows.append((k, a, b, i))
    df = spark.createDataFrame(rows, "k string, a int, b string, payload int")

    def brute(pick):
        best = {}
        for r in rows:
            cur = best.get(r[0])
            rank = (_key(r[1]), _key(r[2]), r[3])
            if cur is None or (rank < cur[0] if pick == "first" else rank > cur[0]):
                best[r[0]] = (rank, r)
        return sorted(v[1] for v in best.values())

    got_first = sorted(tuple(r) for r in keep_first(df, "k", ["a", "b"]).collect())
    got_last = sorted(tuple(r) for r in keep_last(df, "k", ["a", "b"]).collect())
    assert got_first == brute("first")
    assert got_last == brute("last")
