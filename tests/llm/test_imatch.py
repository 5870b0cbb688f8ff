"""I-Match fingerprints against a plain version; the plan has no Python and exchanges texts once."""

import hashlib
import math
import random
import re
import struct

import pytest
import xxhash

from strata.llm import imatch as I

SCHEMA = "doc_id bigint, text string, range string, row string, fingerprint string, n_chars string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "a", "b", "c", "d") for i, t in rows], SCHEMA)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def of_text(t):
    return signed(xxhash.xxh64_intdigest(t.encode(), 42))


def of_longs(some):
    seed = 42
    for x in some:
        seed = xxhash.xxh64_intdigest(struct.pack("<q", x), seed)
    return signed(seed)


def words(t):
    return {w for w in re.split(r"[ \t-\r]+", t.lower()) if w}


def lexicon(texts):
    df = {}
    for t in texts:
        for w in words(t):
            df[w] = df.get(w, 0) + 1
    return {of_text(w) for w, n in df.items() if I.LOW_IDF <= math.log(len(texts) / n) <= I.HIGH_IDF}


def parts(t, lex):
    found = sorted(h for w in words(t) if (h := of_text(w)) in lex)
    out = [of_longs(found) if found else of_text(t)]
    for bits, subsets in I.LADDER:
        for k in range(subsets):
            some = [h for h in found if (h % (1 << 64)) >> (64 - bits) == k]
            out.append(of_longs(some) & 0xFFFFFFFF if some else None)
    return out


def likeness(a, b):
    if a[0] == b[0]:
        return 1.0
    told = [x == y for x, y in zip(a[1:], b[1:], strict=True) if x is not None or y is not None]
    return sum(told) / len(told) if told else 0.0


def shown(p):
    return f"{p[0] % (1 << 64):X}:" + ",".join("" if x is None else f"{x:X}" for x in p[1:])


def expected(rows):
    texts = [t or "" for _, t in rows]
    lex = lexicon(texts)
    order = sorted(rows, key=lambda r: (r[0] if r[0] is not None else -(1 << 63), (of_text(r[1] or "") % (1 << 64)) >> 32,
                                        of_text(r[1] or ""), r[1] or ""), reverse=True)
    out = []
    for k, (i, t) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        changed = t[:len(t) - half] + after[:half]
        a, b, c = parts(t, lex), parts(changed, lex), parts(after, lex)
        out.append((i, len(t), hashlib.sha256(changed.encode()).hexdigest(), shown(a), shown(b),
                    round(likeness(a, b), 9), round(likeness(a, c), 9)))
    return sorted(out, key=str)


def rows():
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdeéßж漢") for _ in range(rng.randrange(1, 7))) for _ in range(400)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    out = [(k, text(rng.randrange(1, 90))) for k in range(150)]
    out += [(1000, None), (1001, ""), (1002, " \n\t "), (1003, text(20000)), (None, text(30)), (None, text(31)), (-5, "one"), (-6, "𝒳𝒴 two 😀")]
    same = text(50)
    out += [(2000 + k, same) for k in range(8)] + [(7, text(12)), (7, text(12)), (8, same), (8, same)]
    return out + [(10**15, text(9)) for _ in range(60)]  # an id that fills several ranges


def test_against_a_plain_version(spark):
    got = I.edited_fingerprints(frame(spark, rows()))
    assert sorted(((*r[:5], round(r[5], 9), round(r[6], 9)) for r in got.collect()), key=str) == expected(rows())


@pytest.mark.parametrize("some", [[], [(1, "alone among all")], [(None, None)], [(3, "x y"), (3, "x y")]])
def test_tiny_tables(spark, some):
    got = I.edited_fingerprints(frame(spark, some)).collect()
    assert sorted(((*r[:5], r[5], r[6]) for r in got), key=str) == expected(some)


def test_plan(spark):
    plan = I.edited_fingerprints(frame(spark, rows()))._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"Python|Pandas|Arrow|MapPartitions|LogicalRDD.*term", plan)


def test_edited_texts_are_nearer_than_next_ones(spark):
    got = I.edited_fingerprints(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).toPandas()
    apart = got[got.n_chars > 400]
    assert (apart.near_edited > apart.near_next).mean() > 0.9
