"""Token alignment against a walk along both token lists."""

import collections
import hashlib
import random

import numpy as np
import pytest

from strata.llm import align as A
from strata.llm.queries import pattern, tokenizer_file


@pytest.fixture(scope="module")
def both():
    import sentencepiece
    from tokenizers import Tokenizer
    json, model = tokenizer_file("byte_bpe_50k.json").decode(), tokenizer_file("piece_bpe_32k.model")
    a, b = Tokenizer.from_str(json), sentencepiece.SentencePieceProcessor(model_proto=model)
    a.encode_special_tokens = True
    aligner = A.Aligner(A.byte_side(json, pattern()), A.piece_side(model))
    return json, model, aligner, a, b


def walk(both, text):
    """(ids of A, of B, groups, links), or None for a text without tokens."""
    _, _, aligner, a, b = both
    if not text:
        return None
    x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    xs, ys = [aligner.a.tokens[i] for i in x], [aligner.b.tokens[i] for i in y]
    if b"".join(xs) != (" " + text).encode() or b"".join(ys) != (" " + text).encode():
        return None
    i, j, at, bt, group, groups, links = 0, 0, len(xs[0]), len(ys[0]), ([x[0]], [y[0]]), [], []
    while True:
        links.append((y[j] << 32) + x[i])
        close, next_a, next_b = at == bt, at <= bt, bt <= at
        if close:
            groups.append(group)
            group = ([], [])
        if next_a:
            i += 1
        if next_b:
            j += 1
        if i == len(x):
            return x, y, groups, links
        if next_a:
            at += len(xs[i])
            group[0].append(x[i])
        if next_b:
            bt += len(ys[j])
            group[1].append(y[j])


def digest(groups):
    return hashlib.sha256(";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups).encode()).hexdigest()


def texts():
    rng = random.Random(2)
    out = [None, "", "  ", "a", " a", "<|endoftext|> x <s> </s> <unk>", "x▁y", "tab\tx\n\n  y", "<0x41>", "é" * 700, "x" * 3000, "one two", "one two"]
    out += ["".join(rng.choice("ab \n\t.,'é漢▁<s> ") for _ in range(rng.randrange(40))) for _ in range(250)]
    return out + [" ".join(rng.choice(["straße", "the", "123", "été", "漢字", "un-", "x,"]) for _ in range(30000))]


def test_merge_pieces_of_any_size():
    rng = np.random.default_rng(0)
    for n in (1, 3, 20, 120):
        for _ in range(60):
            end = int(rng.integers(n, 4 * n + 2))
            a, b = (np.append(np.sort(rng.permutation(end - 1)[:int(rng.integers(0, n))]) + 1, end) for _ in (1, 2))
            spans = [list(zip([0, *x[:-1].tolist()], x.tolist(), strict=True)) for x in (a, b)]
            links = sorted((i, j) for i, (x, y) in enumerate(spans[0]) for j, (u, v) in enumerate(spans[1]) if max(x, u) < min(y, v))
            common = sorted(set(a.tolist()) & set(b.tolist()))
            for size in (1, 2, 3, 7, 1000):
                left, right, close_a, close_b = A.merged(a, b, size)
                assert sorted(zip(left.tolist(), right.tolist(), strict=True)) == links
                assert a[close_a].tolist() == common == b[close_b].tolist()


def test_whole_table(spark, both):
    some = texts()
    rows = [(None if k == 20 else k % 200, t, "x", "y", "z") for k, t in enumerate(some)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_a string, shard string, keys string").repartition(3)
    got = A.aligned(docs, both[0], pattern(), both[1])
    walks = [walk(both, t) for t in some]
    counts = collections.Counter(k for w in walks if w for k in w[3])
    most = collections.defaultdict(int)
    for key, n in counts.items():
        most[key >> 32] = max(most[key >> 32], n)
    want = [(i, len(w[0]), len(w[1]), len(w[2]), len(w[3]), sum(counts[k] == most[k >> 32] for k in w[3]),
             sum(counts[k] for k in w[3]), digest(w[2])) if w else (i, 0, 0, 0, 0, 0, 0, "")
            for (i, *_), w in zip(rows, walks, strict=True)]
    assert sum(w is None for w in walks) > 20
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_empty_table(spark, both):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert A.aligned(docs, both[0], pattern(), both[1]).collect() == []


def test_a_long_text_in_parts(both, monkeypatch):
    monkeypatch.setattr(A, "WINDOW", 1 << 12)
    for text in (" ".join(t for t in texts() if t and "▁" not in t), "a good start " * 2000 + "▁" + " then more" * 2000):
        shard, data = A.Shard(), np.frombuffer(text.encode(), np.uint8)
        A.add_batch(shard, both[2], [1], data, np.array([0, len(data)]))
        w, row = walk(both, text), shard.row(0).to_pylist()[0]
        if w is None:
            assert not shard.figures[0].any() and shard.digests == [""] and row["keys"] == []
        else:
            assert shard.figures[0].tolist() == [[len(w[0]), len(w[1]), len(w[2]), len(w[3])]] and shard.digests == [digest(w[2])]
            assert dict(zip(row["keys"], row["counts"], strict=True)) == collections.Counter(w[3])
