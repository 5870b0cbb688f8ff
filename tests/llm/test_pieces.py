"""Encoders against the libraries: pieces whose hashes meet, windows, matches of many blocks."""

import random

import numpy as np
import pytest

from strata.llm import bpe, pieces, queries, wavelet

MULTI = "byte_bpe_multi_50k.tiktoken"


def thue_morse(letters: str, doublings: int) -> str:
    bits = [0]
    for _ in range(doublings):
        bits += [1 - b for b in bits]
    return "".join(letters[b] for b in bits)


def flat(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    return np.frombuffer(b"".join(parts), np.uint8), np.append(0, np.cumsum([len(p) for p in parts])).astype(np.int64)


def each(encoder, texts: list[str]) -> list[list[int]]:
    ids, counts = encoder.batch(*flat(texts))
    return [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])]


@pytest.fixture(scope="module")
def ours():
    return bpe.Bpe(bpe.read_ranks(queries.tokenizer_file(MULTI)))


@pytest.fixture(scope="module")
def tik(ours):
    import tiktoken
    return tiktoken.Encoding("own", pat_str=queries.pattern(), special_tokens={},
                             mergeable_ranks={t: i for i, t in enumerate(ours.tokens) if t})


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_str(queries.tokenizer_file("byte_bpe_50k.json").decode())


def samples(seed: int, n: int, longest: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice("abe \n\t.,'<1éß漢 ") for _ in range(rng.randrange(longest))) for _ in range(n)]


@pytest.mark.parametrize("size", [10, 12])
def test_words_that_polynomial_hashes_confuse(ours, tik, library, size):
    pair = [thue_morse("ab", size), thue_morse("ba", size)]
    assert each(bpe.piece_encoder(ours, queries.pattern()), pair) == [tik.encode_ordinary(t) for t in pair]
    stored = wavelet.piece_encoder(queries.tokenizer_file("byte_bpe_50k.json").decode(), queries.pattern())
    assert each(stored, pair) == [library.encode(t, add_special_tokens=False).ids for t in pair]


@pytest.mark.parametrize("keep", [0, 1, 4])
def test_pieces_of_one_hash_keep_their_own_ids(ours, tik, monkeypatch, keep):
    """Hashes of ``keep`` bits, so that nearly all pieces meet others."""
    whole = pieces.Slices.hashes
    monkeypatch.setattr(pieces.Slices, "hashes", lambda self: whole(self) & np.uint64((1 << keep) - 1))
    encoder = bpe.piece_encoder(ours, queries.pattern())
    for seed in (1, 2, 3):
        texts = samples(seed, 60, 80)
        assert each(encoder, texts) == [tik.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("window", [1, 3, 16, 100])
def test_windows_cut_no_piece(ours, tik, window):
    encoder = bpe.piece_encoder(ours, queries.pattern())
    encoder.window = window
    texts = ["", *samples(4, 150, 90), "", "word " * 400, "x" * 700, ""]
    assert each(encoder, texts) == [tik.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("letters", ["a", "ab", "etaoinshr", "éèüß", "漢字語中国人大学生"])
@pytest.mark.parametrize("size", [513, 1024, 1025, 6000])
def test_matches_of_many_blocks(ours, tik, letters, size):
    rng = random.Random(size)
    text = "".join(rng.choice(letters) for _ in range(size))
    assert ours.blocks(text.encode()).tolist() == tik.encode_ordinary(text)
    assert each(bpe.piece_encoder(ours, queries.pattern()), [text]) == [tik.encode_ordinary(text)]


def test_a_long_text_is_worked_on_in_windows(ours, tik, monkeypatch):
    """What is held at once does not follow the text: the largest slice table stays near a window."""
    sizes = []
    made = pieces.Slices.__init__

    def noted(self, data, starts, ends):
        sizes.append(len(data))
        made(self, data, starts, ends)

    monkeypatch.setattr(pieces.Slices, "__init__", noted)
    text = " ".join(samples(5, 4000, 60)) * 40
    assert len(text) > 4 << 20
    assert each(bpe.piece_encoder(ours, queries.pattern()), [text]) == [tik.encode_ordinary(text)]
    assert max(sizes) <= pieces.WINDOW
