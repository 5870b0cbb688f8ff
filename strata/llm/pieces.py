"""Cutting text into pieces that a byte-level BPE tokenizer treats independently.

Some places always begin a new match of the tokenizers' splitting pattern (of
the GPT-2 kind): a single space between two characters that are not white
space, both sides of a single line feed between such, and an ASCII mark right
after an ASCII letter.  Between them a text's encoding is its pieces' encodings
one after the other.  Text repeats its pieces, so each distinct piece is encoded
once and the results are gathered.  Where it is not plain that a place begins a
match none is cut there; a longer piece is encoded as well as two.

All of it works on the bytes of many texts at once: pieces are looked up by
64-bit hashes and then compared byte by byte, and only those not met before
become Python strings.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from .common import mix, ragged

WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: First bytes of the characters of Unicode's White_Space property beyond ASCII (and of many others).
LEAD = np.isin(np.arange(256), [0xC2, 0xE1, 0xE2, 0xE3])
LETTER = np.isin(np.arange(256), [*range(65, 91), *range(97, 123)])
#: ASCII that is no letter, digit, white space or control; without the apostrophe, which begins contractions.
MARK = np.isin(np.arange(256), [c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'"])
#: Known pieces of one worker; beyond, it starts afresh.
MOST_PIECES = 500_000
#: By number of bytes, the bits of a word that hold them.
MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Bytes worked on at once.
WINDOW = 1 << 20


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts of the pieces, pieces per text) of texts that lie one after the other."""
    n = len(data)
    begins = np.zeros(n + 1, bool)
    inner = np.ones(n + 1, bool)  # has a byte of the same text on both sides
    inner[offsets[:-1]] = inner[np.maximum(offsets[1:] - 1, 0)] = False
    if n:
        gaps = np.flatnonzero(((data == 32) | (data == 10)) & inner[:n])
        before, after = data[gaps - 1], data[np.minimum(gaps + 1, n - 1)]
        plain = ~WHITE[before] & ~WHITE[after] & ~LEAD[after]
        # the character before may be two or three bytes of white space
        plain &= (before < 128) | (~LEAD[data[gaps - 2]] & ~LEAD[data[gaps - 3]])
        gaps = gaps[plain]
        begins[gaps] = True
        begins[gaps[data[gaps] == 10] + 1] = True
        begins[1:n] |= LETTER[data[:-1]] & MARK[data[1:]]
    begins[offsets] = True
    starts = np.flatnonzero(begins[:n])
    return starts, np.diff(np.searchsorted(starts, offsets))


class Slices:
    """Slices of a byte array as 64-bit words, the last word of each filled up with zeros.

    ``head`` has every slice's first word; ``tail`` the further words of all
    slices one after the other, ``rows`` of each.
    """

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        padded = np.append(data, np.zeros(8, np.uint8))
        words = np.ndarray(len(data) + 1, np.uint64, padded, strides=(1,))  # the word at every byte
        self.size = ends - starts
        self.head = words[starts] & MASKS[np.minimum(self.size, 8)]
        self.rows = np.maximum(-(-self.size // 8) - 1, 0)
        self.first = np.cumsum(self.rows) - self.rows
        long = np.flatnonzero(self.rows)
        place = ragged(np.ones(len(long), np.int64), self.rows[long])
        self.tail = words[np.repeat(starts[long], self.rows[long]) + 8 * place]
        self.tail[(self.first + self.rows - 1)[long]] &= MASKS[(self.size[long] - 1) % 8 + 1]
        self.long, self.place = long, place

    def hashes(self) -> np.ndarray:
        """64 bits for every slice; equal slices have equal ones, and equal ones are to be verified."""
        out = mix(self.head + self.size.astype(np.uint64))
        if len(self.long):
            each = mix(self.tail + self.place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            sums = np.add.reduceat(mix(each), self.first[self.long])
            out[self.long] = mix(out[self.long] * np.uint64(0x9E3779B97F4A7C15) + sums)
        return out

    def tails(self, some: np.ndarray) -> np.ndarray:
        """The further words of some slices, one after the other."""
        return self.tail[ragged(self.first[some], self.rows[some])]


class Places:
    """Key -> its number, by order of arrival: open addressing in arrays, grown by doubling."""

    def __init__(self):
        self.count, self.bits = 0, 16
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(1 << self.bits, np.uint64)  # 0 is an empty slot
        self.numbers = np.zeros(1 << self.bits, np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The keys' numbers, -1 for unknown ones. No key is 0."""
        at = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        seen = self.keys[at]
        out = np.where(seen == keys, self.numbers[at], -1)
        todo = np.flatnonzero((seen != keys) & (seen != 0))
        at = at[todo]
        while len(todo):
            at = (at + 1) & (len(self.keys) - 1)
            seen = self.keys[at]
            hit = seen == keys[todo]
            out[todo[hit]] = self.numbers[at[hit]]
            more = ~hit & (seen != 0)
            todo, at = todo[more], at[more]
        return out

    def add(self, keys: np.ndarray) -> None:
        """Distinct keys that are not known yet."""
        numbers = np.arange(self.count, self.count + len(keys), dtype=np.int32)
        self.count += len(keys)
        if 2 * self.count > len(self.keys):
            held = self.keys != 0
            keys, numbers = np.append(self.keys[held], keys), np.append(self.numbers[held], numbers)
            self.bits = int(2 * self.count).bit_length()
            self.clear()
        at = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(keys):
            free = self.keys[at] == 0
            self.keys[at[free]] = keys[free]  # the last of those that want the same slot has it
            mine = self.keys[at] == keys
            self.numbers[at[mine]] = numbers[mine]
            keys, numbers, at = keys[~mine], numbers[~mine], (at[~mine] + 1) & (len(self.keys) - 1)


class Known:
    """Byte strings met before, numbered by arrival; what a hash finds is compared byte by byte."""

    def __init__(self):
        self.places = Places()
        self.size = np.zeros(0, np.int64)  # of each in bytes, its first word, and where the others are
        self.head = np.zeros(0, np.uint64)
        self.first = np.zeros(0, np.int64)
        self.tail = np.zeros(0, np.uint64)

    def numbers(self, slices: Slices) -> tuple[np.ndarray, np.ndarray]:
        """(each slice's number, the slices that are new in the order of their numbers).

        A slice whose hash belongs to other bytes has the number -1 and is not kept.
        """
        keys = np.maximum(slices.hashes(), np.uint64(1))
        at = self.places.find(keys)
        new, some = np.flatnonzero(at < 0), np.zeros(0, np.int64)
        if len(new):
            distinct, first, back = np.unique(keys[new], return_index=True, return_inverse=True)
            at[new] = self.places.count + back
            some = new[first]
            self.places.add(distinct)
            rows = slices.rows[some]
            self.first = np.append(self.first, len(self.tail) + np.cumsum(rows) - rows)
            self.size = np.append(self.size, slices.size[some])
            self.head = np.append(self.head, slices.head[some])
            self.tail = np.append(self.tail, slices.tails(some))
        same = (self.head[at] == slices.head) & (self.size[at] == slices.size)
        long = slices.long[same[slices.long]]
        rows = slices.rows[long]
        differs = slices.tails(long) != self.tail[ragged(self.first[at[long]], rows)]
        same[np.repeat(long, rows)[differs]] = False
        return np.where(same, at, -1), some


class PieceEncoder:
    """Encodes texts piece by piece.

    ``find`` cuts a piece into matches of the splitting pattern; ``encode`` maps
    distinct matches to (all their ids one after the other, ids of each);
    ``cut`` says where pieces begin.  A piece counts as known only when all its
    bytes are those of the known one: what its hash meets is compared.
    """

    def __init__(self, find: Callable[[str], list[str]], encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]],
                 most: int = MOST_PIECES, window: int = WINDOW, cut=cut):
        self.find, self.encode, self.most, self.window, self.cut = find, encode, most, window, cut
        self.reset()

    def reset(self) -> None:
        self.known = Known()
        self.start = np.zeros(0, np.int64)  # of each known piece's ids, and how many they are
        self.length = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)

    def learn(self, pieces: list[str]) -> None:
        flat, length = self.encoded(pieces)
        self.start = np.append(self.start, len(self.ids) + np.cumsum(length) - length)
        self.length = np.append(self.length, length.astype(np.int32))
        self.ids = np.append(self.ids, flat)

    def encoded(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids of the pieces one after the other, ids of each)."""
        distinct: dict[str, int] = {}
        found, counts = [], []
        for piece in pieces:
            some = [piece] if (piece[1:] if piece[0] == " " else piece).isalpha() else self.find(piece)
            counts.append(len(some))
            found += [distinct.setdefault(m, len(distinct)) for m in some]
        ids, length = self.encode(list(distinct))
        at = np.array(found, np.int64)
        flat = ids[ragged((np.cumsum(length) - length)[at], length[at])]
        ends = np.append(0, np.cumsum(length[at]))[np.append(0, np.cumsum(counts)).astype(np.int64)]
        return flat.astype(np.uint32, copy=False), np.diff(ends)

    def part(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(all ids of the pieces one after the other, ids of each)."""
        if self.known.places.count > self.most:
            self.reset()

        def text(k: int) -> str:
            return data[starts[k]:ends[k]].tobytes().decode("utf-8", "surrogatepass")

        at, new = self.known.numbers(Slices(data, starts, ends))
        if len(new):
            self.learn([text(k) for k in new.tolist()])
        other = np.flatnonzero(at < 0)
        length = np.where(at < 0, 0, self.length[at]).astype(np.int64)
        start = np.where(at < 0, 0, self.start[at])
        if not len(other):
            return self.ids[ragged(start, length)], length
        # different pieces of one hash: those that are not remembered are encoded anew
        flat, length[other] = self.encoded([text(k) for k in other.tolist()])
        start[other] = len(self.ids) + np.cumsum(length[other]) - length[other]
        return np.append(self.ids, flat)[ragged(start, length)], length

    def batch(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(all ids of the texts one after the other, number of ids of each text).

        Works through the bytes in windows that end where a piece begins, so what
        it holds beside the ids is bounded by a window or one longer piece.
        """
        ids, counts = [np.zeros(0, np.uint32)], np.zeros(len(offsets) - 1, np.int64)
        at, size = 0, self.window
        while at < len(data):
            stop = min(at + size, len(data))
            first, last = np.searchsorted(offsets, at, "right") - 1, np.searchsorted(offsets, stop, "left")
            bounds = np.clip(offsets[first:last + 1], at, stop) - at
            starts, per_text = self.cut(data[at:stop], bounds)
            ends = np.append(starts[1:], stop - at)
            if stop < len(data):  # the last piece may go on: it begins the next window
                if len(starts) < 2:
                    size *= 2
                    continue
                stop, starts, ends = at + int(starts[-1]), starts[:-1], ends[:-1]
                per_text = np.diff(np.minimum(np.append(0, np.cumsum(per_text)), len(starts)))
            flat, length = self.part(data[at:stop], starts, ends)
            ids.append(flat)
            total = np.append(0, np.cumsum(length))[np.append(0, np.cumsum(per_text))]
            counts[first:first + len(per_text)] += np.diff(total)
            at, size = stop, self.window
        return np.concatenate(ids), counts
