"""Benchmark decontamination: one Aho-Corasick automaton over the test items' word windows.

The benchmark is cut into windows of ``window`` consecutive normalised words (a
shorter item is one window).  The automaton runs over word numbers, so a match
cannot begin or end inside a word, and each text is scanned once.  Matched
words are mapped back to character offsets of the original text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bytes_of, column, slices, texts

#: Words: runs of 0-9, a-z and everything above 7F, after A-Z are lower-cased.
TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
                 for c in range(256))
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Benchmark text that one automaton holds; a larger benchmark takes several scans.
AUTOMATON_BYTES = 512 << 10

RESULT = ("doc_id bigint, n_words bigint, n_hit bigint, spans array<struct<start:int,end:int>>, "
          "item_ids array<string>")


def words_of(text: str | None) -> list[bytes]:
    return bytes_of(text).translate(TO_WORDS).split()


def build(items: list[tuple[str, str | None]], window: int):
    """(vocabulary, automaton, per window its length and items); no windows give no automaton."""
    import ahocorasick
    vocabulary: dict[bytes, int] = {}
    windows: dict[tuple[int, ...], set[str]] = {}
    for item, text in items:
        ids = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text)]
        for at in range(max(1, len(ids) - window + 1) if ids else 0):
            windows.setdefault(tuple(ids[at:at + window]), set()).add(item)
    if not windows:
        return vocabulary, None, []
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    found = []
    for key, owners in windows.items():
        automaton.add_word(key, len(found))
        found.append((len(key), sorted(owners)))
    automaton.make_automaton()
    return vocabulary, automaton, found


def merged(intervals: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(intervals):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _scan(items, window: int):
    """mapInArrow function adding this chunk's word intervals and item ids to each row's."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, automaton, found = build(items.value, window)
        number = vocabulary.get
        for batch in slices(batches):
            n_words, starts, ends, owners = [], [], [], []
            for text, a, b, known in zip(column(batch, "text").to_pylist(), column(batch, "starts").to_pylist(),
                                         column(batch, "ends").to_pylist(), column(batch, "items").to_pylist(),
                                         strict=True):
                words = words_of(text)
                n_words.append(len(words))
                hits, seen = list(zip(a, b, strict=True)), set(known)
                if automaton is not None and words:
                    for end, k in automaton.iter(tuple([number(w, 0) for w in words])):
                        length, of = found[k]
                        hits.append((end + 1 - length, end + 1))
                        seen.update(of)
                hits = merged(hits)
                starts.append([x for x, _ in hits])
                ends.append([x for _, x in hits])
                owners.append(sorted(seen))
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), column(batch, "text"), pa.array(n_words, pa.int64()),
                 pa.array(starts, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32())),
                 pa.array(owners, pa.list_(pa.string()))],
                ["doc_id", "text", "n_words", "starts", "ends", "items"])

    return scan


def _offsets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import re
    word = re.compile(WORD)
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        n_hit, spans = [], []
        for text, starts, ends in zip(column(batch, "text").to_pylist(), column(batch, "starts").to_pylist(),
                                      column(batch, "ends").to_pylist(), strict=True):
            n_hit.append(sum(ends) - sum(starts))
            at = [m.span() for m in word.finditer(text)] if starts else []
            spans.append([{"start": at[a][0], "end": at[b - 1][1]} for a, b in zip(starts, ends, strict=True)])
        yield pa.RecordBatch.from_arrays(
            [column(batch, "doc_id"), column(batch, "n_words"), pa.array(n_hit, pa.int64()),
             pa.array(spans, spans_type), column(batch, "items")],
            ["doc_id", "n_words", "n_hit", "spans", "item_ids"])


def find_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = 13, id_col: str = "doc_id",
                   text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                   automaton_bytes: int = AUTOMATON_BYTES) -> DataFrame:
    """One row per document: words, words inside any benchmark window, their spans, the items found.

    ``spans`` are half-open code point offsets in the original text, adjoining
    ones merged.  Null and empty texts have no words and no hits; null item ids
    are left out; repeated items and repeated documents are kept as they are;
    an empty benchmark hits nothing.

    Only benchmark text is sent to the workers, ``automaton_bytes`` of it per
    scan at most (one item larger than that makes its own scan).
    """
    spark = docs.sparkSession
    tests = benchmark.where(F.col(item_col).isNotNull()).select(
        F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("text"))
    size = tests.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    chunks = max(1, -(-size // automaton_bytes))
    none = F.array().cast("array<int>")
    out = texts(docs, id_col, text_col).select("doc_id", "text", F.lit(0).cast("bigint").alias("n_words"),
                                               none.alias("starts"), none.alias("ends"),
                                               F.array().cast("array<string>").alias("items"))
    for k in range(chunks):
        mine = tests.where(F.pmod(F.xxhash64("item"), F.lit(chunks)) == k)
        items = spark.sparkContext.broadcast([(r.item, r.text) for r in mine.collect()])
        scan = _scan(items, window)
        if k + 1 < chunks:
            out = out.mapInArrow(scan, out.schema)
    return out.mapInArrow(lambda batches: _offsets(scan(batches)), RESULT)
