"""Document fingerprints by I-Match with randomised lexicons, in DataFrame functions only.

The lexicon is the corpus's terms within a band of inverse document frequency.
A text's distinct lexicon terms are sorted and hashed: all of them together, and
those in each of several random subsets of the lexicon.  A subset's hash is equal
for two texts that agree on the subset's terms; since the subsets take from a
quarter to a thousandth of the lexicon, the share of equal ones falls gradually
as texts differ, for short and for long texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import texts, written

#: Natural logarithm of documents / documents with the term: terms outside are no part of the lexicon.
LOW_IDF, HIGH_IDF = 2.0, 7.0
#: (bits, subsets): the lexicon is dealt into 2**bits parts by hash, and the first ``subsets`` parts are subsets.
LADDER = ((2, 2), (4, 8), (6, 16), (8, 32), (10, 32))
#: Terms of a lexicon that is broadcast; a larger one is joined by shuffling.
BROADCAST_TERMS = 1 << 20
#: Most ranges of ids that texts are dealt into.
MOST_RANGES = 1 << 14
SPACE = r"[\x20\x09-\x0D]+"
LEAST = -(1 << 63)


def terms(text: Column) -> Column:
    """The distinct words of a text in lower case, and always the empty one."""
    return F.array_distinct(F.concat(F.array(F.lit("")), F.split(F.lower(text), SPACE)))


def lexicon(docs: DataFrame, low_idf: float = LOW_IDF, high_idf: float = HIGH_IDF) -> DataFrame:
    """(term bigint): hashes of the words whose idf over ``docs`` (column text) is within the band, and the empty word's.

    At most e**high_idf words for each distinct word of a mean document, however
    large the corpus: each occurs in at least rows / e**high_idf documents.
    """
    rows = docs.count()
    counted = (docs.select(F.explode(terms(F.coalesce("text", F.lit("")))).alias("word"))
               .groupBy(F.xxhash64("word").alias("term")).agg(F.count(F.lit(1)).alias("df")))
    idf = F.log(F.lit(float(max(rows, 1))) / F.col("df"))
    empty = F.col("term") == F.xxhash64(F.lit(""))
    return counted.where(empty | idf.between(low_idf, high_idf)).select("term")


def part_of(term: Column, bits: int) -> Column:
    return F.shiftrightunsigned(term, 64 - bits)


def at_most(bits: int, subsets: int) -> Callable[[Column], Column]:
    return lambda term: part_of(term, bits) < subsets


def equals(bits: int, k: int) -> Callable[[Column], Column]:
    return lambda term: part_of(term, bits) == k


def with_parts(df: DataFrame, found: str, other: str, name: str) -> DataFrame:
    """``df`` with the hashes of a text's lexicon terms in ``found``: of all, then of each subset.

    Where there are no terms the first is ``other``; a subset without terms has
    null.  The column ``found`` is replaced by ``name``.
    """
    levels = [f"{name}_{bits}" for bits, _ in LADDER]
    # columns of their own, so that none is worked out again for each subset
    df = df.withColumn(found, F.sort_array(found))
    df = df.withColumns({level: F.filter(found, at_most(bits, subsets))
                         for level, (bits, subsets) in zip(levels, LADDER, strict=True)})
    none = F.xxhash64(F.array().cast("array<bigint>"))
    out = [F.when(F.size(found) == 0, F.col(other)).otherwise(F.xxhash64(found))]
    out += [F.nullif(F.xxhash64(F.filter(level, equals(bits, k))), none).bitwiseAND(0xFFFFFFFF)
            for level, (bits, subsets) in zip(levels, LADDER, strict=True) for k in range(subsets)]
    return df.withColumn(name, F.array(*out)).drop(found, *levels)


def fingerprint(of: Column) -> Column:
    """``parts`` as text: the hash of all terms, a colon, and the subsets' hashes between commas."""
    return F.concat(F.hex(F.get(of, 0)), F.lit(":"), F.array_join(
        F.transform(F.slice(of, 2, F.size(of) - 1), lambda x: F.hex(x)), ",", ""))


def with_likeness(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """1 where all terms are the same; else the share of equal hashes among subsets that either text has terms in."""
    rest = [F.slice(c, 2, F.size(c) - 1) for c in (a, b)]
    same = F.zip_with(*rest, lambda x, y: F.when(x.isNotNull() | y.isNotNull(), x.eqNullSafe(y)))
    df = df.withColumn("told", F.array_compact(same))  # a column of its own, worked out once
    equal = F.size(F.filter("told", lambda s: s)).cast("double")
    return df.withColumn(name, F.when(F.get(a, 0) == F.get(b, 0), 1.0).when(F.size("told") == 0, 0.0)
                         .otherwise(equal / F.size("told"))).drop("told")


def in_ranges(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with ``range`` and the order columns key, high and low: ranges of descending id, ties by text hash.

    The ranges are cut at quantiles of the ids (of a sample beyond what that
    needs); an id that fills several ranges is cut by the hash of its texts.  Null
    ids come last, null texts are empty.
    """
    spark = docs.sparkSession
    h = F.xxhash64("text")
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id", "text", F.coalesce("doc_id", F.lit(LEAST)).alias("key"),
        F.shiftrightunsigned(h, 32).alias("high"), h.alias("low"))
    n = max(2, min(MOST_RANGES, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    share = min(1.0, 100 * n / max(docs.count(), 1))
    ids = keyed.select("key") if share == 1 else keyed.select("key").sample(share, seed=5)
    limits = ids.agg(F.percentile_approx("key", [k / n for k in range(1, n)], 100 * n)).first()[0] or [0]
    often: dict[int, int] = {}
    for x in limits:
        often[x] = often.get(x, 0) + 1

    def numbers(some: list[int]) -> Column:  # as text, a short constant in the plan
        return F.split(F.lit(",".join(map(str, some))), ",").cast("array<bigint>")

    cuts, times = numbers(limits), numbers([often[x] for x in limits])
    # how many cuts are not above the key, by halving steps
    steps = numbers([1 << k for k in reversed(range(len(limits).bit_length()))])
    place = F.aggregate(steps, F.lit(0).cast("bigint"), lambda p, s: F.when(
        F.get(cuts, (p + s - 1).cast("int")) <= F.col("key"), p + s).otherwise(p))
    at = F.col("place")
    last = (at - 1).cast("int")
    within = F.when(F.get(cuts, last) == F.col("key"),
                    F.shiftright(F.col("high") * F.get(times, last), 32) - F.get(times, last) + 1).otherwise(0)
    return keyed.withColumn("place", place).withColumn("range", (at + within).cast("int")).drop("place")


def with_next(docs: DataFrame) -> DataFrame:
    """Rows by ``range`` and ``row`` with ``text`` and ``next``, the following text in descending order of ids.

    After the last comes the first.  Each range also holds the first row of the
    following range, as a ``guest`` behind its own, so texts are exchanged once.
    """
    placed = in_ranges(docs)
    # a row per range, whose number is bounded
    heads = placed.groupBy("range").agg(F.max(F.struct("key", "high", "low")).alias("head"))
    alone = Window.partitionBy(F.lit(0))
    heads = heads.select(
        F.col("head.key").alias("h_key"), F.col("head.low").alias("h_low"), F.col("range").alias("h_range"),
        F.coalesce(F.lag("range").over(alone.orderBy(F.desc("range"))), F.min("range").over(alone)).alias("before"))
    joined = placed.join(F.broadcast(heads), (F.col("range") == F.col("h_range")) & (F.col("key") == F.col("h_key"))
                         & (F.col("low") == F.col("h_low")), "left")
    own = F.struct(F.col("range"), F.lit(False).alias("guest"))
    dealt = joined.select("doc_id", "text", "key", "high", "low", F.explode(
        F.when(F.col("before").isNull(), F.array(own)).otherwise(
            F.array(own, F.struct(F.col("before").alias("range"), F.lit(True).alias("guest"))))).alias("at"))
    order = Window.partitionBy("range").orderBy("guest", F.desc("key"), F.desc("high"), F.desc("low"), F.desc("text"))
    return dealt.select("doc_id", "text", "key", "high", "low", "at.range", "at.guest").select(
        "range", F.row_number().over(order).alias("row"), "guest", "doc_id", "text", F.lead("text").over(order).alias("next"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        low_idf: float = LOW_IDF, high_idf: float = HIGH_IDF) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they and the next text's are.

    The edited text is the text whose last floor(n_chars / 2) code points are
    replaced by the first as many (or all) of the next text in descending order
    of ids, after the last the first.  Rows that share an id follow each other by
    the hash of their texts, rows without an id come last, a null text is empty, the
    only row is its own next.  Returns doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited and near_next (both 0 to 1), a row per row;
    other columns stay behind.

    Equal texts have equal fingerprints; a text without a lexicon term is known by
    the hash of the whole text and is like another only where both are equal.
    """
    rows = texts(docs, id_col, text_col)
    words = written(lexicon(rows, low_idf, high_idf), "imatch-lexicon")
    if words.count() <= BROADCAST_TERMS:
        words = F.broadcast(words)
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.when(~F.col("guest"), F.concat(F.substr("text", F.lit(1), n - half), F.substr("next", F.lit(1), half)))
    pairs = with_next(rows).withColumn("edited", edited).select(
        "range", "row", "guest", "doc_id", n.cast("bigint").alias("n_chars"), F.unhex(F.sha2("edited", 256)).alias("sha"),
        F.xxhash64("text").alias("own"), F.xxhash64("edited").alias("changed"),
        F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("text").alias("of")),
                          F.struct(F.lit(1).alias("side"), F.col("edited").alias("of")))).alias("each"))
    keys = ["range", "row", "guest", "doc_id", "n_chars", "sha", "own", "changed"]
    told = (pairs.where("each.of IS NOT NULL")
            .select(*keys, "each.side", F.explode(terms(F.col("each.of"))).alias("word"))
            .select(*keys, "side", F.xxhash64("word").alias("term")).join(words, "term"))
    # rows of a range are in one partition already, so this exchanges nothing
    empty = F.xxhash64(F.lit(""))
    found = told.groupBy(*keys).agg(*[
        F.collect_list(F.when((F.col("side") == side) & (F.col("term") != empty), F.col("term"))).alias(name)
        for side, name in enumerate(("mine", "theirs"))])
    hashed = with_parts(with_parts(found, "mine", "own", "a"), "theirs", "changed", "b")
    after = Window.partitionBy("range").orderBy("row")
    both = hashed.withColumn("c", F.lead("a").over(after)).where(~F.col("guest"))
    both = with_likeness(with_likeness(both, "a", "b", "near_edited"), "a", "c", "near_next")
    return both.select("doc_id", "n_chars", F.lower(F.hex("sha")).alias("edited_sha256"),
                       fingerprint(F.col("a")).alias("fingerprint"), fingerprint(F.col("b")).alias("edited_fingerprint"),
                       "near_edited", "near_next")
