"""Line de-duplication with DataFrame functions only.

Lines are exploded and hashed, the distinct documents of each hash are counted,
and lines over the threshold are dropped everywhere but in one document; what
is left of a document is put together by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACES = "\t\n\x0b\x0c\r "


def line_key(line: Column) -> Column:
    """The line without outer ASCII white space, A-Z in lower case."""
    bare = F.btrim(line, F.lit(SPACES))
    # lower() is the cheap form and the same thing where every character is one byte
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def _hash(key: Column) -> Column:
    """128 bits in two halves, so that different lines practically never meet."""
    return F.struct(F.xxhash64(F.lit(1), key).alias("a"), F.xxhash64(F.lit(2), key).alias("b"))


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``docs`` with ``kept_text``, ``n_lines`` and ``n_dropped`` beside its columns.

    A key of at least ``min_chars`` code points found in at least ``min_docs``
    different ids loses all its lines except in the largest id that holds it.
    A null or empty text is one empty line.  A row without an id is not a
    document: its lines count nowhere and all stay.  Rows that share an id count
    as one document and lose the same lines.  Extra columns pass through;
    columns of the result's names are replaced.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = docs.select(F.col(id_col).alias("_id"), F.explode(F.split(text, "\n")).alias("_line"))
    keyed = (lines.where(F.col("_id").isNotNull()).select("_id", line_key(F.col("_line")).alias("_key"))
             .where(F.char_length("_key") >= min_chars).select("_id", _hash(F.col("_key")).alias("_h")))
    per_doc = keyed.distinct()  # partial aggregation first; the exchange is by (id, hash), so no line is hot
    heavy = (per_doc.groupBy("_h").agg(F.count("_id").alias("_docs"), F.max("_id").alias("_last"))
             .where(F.col("_docs") >= min_docs).select("_h", "_last"))
    drops = (per_doc.join(heavy, "_h").where(F.col("_id") != F.col("_last"))
             .groupBy("_id").agg(F.collect_list("_h").alias("_drop")))

    plain = docs.select(*[c for c in docs.columns if c not in ("kept_text", "n_lines", "n_dropped")])
    joined = plain.join(drops, plain[id_col] == drops["_id"], "left").drop("_id")
    all_lines = F.split(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "\n")
    stays = F.filter(all_lines, lambda line: (F.char_length(line) < min_chars)
                     | ~F.coalesce(F.array_contains(F.col("_drop"), _hash(line_key(line))), F.lit(False)))
    split_up = joined.withColumn("_kept", F.when(F.col("_drop").isNotNull(), stays))
    return (split_up
            .withColumn("kept_text", F.when(F.col("_drop").isNull(), F.coalesce(F.col(text_col).cast("string"), F.lit("")))
                        .otherwise(F.array_join("_kept", "\n")))
            .withColumn("n_lines", F.size(all_lines).cast("bigint"))
            .withColumn("n_dropped", F.when(F.col("_drop").isNull(), F.lit(0))
                        .otherwise(F.size(all_lines) - F.size("_kept")).cast("bigint"))
            .drop("_drop", "_kept"))
