"""The corpus pipeline: raw documents to token ids, each stage one operator of ``strata.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes to the shared folder and reads back as the next stage's documents.
All stages but the last return the columns of their input.  A row without a
doc_id cannot be told from others and passes through the filtering stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import read_table, written
from strata.llm.queries import decontamination, encoded_digest, near_duplicates, quality_scores


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` less the rows of these ids; a null id matches nothing."""
    return docs.join(ids.select(F.col("doc_id").alias("_gone")), docs["doc_id"] == F.col("_gone"), "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects."""
    scores = quality_scores(docs, read_table(spark, sf_dir, "labels"))
    return _without(docs, scores.where(F.col("predicted") == 0))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that many documents share; ``n_chars`` follows the text."""
    from strata.llm.lines import drop_repeated_lines
    kept = drop_repeated_lines(docs)
    new = {"text": F.when(F.col("n_dropped") > 0, F.col("kept_text")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("n_dropped") > 0, F.char_length("kept_text")).otherwise(F.col("n_chars"))
    return kept.select(*[new[c].cast(docs.schema[c].dataType).alias(c) if c in new else F.col(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each group of near-duplicates."""
    groups = near_duplicates(docs)
    return _without(docs, groups.where(F.col("component_id") != F.col("doc_id")))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents contaminated by the benchmark."""
    found = decontamination(docs, read_table(spark, sf_dir, "benchmark"))
    return _without(docs, found.where("contaminated"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, as digests, and the digest of their decoding."""
    return encoded_digest(docs)


STAGES = [("quality classifier", quality), ("line dedup", line_dedup), ("n-gram Jaccard join", near_dedup),
          ("benchmark decontamination", decontaminate), ("byte-level BPE", tokenize)]

#: The first stage is a learned model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs
