"""The registered queries of the text operators: thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles
from .common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES = oracles.SQL


def register(name: str):
    def add(f):
        QUERIES[name] = f
        return f
    return add


def tokenizer_file(name: str) -> bytes:
    import public_tokenizers
    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


def pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


def decontamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    from .decontaminate import find_benchmark
    found = find_benchmark(docs, benchmark)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("item_ids"), ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def encoded_digest(docs: DataFrame) -> DataFrame:
    from .bpe import encode
    both = encode(docs, tokenizer_file("byte_bpe_multi_50k.tiktoken"), pattern(), decoded=True)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    from .quality import score_quality
    return score_quality(docs, labels)


def near_duplicates(docs: DataFrame) -> DataFrame:
    from .near import near_components
    return near_components(docs)


@register("op1_deleted_interpolation")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .scoring import interpolated_scores
    return interpolated_scores(read_table(spark, sf_dir, "documents"), order=3)


@register("op2_decontaminate")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@register("op3_language_svm")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language import identify
    return identify(read_table(spark, sf_dir, "documents"))


@register("op4_wavelet_token_store")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .wavelet import read_shards, write_shards
    folder, shards = write_shards(read_table(spark, sf_dir, "documents"),
                                  tokenizer_file("byte_bpe_50k.json").decode(), pattern())
    return read_shards(folder, shards).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@register("op5_line_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lines import drop_repeated_lines
    kept = drop_repeated_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@register("op6_toxicity_kneser_ney")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import score_toxicity
    return score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@register("op7_prefix_forest")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .forest import nearest
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@register("op8_quality_mil")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@register("op9_byte_bpe")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_digest(read_table(spark, sf_dir, "documents"))


@register("op10_ngram_jaccard_join")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


@register("op12_imatch_fingerprints")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .imatch import edited_fingerprints
    return edited_fingerprints(read_table(spark, sf_dir, "documents"))


@register("op11_conversation_trie")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .trie import prefix_nodes, turns_of, with_shared_heads
    return prefix_nodes(with_shared_heads(turns_of(read_table(spark, sf_dir, "conversations"))))


@register("op13_token_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .align import aligned
    return aligned(read_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json").decode(), pattern(),
                   tokenizer_file("piece_bpe_32k.model"))
