"""The registered queries of the document operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from snapbook.llm import debruijn, hostpaths, jaccard, langcode, latent, mixing, negatives, quality, segments, sharding, suffixes, tokens, tries
from snapbook.llm.shared import read

SHARDS = 24
TOKEN_LIMIT = 512
# Conversations of a group that start with turns of one of them, and the bound of how many.
LENT_EVERY, LENT_BELOW = 20, 4


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latent.leaks(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark", "item_id", "text"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.repetition(read(spark, sf_dir, "documents", "doc_id", "text"))


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debruijn.RepeatedWords(read(spark, sf_dir, "documents", "doc_id", "text")).summary()


def op4_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hostpaths.main_text(read(spark, sf_dir, "pages", "page_id", "url", "html")).drop("path")


def op5_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.sampled_segmentations(read(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_path("piece_bpe_32k.model"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    docs = read(spark, sf_dir, "documents", "doc_id", "text").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    placed = sharding.assign_shards(sharding.assign_shards(docs, "doc_id", SHARDS), "doc_id", SHARDS + 1, "grown_shard")
    order = [F.col("doc_id").asc_nulls_first(), F.col("text_crc32").asc(), F.col("size").asc()]
    return sharding.number_in_shards(placed, "shard", order)


def op7_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = tokens.count_tokens(read(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang").withColumn("held_out", langcode.held_out(F.col("doc_id")))
    classifier = langcode.fit(docs.filter("not held_out").select("doc_id", "text", "lang"))
    found = langcode.predict(docs, classifier)
    return found.select("doc_id", langcode.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")


def op9_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.RepeatedBytes(read(spark, sf_dir, "documents", "doc_id", "text")).summary()


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_components(read(spark, sf_dir, "documents", "doc_id", "text"))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.Mix(read(spark, sf_dir, "documents", "doc_id", "text", "source")).documents()


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    moved = (F.col("label").cast("long") + 1) % 10
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, moved).otherwise(F.col("label").cast("long")))
    return negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


def op13_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = tries.sequences(read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
    return tries.trie(tries.spliced(turns, LENT_EVERY, LENT_BELOW))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_leaks": op1_leaks,
    "op2_quality": op2_quality,
    "op3_substrings": op3_substrings,
    "op4_pages": op4_pages,
    "op5_segments": op5_segments,
    "op6_sharding": op6_sharding,
    "op7_tokens": op7_tokens,
    "op8_language": op8_language,
    "op9_suffixes": op9_suffixes,
    "op10_jaccard": op10_jaccard,
    "op11_mixing": op11_mixing,
    "op12_negatives": op12_negatives,
    "op13_prefixes": op13_prefixes,
}
