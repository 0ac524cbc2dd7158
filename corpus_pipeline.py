"""The corpus pipeline: five stages over the table of documents, each written and read again as Parquet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from snapbook.llm import debruijn, jaccard, latent, quality, segments
from snapbook.llm.queries import tokenizer_path
from snapbook.llm.shared import cut, read, ready

ROW_KEY = "_corpus_row"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the repetition rules."""
    ready(spark)
    return quality.keep_passing(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of five-word shingle similarity 0.8 or more."""
    ready(spark)
    return jaccard.keep_one(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 50-word windows that a document with a smaller id has; ``n_chars`` follows the text."""
    ready(spark)
    length = "n_chars" if "n_chars" in docs.columns else None
    return debruijn.RepeatedWords(docs).remaining(docs, length=length)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    ready(spark)
    keyed = docs.withColumn(ROW_KEY, F.xxhash64("doc_id", "text"))
    found = latent.leaks(keyed, read(spark, sf_dir, "benchmark", "item_id", "text"), key=ROW_KEY)
    leaked = cut(found.select(F.col("doc_id").alias(ROW_KEY)).distinct())
    return keyed.join(leaked, ROW_KEY, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of each document, as packed piece numbers with inclusion scores."""
    ready(spark)
    return segments.sampled_segmentations(docs, tokenizer_path("piece_bpe_32k.model"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("substring dedup", substring_stage),
    ("benchmark decontamination", decontamination_stage),
    ("SentencePiece segmentations", encoding_stage),
]

# SQL cannot express the sampled segmentations of the last stage; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``; each stage before it is written as Parquet and read again."""
    docs = ready(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut(docs)
    return docs
