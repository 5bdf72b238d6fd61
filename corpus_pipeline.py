"""A corpus pipeline: quality rules, line dedup, near-duplicates, repeated substrings, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from synapark.llm import lines, minhash, packing, quality, suffixes
from synapark.llm.common import cut
from synapark.llm.queries import WORD_VOCABULARY

#: SQL can't express the compression ratios of the first stage, nor the later ones.
ORACLE_SQL = None


#: Columns that stages know; others may bear any name and are passed through.
KNOWN = ("doc_id", "text", "lang", "source", "n_chars")


def _shortened(docs: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The columns of ``docs`` after a stage that shortens texts, with n_chars brought up to date, without documents of which nothing is left.

    Columns that stages don't know have names of their own meanwhile, so that none clashes.
    """
    apart = docs.toDF(*[n if n in KNOWN else f"extra_{k}" for k, n in enumerate(docs.columns)])
    found = stage(apart)
    rows = found.where((F.col("n_removed") == 0) | (F.length("text") > 0))
    chars = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return rows.select(*[chars.cast(apart.schema[n].dataType).alias(n) if n == "n_chars" else F.col(n) for n in apart.columns]).toDF(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression bands and the base rules keep."""
    return quality.keep_quality(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the blocks of lines that earlier ones have."""
    return _shortened(docs, lines.dedup_lines)


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates, and all that are in none."""
    return minhash.keep_first(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes of long strings that start earlier."""
    return _shortened(docs, suffixes.dedup_substrings)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token runs of the documents, packed into sequences."""
    return packing.pack(docs, WORD_VOCABULARY)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("minhash_dedup", minhash_dedup),
    ("suffix_dedup", suffix_dedup),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each returns is written down for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs)
    return docs
