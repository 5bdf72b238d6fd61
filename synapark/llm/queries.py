"""The registered queries of the corpus operators, with their production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, covertree, divergence, language, lines, minhash, oracles, packing, personal, quality, runs, sharding, suffixes, toxicity
from .common import table

WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op2_covertree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.near_vectors(table(spark, sf_dir, "embeddings"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), WORD_VOCABULARY)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), BYTE_VOCABULARY)


def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", "n_blocks", F.sha2("text", 256).alias("kept_sha256"))


def op7_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.dedup_substrings(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.quality(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio", "chunks_out")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.runs_of(table(spark, sf_dir, "documents"))


def op12_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.personal(table(spark, sf_dir, "documents"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


def queries() -> dict:
    every = (op1_sharding, op2_covertree, op3_toxicity, op4_packing, op5_bpe, op6_lines, op7_suffixes, op8_quality, op9_language, op10_minhash, op11_runs, op12_personal, op13_divergence)
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    return {"op1_sharding": oracles.SHARDING, "op2_covertree": oracles.COVER_TREE, "op7_suffixes": oracles.SUFFIXES, "op10_minhash": oracles.MINHASH, "op13_divergence": oracles.DIVERGENCE}
