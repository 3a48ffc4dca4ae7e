"""The registered corpus queries and their DuckDB counterparts."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from quillsieve.llm import bpe, chat, decontam, langid, lattice, license_scan, lm, rollup, simhash, substring
from quillsieve.sources.scratch import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


@lru_cache
def vocabulary() -> bpe.Vocabulary:
    import public_tokenizers

    return bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary())


def op2_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digests(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digests(table(spark, sf_dir, "documents"))


def op4_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.digests(table(spark, sf_dir, "documents"))


def op5_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.digests(table(spark, sf_dir, "documents"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    talk = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).selectExpr("-1L AS conv_id", "id AS turn", "if(id = 0, 'user', 'assistant') AS role", "'</s>[INST] ok [/INST]' AS text")
    return chat.digests(talk.union(extra))


def op7_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.found(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.link(table(spark, sf_dir, "embeddings"))


def op9_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.replay(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.digests(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_bpe, op2_substring, op3_simhash, op4_license, op5_lm, op6_chat, op7_decontam, op8_lattice, op9_rollup, op10_langid)}
ORACLES: dict[str, str] = {"op9_rollup": rollup.oracle()}
