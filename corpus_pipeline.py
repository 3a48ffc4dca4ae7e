"""The corpus pipeline: five stages over ``documents``, each on all that the one before it kept.

Stages but the last return the columns of documents (doc_id, text, lang, source, n_chars). A
null or empty text is rejected by the first stage; other columns are dropped; an empty table
passes through as an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsieve.llm import bpe, decontam, jaccard, langid, substring
from quillsieve.llm.queries import vocabulary
from quillsieve.llm.tables import Scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter (``und``) go; a missing language is filled in."""
    model = langid.fit(docs)
    found = langid.predict(docs.select(*COLUMNS), model, lang="lang_pred", score="lang_score")
    return found.where(F.col("lang_pred") != langid.UNKNOWN).withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles (Jaccard at least 0.8) the one with the smallest id stays.
    They meet by SimHash fingerprints and, as most such pairs differ in too many bits, by minima beside them."""
    return jaccard.dedupe(docs).select(*COLUMNS)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 50 words that an earlier document has go; a document with nothing left goes."""
    cut = substring.dedupe(docs.select(*COLUMNS)).where("n_removed = 0 or n_removed < n_words")
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    return cut.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed ids of each text, and whether they decode to it."""
    coded = bpe.round_trip(docs.select(*COLUMNS), vocabulary())
    return coded.select("doc_id", "lang", "source", "n_chars", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids", (F.col("decoded") == F.col("text").cast("binary")).alias("exact"))


STAGES = [("language", language), ("near_copies", near_copies), ("passages", passages), ("benchmark_free", benchmark_free), ("tokens", tokens)]
#: SQL can't express fingerprint components, removed passages and merges; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each but the last written as Parquet and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, docs = docs, scratch.cut(stage(spark, docs, sf_dir), name)
        scratch.drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)
