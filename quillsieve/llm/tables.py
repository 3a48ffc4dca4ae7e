"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

from pyspark.sql import SparkSession

from quillsieve.llm.arrays import bound_batches
from quillsieve.sources import scratch
from quillsieve.sources.scratch import shared_dir

__all__ = ["Scratch", "shared_dir"]


class Scratch(scratch.Scratch):
    """Written tables of one operator run, which also bounds the session's Arrow batches."""

    def __init__(self, spark: SparkSession, name: str):
        bound_batches(spark)
        super().__init__(spark, name)
