"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; set here only where it is unset (a local session)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='quillsieve-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


#: Bytes a core below which a table is dealt out again.
SMALL = 8 << 20


def spread(df: DataFrame) -> DataFrame:
    """df on all cores if it is small: a file of one row group is read by one task, whatever the
    number of cores. A table of more than SMALL bytes a core has row groups enough and stays."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if cores > 1 and size < SMALL * cores else df


class Scratch:
    """Written tables of one operator run; ``drop`` deletes one that is no longer read."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{shared_dir(spark)}/quillsieve/{name}-{uuid.uuid4().hex}"
        self.made: dict[int, str] = {}
        self.count = 0

    def cut(self, df: DataFrame, name: str = "t") -> DataFrame:
        """df written once and read again: the lineage ends at the files."""
        self.count += 1
        path = f"{self.base}/{self.count}-{name}"
        df.write.mode("overwrite").parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        self.made[id(back)] = path
        back.scratch_path = path
        return back

    def drop(self, *tables: DataFrame) -> None:
        for df in tables:
            path = getattr(df, "scratch_path", None)
            if path:
                where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)
