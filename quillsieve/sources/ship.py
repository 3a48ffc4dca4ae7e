"""The package's code for Python workers that can't import it by themselves."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_done: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the session's workers, once; not if PYTHONPATH has it."""
    sc = spark.sparkContext
    have = {os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    if sc.applicationId in _done or ROOT in have:
        return
    _done.add(sc.applicationId)
    name = os.path.join(tempfile.mkdtemp(prefix="quillsieve-"), "quillsieve.zip")
    with zipfile.ZipFile(name, "w") as z:
        for folder, _, files in os.walk(os.path.join(ROOT, "quillsieve")):
            for f in files:
                if f.endswith(".py"):
                    z.write(os.path.join(folder, f), os.path.relpath(os.path.join(folder, f), ROOT))
    sc.addPyFile(name)


def shipped(f):
    """A query that ships the package before it runs."""

    @functools.wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return f(spark, sf_dir)

    return run
