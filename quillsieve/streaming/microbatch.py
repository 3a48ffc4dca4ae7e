"""Recurring runs: arriving article files as micro-batches that share the sent state."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillsieve.functions.articles import dedupe_ids
from quillsieve.operators import select
from quillsieve.plans.run import Run, run
from quillsieve.sources.options import Options
from quillsieve.sources.state import State, push


class Recurring:
    """A run for each micro-batch. With the opt-in city it only reports, unless pushing is allowed
    explicitly; asking for anything else is an error before anything runs.

    Delivery is at least once: the state is written after all of a batch's payloads went out
    (``commit_each``: after each of them, so a failure repeats at most one). In resend mode the
    state doesn't filter but is still added to. The lookback window drops what is too old.
    """

    def __init__(self, spark: SparkSession, state: State, options: Options, send, now=None, commit_each: bool = False):
        if options.opt_in and not options.dry_run and not options.allow_opt_in_push:
            raise ValueError("the opt-in city needs a dry run, or allow_opt_in_push once the receiver knows it")
        self.spark, self.state, self.options, self.send = spark, state, options, send
        self.now, self.commit_each = now or (lambda: datetime.now(UTC)), commit_each

    def batch(self, df: DataFrame, batch_id: int) -> Run | None:
        if df.isEmpty():
            return None
        when = self.now()
        out = run(df, self.state.read(), self.options, when)
        order = out.chosen.orderBy(*select.push_order())
        ids = [r["ids"] for r in order.select(dedupe_ids().alias("ids")).collect()]  # at most max_items rows
        sent: list[list[str]] = []

        def send(payload: dict) -> None:
            self.send(payload)
            sent.append(ids[len(sent)])
            if self.commit_each:
                self._add([sent[-1]], when)

        push(out.payloads, send, self.options.dry_run)
        if not self.commit_each:
            self._add(sent, when)
        return out

    def _add(self, ids: list[list[str]], when: datetime) -> None:
        flat = [(i, n) for n, i in enumerate(x for group in ids for x in group)]
        if flat:
            self.state.add(self.spark.createDataFrame(flat, "id string, place long"), when)

    def start(self, path: str, schema: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
        """Watch a folder of Parquet files; without ``every`` take what is there and end."""
        stream = self.spark.readStream.schema(schema).parquet(path)
        writer = stream.writeStream.foreachBatch(lambda df, i: self.batch(df.withColumn("seq", F.monotonically_increasing_id()) if "seq" not in df.columns else df, i)).option("checkpointLocation", checkpoint)
        return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
