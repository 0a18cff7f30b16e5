"""Rows that a stream's batches wrote, for sinks that Spark commits itself (``foreachBatch`` loads
observe their own writes)."""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQueryListener

from dimweave.streaming.triggers import start

#: Spark reports progress after the batches themselves: seconds to wait for the last report.
PATIENCE = 60


class RowCounts(StreamingQueryListener):
    """Appends {"batch", "rows"} to ``metrics`` for every batch of the query of this name."""

    def __init__(self, name: str, metrics: list):
        self.name, self.metrics = name, metrics
        self.run_id, self.ended = None, threading.Event()

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.run_id = event.runId

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(self.name)
        if seen is not None:
            self.metrics.append({"batch": event.progress.batchId, "rows": seen["rows"]})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if self.run_id is not None and event.runId == self.run_id:
            self.ended.set()


def counting(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` with its rows counted, and the name under which the count is reported."""
    name = f"rows_{uuid.uuid4().hex}"
    return df.observe(name, F.count(F.lit(1)).alias("rows")), name


def start_counted(spark: SparkSession, writer: DataStreamWriter, name: str, metrics: list, trigger: dict | None = None) -> None:
    """``triggers.start`` of a counted stream.  A drained query's counts are complete on return; a
    query that keeps running goes on appending."""
    listener = RowCounts(name, metrics)
    spark.streams.addListener(listener)
    start(writer.queryName(name), trigger)
    if trigger is None:
        listener.ended.wait(PATIENCE)
        spark.streams.removeListener(listener)
