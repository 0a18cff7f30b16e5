"""Sinks: keyed JSON messages to a topic (or files), and console output for a look."""

from __future__ import annotations

from pyspark.sql import DataFrame

from dimweave.functions.expressions import to_message


def messages(df: DataFrame, key: str, *fields: str) -> DataFrame:
    """Rows -> (key, value) messages; null fields are kept as JSON nulls."""
    return df.select(to_message(key, *(fields or df.columns)).alias("m")).select("m.key", "m.value")


def write_topic(msgs: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Batch write of (key, value) messages to a topic (needs the connector jar)."""
    (msgs.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
     .options(**options).save())


def write_files(msgs: DataFrame, path: str, fmt: str = "json") -> None:
    """File stand-in for a topic, one part file per task."""
    msgs.write.mode("overwrite").format(fmt).save(path)


def write_jdbc(df: DataFrame, url: str, table: str, *, mode: str = "append", batch_size: int = 10_000,
               partitions: int | None = None, **options: str) -> None:
    """Bulk write to a warehouse table over JDBC (credentials via options, never in
    code); ``partitions`` bounds the number of parallel connections."""
    out = df.coalesce(partitions) if partitions else df
    (out.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", str(batch_size))
     .options(**options).mode(mode).save())


def show(df: DataFrame, n: int = 20) -> None:
    """Console output, for a look at a few rows."""
    df.show(n, truncate=False)
