"""Stream sources: a message topic or a folder of files, read from the earliest or the
latest position.  After the first start the query's checkpoint decides the position."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def open_topic(spark: SparkSession, servers: str, topic: str, *, starting: str = "earliest",
               **options: str) -> DataFrame:
    """Kafka source (needs the connector jar on the cluster): the value as text (the
    message key is not used), with partition, offset and timestamp.  A producer that
    keys messages by the business key keeps each key in one partition, so the offset
    orders a key's events."""
    df = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
          .option("subscribe", topic).option("startingOffsets", starting).options(**options).load())
    return df.selectExpr("CAST(value AS STRING) AS value", "partition", "offset", "timestamp")


def topic_messages(topic: DataFrame) -> DataFrame:
    """A topic's rows as the loaders take them (value, seq, ts).  A key's messages lie in one
    partition, where the offset orders them."""
    return topic.selectExpr("value", "offset AS seq", "CAST(timestamp AS TIMESTAMP_NTZ) AS ts")


def open_files(spark: SparkSession, path: str, schema: T.StructType, *, fmt: str = "parquet",
               max_files_per_trigger: int | None = None, glob: str | None = None) -> DataFrame:
    """File-stream source (the file-based stand-in for a topic).  A file source always
    starts from the files already present; its checkpoint keeps the position."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path)
