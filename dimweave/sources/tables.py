"""Warehouse tables read whole, once per batch (instead of one keyed query per event)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """A table by path (parquet, orc, ...); filters and column choices reach the scan."""
    return spark.read.format(fmt).options(**options).load(path)


def read_jdbc(spark: SparkSession, url: str, table: str, *, partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None, partitions: int = 8,
              **options: str) -> DataFrame:
    """A JDBC table read in ``partitions`` parallel key ranges (credentials via options,
    never in code).  Spark pushes filters and the column list into the query."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if partition_column is not None:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", str(lower))
             .option("upperBound", str(upper)).option("numPartitions", str(partitions)))
    return r.load()


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given test tables (``<sf_dir>/<name>.parquet``)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
