"""Session helpers: a tuned local session for tests/bench and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale.  AQE coalesces the small shuffles of the summary
# tables and splits skewed join partitions; the broadcast threshold stays at Spark's
# size-checked default so a side is only broadcast when its measured size is small.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "dimweave") -> SparkSession:
    """Local session for tests and the bench; the UI stays off."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
    )
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).  Only where it is
    unset on a local master, as in tests, a folder of our own is registered; on a cluster
    that is an error, since executors don't share the driver's folders."""
    base = spark.sparkContext.getCheckpointDir()
    if not base:
        base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            base = tempfile.mkdtemp(prefix="dimweave-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
        base = spark.sparkContext.getCheckpointDir() or base
    return base


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    The folder comes from ``spark.checkpoint.dir`` (or the SparkContext's checkpoint
    folder), see ``ensure_checkpoint_dir``.
    """
    return os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
