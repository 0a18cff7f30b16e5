"""Row counts of the fact stream: one for each batch, and their sum is what was written."""

import os
import shutil
import tempfile

from conftest import SF_SMALL
from dimweave.session import work_dir
from dimweave.streaming.loaders import run_fact_stream


def test_fact_rows_are_counted(spark):
    folder = tempfile.mkdtemp(prefix="dw-orders-")
    for i in range(3):
        target = os.path.join(folder, f"orders-{i}.parquet")
        shutil.copyfile(f"{SF_SMALL}/orders.parquet", target)
        os.utime(target, (1_700_000_000 + i, 1_700_000_000 + i))
    root, metrics = work_dir(spark, "t-counts"), []
    out = run_fact_stream(spark, SF_SMALL, root, source_dir=folder, glob="*.parquet", metrics=metrics)
    n = spark.read.parquet(f"{SF_SMALL}/orders.parquet").count()
    assert sorted((m["batch"], m["rows"]) for m in metrics) == [(i, n) for i in range(3)]
    assert spark.read.parquet(out).count() == 3 * n
    # nothing new: the restarted query writes and counts nothing
    more = []
    run_fact_stream(spark, SF_SMALL, root, source_dir=folder, glob="*.parquet", metrics=more)
    assert not sum(m["rows"] for m in more)
