"""The store's publishing and retention."""

import json
import os
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest

from dimweave.session import work_dir
from dimweave.streaming.store import MANIFESTS, VersionedStore


def files_of(root):
    return sum(len(f) for _, _, f in os.walk(root.replace("file:", "")))


def test_files_are_bounded_and_old_outputs_stay(spark):
    root = work_dir(spark, "t-retain")
    store = VersionedStore(spark, root, key="k", buckets=4, retain=2)
    rows = spark.range(40).selectExpr("id AS k", "0 AS v")
    log = spark.createDataFrame([(0,)], "v int")
    store.write(0, {"dim": rows.coalesce(1)}, plain={"log": log.coalesce(1)})
    seen = []
    for v in range(1, 13):
        touched = [v % 2]  # buckets 2 and 3 stay those of version 0
        now = store.read(v - 1, "dim", touched).selectExpr("k", f"{v} AS v")
        store.write(v, {"dim": now.coalesce(1)}, touched=touched, plain={"log": spark.createDataFrame([(v,)], "v int").coalesce(1)}, base=v - 1)
        seen.append(files_of(os.path.join(root, "dim")))
        assert store.read_latest("dim").count() == 40 and store.read(v - 1, "dim").count() == 40
    assert max(seen[3:]) <= seen[3]
    assert {r.v for r in store.read_latest("dim").select("v").distinct().collect()} == {0, 11, 12}
    assert sorted(store.read(v, "log").first().v for v in store.versions()) == list(range(13))
    store.expire(2, outputs=True)
    assert store.versions() == [11, 12] and store.read(11, "log").first().v == 11
    assert store._names(os.path.join(root, "log")) and set(store._names(os.path.join(root, "log"))) == {"v=11", "v=12"}
    assert VersionedStore(spark, root, key="k").buckets == 4


def test_an_older_version_than_the_one_before_must_stay(spark):
    with pytest.raises(ValueError):
        VersionedStore(spark, work_dir(spark, "t-retain1"), retain=1)


def test_a_reader_finds_whole_manifests_only(spark):
    root = work_dir(spark, "t-publish").replace("file:", "")
    store = VersionedStore(spark, root)
    folder = os.path.join(root, MANIFESTS)
    text = json.dumps({"_buckets": 1, "_values": {"x": "y" * 5000}})
    os.makedirs(folder)
    store._publish(store._manifest_path(0), text)
    found, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            last = max(int(n[2:-5]) for n in os.listdir(folder) if n.startswith("v="))
            with open(os.path.join(folder, f"v={last}.json")) as f:
                found.append((last, f.read()))

    with ThreadPoolExecutor(1) as pool:
        reader = pool.submit(read)
        try:
            for v in range(1, 60):
                store._publish(store._manifest_path(v), text)
        finally:
            stop.set()
        reader.result()
    assert all(t == text for _, t in found) and [v for v, _ in found] == sorted(v for v, _ in found)
    assert store.latest() == 59
    store._publish(store._manifest_path(59), text)  # again: the same
    store._publish(store._manifest_path(59), "{}")  # another text takes its place
    assert store.manifest(59) == {} and not [n for n in os.listdir(folder) if n.endswith(".tmp")]
