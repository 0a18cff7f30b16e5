"""A versioned, key-bucketed table store for micro-batch loads.

Micro-batch ``b`` reads version ``b`` and writes version ``b + 1``.  A table is split
into ``buckets`` by a hash of its key; a version writes only the buckets its batch
touched (bucket-level copy-on-write, ``partitionBy`` on the bucket) and a small
manifest per version records, for each bucket, the version that holds its rows.  So a
micro-batch costs the size of the buckets it touches, not the size of the dimension.

A batch that is run again after a failure (same batch id, same input) reads the same
version ``b`` and rewrites version ``b + 1`` and its manifest with the same rows, so a
retry changes nothing.  A version is published by its manifest, which is written beside its
place and renamed into it once the data are complete; the latest version is the last one with a
manifest.  No file is ever changed in place, so a reader finds a version whole or not at all.  All paths go through the Hadoop file
system, so any store Spark can write (HDFS, object stores) works.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFESTS = "_manifest"
BUCKET = "_dw_bucket"
#: Buckets of a store unless its maker says otherwise: choose about as many as a micro-batch
#: should be able to rewrite apart from each other.  A bucket of any size is written by as many
#: tasks as its rows need.
BUCKETS = 16


def bucket_of(key: Column | str, buckets: int) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.xxhash64(k), F.lit(buckets)).cast("int")


class VersionedStore:
    """``buckets``: number of key-hash buckets (``BUCKETS`` unless given).  Once written, the
    count is read back from the manifest, so every version of a store uses the same buckets.
    ``retain``: after each write, delete what none of the last ``retain`` versions holds
    (``expire``); without it everything stays."""

    def __init__(self, spark: SparkSession, root: str, *, key: str = "id", buckets: int | None = None,
                 retain: int | None = None):
        if retain is not None and retain < 2:
            raise ValueError("retain at least 2 versions: a batch that runs again reads the one before the latest")
        self.spark = spark
        self.retain = retain
        self.root = root.rstrip("/")
        self.key = key
        self.buckets = buckets or BUCKETS
        v = self.latest()
        if v is not None:
            self.buckets = int(self.manifest(v)["_buckets"])

    # -- file system helpers (Hadoop FS through the JVM: works for every scheme)
    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _read_text(self, path: str) -> str | None:
        p, fs = self._fs(path)
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            jio = self.spark._jvm.java.io
            reader = jio.BufferedReader(jio.InputStreamReader(stream, "UTF-8"))
            lines = []
            line = reader.readLine()
            while line is not None:
                lines.append(line)
                line = reader.readLine()
            return "\n".join(lines)
        finally:
            stream.close()

    def _publish(self, path: str, text: str) -> None:
        """``text`` as a whole file under ``path``.  A batch that runs again publishes the same text,
        which is left as it is."""
        if self._read_text(path) == text:
            return
        p, fs = self._fs(path)
        beside, _ = self._fs(posixpath.join(posixpath.dirname(path), f"_{uuid.uuid4().hex}.tmp"))
        out = fs.create(beside, False)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        if fs.rename(beside, p):
            return
        # Another text is there: a store whose input or bucket count was changed under it.
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        rename = getattr(hadoop, "Options$Rename")
        over = self.spark.sparkContext._gateway.new_array(rename, 1)
        over[0] = rename.OVERWRITE
        files = hadoop.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        files.rename(fs.makeQualified(beside), fs.makeQualified(p), over)

    def _names(self, path: str) -> list[str]:
        p, fs = self._fs(path)
        return [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []

    def _listed_buckets(self, path: str) -> set[int]:
        p, fs = self._fs(path)
        if not fs.exists(p):
            return set()
        out = set()
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            if st.isDirectory() and name.startswith(f"{BUCKET}="):
                out.add(int(name.split("=", 1)[1]))
        return out

    def delete(self, path: str) -> bool:
        p, fs = self._fs(path)
        return bool(fs.delete(p, True))

    # -- versions and manifests
    def _data_path(self, part: str, version: int) -> str:
        return posixpath.join(self.root, part, f"v={version}")

    def _manifest_path(self, version: int) -> str:
        return posixpath.join(self.root, MANIFESTS, f"v={version}.json")

    def latest(self) -> int | None:
        there = self.versions()
        return there[-1] if there else None

    def manifest(self, version: int) -> dict:
        text = self._read_text(self._manifest_path(version))
        if text is None:
            raise FileNotFoundError(f"no version {version} under {self.root}")
        return json.loads(text)

    # -- reads
    def value(self, version: int, name: str, default: int) -> int:
        return int(self.manifest(version).get("_values", {}).get(name, default))

    def versions(self) -> list[int]:
        """Versions whose manifest is there."""
        return sorted(int(n[2:-5]) for n in self._names(posixpath.join(self.root, MANIFESTS)) if n.startswith("v="))

    def expire(self, keep: int, *, outputs: bool = False) -> int:
        """Delete the bucketed rows that none of the last ``keep`` versions holds, and count the
        folders deleted.  A batch's own rows (plain parts, such as late rows) are read by version and
        stay, with their manifests; ``outputs`` deletes those of older versions too."""
        last = self.latest()
        if last is None:
            return 0
        kept = {v: self.manifest(v) for v in self.versions() if v > last - keep}
        parts = {p: e for p, e in self.manifest(last).items() if not p.startswith("_")}
        gone = 0
        for part, entry in parts.items():
            held = {(v, int(b)) for m in kept.values() for b, v in m.get(part, {}).get("buckets", {}).items()}
            for name in self._names(posixpath.join(self.root, part)):
                v, path = int(name[2:]), posixpath.join(self.root, part, name)
                if v > last - keep or (entry["kind"] == "plain" and not outputs):
                    continue
                if entry["kind"] == "plain" or not any(h == v for h, _ in held):
                    gone += self.delete(path)
                    continue
                for b in self._listed_buckets(path):
                    if (v, b) not in held:
                        gone += self.delete(posixpath.join(path, f"{BUCKET}={b}"))
        if outputs:
            for v in self.versions():
                if v not in kept:
                    self.delete(self._manifest_path(v))
        return gone

    def parts(self, version: int) -> list[str]:
        return [p for p in self.manifest(version) if not p.startswith("_")]

    def read(self, version: int, part: str, buckets: Iterable[int] | None = None) -> DataFrame:
        """Rows of ``part`` as of ``version`` (only the given buckets when set)."""
        entry = self.manifest(version)[part]
        schema = T.StructType.fromJson(json.loads(entry["schema"]))
        if entry["kind"] == "plain":
            return self.spark.read.schema(schema).parquet(self._data_path(part, entry["version"]))
        wanted = None if buckets is None else set(buckets)
        paths = [posixpath.join(self._data_path(part, v), f"{BUCKET}={b}")
                 for b, v in sorted((int(b), v) for b, v in entry["buckets"].items())
                 if wanted is None or b in wanted]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def read_latest(self, part: str) -> DataFrame:
        v = self.latest()
        if v is None:
            raise FileNotFoundError(f"no version under {self.root}")
        return self.read(v, part)

    def touched_buckets(self, keys: DataFrame) -> list[int]:
        """Buckets of the given keys: at most ``buckets`` small numbers to the driver."""
        if self.buckets == 1:
            return [0]
        return [r[0] for r in keys.select(bucket_of(self.key, self.buckets).alias("b")).distinct().collect()]

    # -- writes
    def write(self, version: int, bucketed: dict[str, DataFrame], *, touched: Iterable[int] | None = None,
              plain: dict[str, DataFrame] | None = None, base: int | None = None,
              values: dict[str, int] | None = None, empty: dict[str, T.StructType] | None = None) -> None:
        """Write ``version``.  ``bucketed`` parts hold all rows of the ``touched``
        buckets (every bucket when ``touched`` is None); other buckets carry over
        from version ``base``.  ``values``: small named numbers kept with the version
        (e.g. the next surrogate key).  ``empty``: bucketed parts that start without rows
        (recorded by schema, nothing written)."""
        prev = self.manifest(base) if base is not None else {}
        touched_set = None if touched is None else set(touched)
        manifest = {}
        for part, df in bucketed.items():
            path = self._data_path(part, version)
            # Dealt by bucket, and evened out at run time: small buckets share a task, a large
            # one (or one with a hot key) is split over several.
            (df.withColumn(BUCKET, bucket_of(self.key, self.buckets)).hint("rebalance", BUCKET)
             .write.mode("overwrite").partitionBy(BUCKET).parquet(path))
            written = self._listed_buckets(path)
            old = {int(b): v for b, v in prev.get(part, {}).get("buckets", {}).items()}
            new = {b: v for b, v in old.items() if touched_set is not None and b not in touched_set}
            new.update({b: version for b in written})
            manifest[part] = {"kind": "bucketed", "schema": df.schema.json(),
                              "buckets": {str(b): v for b, v in sorted(new.items())}}
        for part, schema in (empty or {}).items():
            manifest[part] = {"kind": "bucketed", "schema": schema.json(), "buckets": {}}
        for part, df in (plain or {}).items():
            df.write.mode("overwrite").parquet(self._data_path(part, version))
            manifest[part] = {"kind": "plain", "schema": df.schema.json(), "version": version}
        for part, entry in prev.items():
            manifest.setdefault(part, entry)
        manifest["_buckets"] = self.buckets
        manifest["_values"] = {**prev.get("_values", {}), **(values or {})}
        self._publish(self._manifest_path(version), json.dumps(manifest))
        if self.retain is not None:
            self.expire(self.retain)
