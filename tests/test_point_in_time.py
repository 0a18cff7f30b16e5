"""The version in force at a row's place, against a plain search, also with hot keys cut."""

import random

import pytest
from pyspark.sql import functions as F

from dimweave.operators.facts import key_in_force
from dimweave.operators.ordered import CHUNK

VERSIONS = "k string, b int, e int, id int"
ROWS = "n int, key string, day int, b string, _note string"


def model(versions, rows, missing):
    out = []
    for n, key, day, *rest in rows:
        begun = [v for v in versions if key is not None and day is not None and v[0] == key and (v[1] is None or v[1] <= day)]
        last = max(begun, key=lambda v: (v[1] is not None, v[1] or 0, v[3])) if begun else None
        held = last is not None and (last[2] is None or day < last[2])
        out.append((n, key, day, *rest, last[3] if held else missing))
    return sorted(out, key=str)


def run(spark, versions, rows, chunk_rows, missing=-1):
    got = key_in_force(spark.createDataFrame(rows, ROWS), spark.createDataFrame(versions, VERSIONS), key=F.col("key"), at=F.col("day"),
                       version_key="k", begins="b", ends="e", value="id", out="member", missing=F.lit(missing), chunk_rows=chunk_rows)
    assert got.columns == ["n", "key", "day", "b", "_note", "member"]
    return got


@pytest.mark.parametrize("chunk_rows", [5, 1_000_000])
def test_every_row_meets_the_version_in_force(spark, chunk_rows):
    rng = random.Random(11)
    versions, rows, ids = [], [], iter(range(10_000))
    for key in ["hot", "a", "b", "", "only-versions"]:
        begins = sorted(rng.sample(range(1000), 30 if key == "hot" else 4))
        for i, b in enumerate(begins):
            nxt = begins[i + 1] if i + 1 < len(begins) else None
            versions.append((key, b, nxt if rng.random() < 0.8 else b + 3, next(ids)))
    versions += [("a", None, 5, next(ids)), (None, 1, None, next(ids)), ("b", begins[0], None, next(ids))]
    for n in range(600):
        key = "hot" if n % 3 == 0 else rng.choice(["a", "b", "", "unknown", None])
        rows.append((n, key, rng.choice([None, *range(-5, 1010)]), "x", None))
    rows += [rows[0], rows[0]]  # repeated rows stay repeated
    assert sorted(map(tuple, run(spark, versions, rows, chunk_rows).collect()), key=str) == model(versions, rows, -1)


def test_bounds_and_empty_sides(spark):
    versions = [("a", 3, 5, 1), ("a", 5, None, 2)]
    rows = [(i, "a", d, None, None) for i, d in enumerate([2, 3, 4, 5, 9, None])]
    assert [r.member for r in run(spark, versions, rows, 1000).orderBy("n").collect()] == [-1, 1, 1, 2, 2, -1]
    assert [r.member for r in run(spark, [], rows, 1000).collect()] == [-1] * 6
    assert run(spark, versions, [], 1000).count() == 0


def test_a_hot_key_is_cut_and_there_is_no_range_join(spark):
    rows = spark.range(20_000).selectExpr("'hot' AS key", "CAST(id AS INT) AS day")
    versions = spark.createDataFrame([("hot", 0, None, 1)], VERSIONS)
    got = key_in_force(rows, versions, key=F.col("key"), at=F.col("day"), version_key="k", begins="b", ends="e", value="id",
                       out="member", chunk_rows=1000)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "NestedLoop" not in got._jdf.queryExecution().sparkPlan().toString() and CHUNK in plan
    assert got.filter("member = 1").count() == 20_000
