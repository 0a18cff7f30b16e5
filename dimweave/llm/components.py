"""Connected components of links between whole numbers, by alternating stars.

Each round points every node's larger neighbours at its smallest one (large star), then its
smaller ones and itself (small star), until each component is one star around its smallest node;
links that are such stars from the start take no round.
Minima are partial aggregates and the joins are ordinary ones that Spark splits where a node has
very many links; links never leave the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimweave.session import ensure_checkpoint_dir


def _both(a: str, b: str, c: str, d: str) -> Column:
    """Two links (a, b) from one row."""
    return F.inline(F.array(F.struct(F.col(a).alias("a"), F.col(b).alias("b")), F.struct(F.col(c).alias("a"), F.col(d).alias("b"))))


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links (a, b), a > b, distinct."""
    both = links.select(_both("a", "b", "b", "a")) if large else links
    least = both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
    moved = both.join(least, F.col("a") == F.col("u"))
    if large:  # larger neighbours to the node's smallest
        out = moved.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:  # smaller neighbours, and the node itself
        out = moved.select(_both("b", "m", "u", "m"))
    return out.filter("a <> b").distinct()


def _are_stars(links: DataFrame) -> bool:
    """Whether every node with a smaller neighbour has only that one, and no larger ones.  Such
    links stay as they are in any further round."""
    ends = links.select(F.inline(F.array(F.struct(F.col("a").alias("u"), F.lit(1).alias("smaller"), F.lit(0).alias("larger")),
                                         F.struct(F.col("b").alias("u"), F.lit(0).alias("smaller"), F.lit(1).alias("larger")))))
    nodes = ends.groupBy("u").agg(F.sum("smaller").alias("smaller"), F.max("larger").alias("larger"))
    return not nodes.agg(F.max((F.col("smaller") > 0) & (F.col("smaller") + F.col("larger") > 1)).alias("other")).collect()[0]["other"]


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): every linked node with the smallest node of its component, itself included.
    Links may point either way, repeat or be loops; an empty table gives an empty result."""
    ensure_checkpoint_dir(links.sparkSession)
    now = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct().checkpoint()
    while not _are_stars(now):
        now = _star(_star(now, large=True), large=False).checkpoint()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
