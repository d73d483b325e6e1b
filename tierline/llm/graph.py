"""Joins on keys that may be hot, and connected components of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.session import stage

HOT_PARTS = 1000  # a key is hot beyond this fraction of the rows, so there are fewer hot keys than this


def attach(rows: DataFrame, table: DataFrame, key: str, counts: DataFrame) -> DataFrame:
    """``rows`` left-joined with ``table``, which has one row a key.

    ``counts`` holds (key, n): how many of ``rows`` have the key. The fewer than HOT_PARTS keys that have
    more than 1 / HOT_PARTS of all rows are broadcast; the others are shuffled. Keys are not null.
    """
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = stage(counts.filter(F.col("n") > max(10_000, total / HOT_PARTS)).select(key), "hot")
    if hot.limit(1).count() == 0:
        return rows.join(table, key, "left")
    small = F.broadcast(hot)
    spread = rows.join(small, key, "left_anti").join(table, key, "left")
    hot_table = table.join(small, key, "left_semi")
    gathered = rows.join(small, key, "left_semi").join(F.broadcast(hot_table), key, "left")
    return spread.unionByName(gathered)


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (a, b), longs: component is the smallest id reachable.

    Alternating large-star and small-star steps: each points a vertex's neighbours at the smallest of
    them, until all edges are stars. Every step is written to the shared folder, so a lost executor
    costs one step at most, and only counts come to the driver.
    """
    ordered = links.filter("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
    edges = stage(ordered.distinct(), "edges")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        edges = stage(_large_star(both), "edges")
        edges = stage(_small_star(edges), "edges")
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    roots = edges.select(F.col("u").alias("id"), F.col("u").alias("component")).distinct()
    return edges.select(F.col("v").alias("id"), F.col("u").alias("component")).unionByName(roots)


def _least(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    found = stage(edges.groupBy("v").agg(F.min("u").alias("m"), F.count(F.lit(1)).alias("n")), "least")
    return found.select("v", F.least("v", "m").alias("m")), found.select("v", "n")


def _large_star(both: DataFrame) -> DataFrame:
    least, counts = _least(both)
    joined = attach(both, least, "v", counts).filter("u > v")
    return joined.select(F.col("u").alias("v"), F.col("m").alias("u")).filter("v <> u").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least, counts = _least(edges)
    moved = attach(edges, least, "v", counts).filter("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
    return moved.unionByName(least.select("v", F.col("m").alias("u"))).distinct()
