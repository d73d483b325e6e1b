"""Times textbook formulations of some headline queries, as a yardstick for bench.py.

Same inputs and settings as bench.py, prints the same kind of line. The formulations use double
arithmetic, arbitrary dedup survivors and one window over all rows: quick to write, but inexact, not
repeatable, or bound to one task per group.
"""

from __future__ import annotations

import json
import os
import statistics

from pyspark.sql import Window
from pyspark.sql import functions as F

from bench import seconds
from tierline.registry import inputs
from tierline.session import local_session


def _lines(spark, sf):
    return inputs.order_lines(spark, sf)


def sales_by_category(spark, sf):
    price, date = F.col("price"), F.col("order_date")
    lines = _lines(spark, sf).select(
        F.lower(F.trim("category")).alias("category"),
        "order_id",
        "product_id",
        "price",
        "rating_rate",
        F.year(date).alias("y"),
        F.month(date).alias("m"),
        F.round(price, 2).alias("revenue"),
        F.round(price * 1.18, 2).alias("taxed"),
    )
    return lines.groupBy("category", "y", "m").agg(
        F.round(F.sum("revenue"), 2),
        F.round(F.sum("taxed"), 2),
        F.round(F.avg("price"), 2),
        F.count("order_id"),
        F.countDistinct("product_id"),
        F.max("price"),
        F.min("price"),
        F.round(F.avg("rating_rate"), 2),
    )


def rank_in_category(spark, sf):
    window = Window.partitionBy("category").orderBy(F.desc("rating_rate"))
    lines = _lines(spark, sf).select("order_id", "product_id", "category", "rating_rate")
    return lines.withColumn("r", F.dense_rank().over(window))


def rank_by_price(spark, sf):
    window = Window.partitionBy("category").orderBy("price")
    return _lines(spark, sf).select("order_id", "category", "price").withColumn("r", F.dense_rank().over(window))


def price_change(spark, sf):
    lines = inputs.load(spark, sf, "lineitem")
    previous = F.lag("l_extendedprice").over(Window.partitionBy("l_partkey").orderBy("l_shipdate"))
    change = F.round(F.col("l_extendedprice") - F.coalesce("prev", "l_extendedprice"), 2)
    return lines.select("l_partkey", "l_shipdate", "l_extendedprice", previous.alias("prev")).withColumn("c", change)


def dedup_latest(spark, sf):
    return inputs.load(spark, sf, "lineitem").dropDuplicates(["l_orderkey"])


def revenue_tax(spark, sf):
    price = F.col("o_totalprice")
    return inputs.load(spark, sf, "orders").select(
        "o_orderkey", F.round(price, 2), F.round(price * 1.18, 2), F.round(price, 2).alias("n"), price * 1.18
    )


PLAIN = [sales_by_category, rank_in_category, rank_by_price, price_change, dedup_latest, revenue_tax]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session("tierline-bench-plain", os.environ.get("BENCH_CPUS", "*"))
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for query in PLAIN:
        seconds(lambda: query(spark, sf))
        median = statistics.median(seconds(lambda: query(spark, sf)) for _ in range(runs))
        timings[query.__name__] = round(median, 3)
    spark.stop()
    print(json.dumps({"metric": "textbook_formulations", "unit": "sec", "queries": timings}))


if __name__ == "__main__":
    main()
