"""Transformed orders and their marts that follow a delivery of raw orders instead of being rebuilt.

From touched keys to touched groups: the products of replaced, new and vanished orders have their price
changes computed anew; a rating's rank in its category is a property of the distinct ratings, so only
the ratings whose rank has moved touch further rows; and a mart recomputes the groups that changed rows
leave or enter. Rows that come out as they were are not written, and the table is rewritten folder by
folder, so a small delivery costs its folders and groups and not the table.

The marts are committed before the table. A run that dies in between is repeated from the same delivery
with the same result, as all it takes from the table is unchanged until the last step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.operators import incremental
from tierline.operators.joins import null_safe_join
from tierline.operators.upsert import folders_in
from tierline.operators.windows import dense_rank_within
from tierline.plans import gold, silver
from tierline.session import stage
from tierline.settings import PARTITION_COLUMNS, Run

ORDERS = "silver_orders_transformed"
GONE = "_gone"  # marks orders whose last delivery is not valid
FOLDERS = PARTITION_COLUMNS["orders"]
RATING = ["category", "rating_rate"]
MARTS = {
    "agg_sales_by_category": (gold.sales_by_category, ["category", "order_year", "order_month"]),
    "agg_sales_by_date": (gold.sales_by_date, ["order_year", "order_month", "order_day", "is_weekend"]),
}


def orders(spark: SparkSession, root: str) -> DataFrame | None:
    """The transformed orders below ``root``, or None before the first delivery."""
    rows = incremental.current(spark, root, ORDERS)
    return None if rows is None else rows.filter(~F.col(GONE)).drop(GONE)


def mart(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    return incremental.current(spark, root, name)


def _ranks(rows: DataFrame) -> DataFrame:
    return dense_rank_within(rows.select(*RATING).distinct(), ["category"], "rating_rate", "rank_in_category", rows_per_task=None)


def _changed(before: DataFrame, raw: DataFrame, fresh: DataFrame, run: Run) -> DataFrame:
    """The orders that the delivery changes, as they come out, and those it takes away."""
    keys = raw.select("order_id").filter("order_id is not null").distinct()
    replaced = before.join(keys, "order_id", "left_semi")
    left = before.join(keys, "order_id", "left_anti")
    products = stage(replaced.select("product_id").union(fresh.select("product_id")).distinct(), "products")
    after = left.select(*fresh.columns).unionByName(fresh)
    ranks = stage(_ranks(after), "ranks")
    moved = null_safe_join(ranks, before.select(*RATING, "rank_in_category").distinct(), [*RATING, "rank_in_category"], "left_anti")

    anew = silver.transform_orders(null_safe_join(after, products, ["product_id"], "left_semi"), run, ranks)
    found = ["prev_price", "rank_in_category"]
    was = left.select("order_id", F.struct(*found).alias("__was"))
    compared = anew.join(was, "order_id", "left")
    differs = F.col("__was").isNull() | ~F.struct(*found).eqNullSafe(F.col("__was"))
    anew = compared.filter(differs).drop("__was")
    others = null_safe_join(left, products, ["product_id"], "left_anti").drop("rank_in_category")
    reranked = null_safe_join(others, moved, RATING, "inner")
    gone = replaced.join(fresh.select("order_id"), "order_id", "left_anti")
    parts = [(anew, False), (reranked, False), (gone, True)]
    marked = [rows.select(*before.columns, F.lit(is_gone).alias(GONE)) for rows, is_gone in parts]
    return stage(marked[0].unionByName(marked[1]).unionByName(marked[2]), "changed")


def _follow_mart(spark: SparkSession, root: str, name: str, before: DataFrame, changed: DataFrame, run: Run) -> None:
    """Recompute the groups that changed rows leave or enter, from the folders that hold them."""
    build, groups = MARTS[name]
    ids = changed.select("order_id")
    live = changed.filter(~F.col(GONE)).drop(GONE)
    left = before.join(ids, "order_id", "left_semi").select(*groups)
    touched = stage(left.union(live.select(*groups)).distinct(), "groups")
    kept = folders_in(before, touched, [c for c in FOLDERS if c in groups]).join(ids, "order_id", "left_anti")
    rows = null_safe_join(kept.unionByName(live), touched, groups, "left_semi")
    made = build(gold.fact_orders(rows, run), run)
    old = incremental.current(spark, root, name)
    incremental.commit(spark, null_safe_join(old, touched, groups, "left_anti").unionByName(made), root, name, None)


def follow_orders(spark: SparkSession, root: str, raw: DataFrame, run: Run = Run()) -> None:
    """Bring the tables below ``root`` up to date with delivered raw orders; the first delivery makes them.

    An order that was there is replaced by its last row in the delivery, or taken away where that row is
    not valid. Fixed ``run.ts`` makes repeated runs equal in the audit columns too.
    """
    raw = stage(raw, "delivery")
    fresh = stage(silver.clean_orders(raw, run), "fresh")
    before = orders(spark, root)
    if before is None:
        rows = stage(silver.transform_orders(fresh, run), "orders")
        for name, (build, _) in MARTS.items():
            incremental.commit(spark, build(gold.fact_orders(rows, run), run), root, name, None)
        incremental.commit(spark, rows.withColumn(GONE, F.lit(False)), root, ORDERS, None, FOLDERS)
        return
    changed = _changed(before, raw, fresh, run)
    if changed.isEmpty():
        return
    for name in MARTS:
        _follow_mart(spark, root, name, before, changed, run)
    incremental.upsert_rows(spark, changed, root, ORDERS, "order_id", None, None, FOLDERS)
