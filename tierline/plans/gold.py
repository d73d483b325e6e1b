"""Star schema: dimensions, the order fact, and aggregate marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline import settings
from tierline.functions import dates, labels, money
from tierline.functions.keys import surrogate
from tierline.operators.audit import stamp
from tierline.operators.clean import dedup_latest
from tierline.operators.joins import null_safe_join
from tierline.operators.windows import top_k
from tierline.settings import Run

# The columns of each star table; a pair renames.
PRODUCT_COLUMNS = [
    "product_id", "product_name", "category", "category_group", "price", "price_with_tax",
    "price_tier", "stock_qty", "stock_status", "inventory_value", "supplier_id",
    ("country", "supplier_country"), "is_domestic_supplier",
]
CUSTOMER_COLUMNS = [
    "customer_id", "first_name", "last_name", ("display_name", "full_name"), "email", "phone", "city",
    "country", "region", "signup_date", "tenure_days", "tenure_bucket", "seniority_rank",
    "is_active", "is_valid_email",
]
FACT_COLUMNS = [
    "order_id", "product_id", "order_date", "order_year", "order_month", "order_day",
    "order_weekday", "is_weekend", ("price", "unit_price"), "revenue", "revenue_with_tax",
    "net_revenue", "price_bucket", "rating_rate", "rating_count", "is_highly_rated",
    "rank_in_category", "price_change", "category",
]


def _pick(df: DataFrame, columns: list) -> DataFrame:
    pairs = [c if isinstance(c, tuple) else (c, c) for c in columns]
    return df.select(*[F.col(source).alias(name) for source, name in pairs])


def _stamp(df: DataFrame, source: str, run: Run) -> DataFrame:
    return stamp(df, "gold", source, run.name, run.env, run.ts)


def dim_product(products: DataFrame, run: Run = Run()) -> DataFrame:
    rows = dedup_latest(_pick(products, PRODUCT_COLUMNS), ["product_id"])
    return _stamp(rows, run.table("silver", "silver_products_transformed"), run)


def dim_customer(customers: DataFrame, run: Run = Run()) -> DataFrame:
    rows = dedup_latest(_pick(customers, CUSTOMER_COLUMNS), ["customer_id"])
    return _stamp(rows, run.table("silver", "silver_customers_transformed"), run)


def _date_columns(days: DataFrame, run: Run) -> DataFrame:
    rows = days.withColumns(
        dates.date_parts(F.col("full_date")) | {"season": labels.season(F.month("full_date"))}
    )
    return _stamp(rows, "generated", run)


def dim_date(
    spark: SparkSession,
    start: dt.date = settings.DATE_RANGE[0],
    end: dt.date = settings.DATE_RANGE[1],
    run: Run = Run(),
) -> DataFrame:
    """One row per day from ``start`` to ``end``."""
    days = F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day")))
    return _date_columns(spark.range(1).select(days.alias("full_date")), run)


def dim_date_covering(df: DataFrame, column: str, run: Run = Run()) -> DataFrame:
    """One row per day between the first and last date found in ``df``."""
    ends = df.agg(F.min(column).cast("date").alias("first"), F.max(column).cast("date").alias("last"))
    days = F.explode(F.sequence("first", "last", F.expr("interval 1 day")))
    return _date_columns(ends.select(days.alias("full_date")), run)


def fact_orders(
    orders: DataFrame, run: Run = Run(), business_key: tuple[str, ...] = ("order_id",), key_mode: str = "md5"
) -> DataFrame:
    """The order fact, keyed by a surrogate of ``business_key``. Carries customer_id where orders do."""
    columns = FACT_COLUMNS + [c for c in ("customer_id",) if c in orders.columns]
    keyed = _pick(orders, columns).withColumn("order_sk", surrogate(*business_key, mode=key_mode))
    return _stamp(keyed, run.table("silver", "silver_orders_transformed"), run)


def _aggregate(
    fact: DataFrame, groups: list[str], measures: dict[str, Column], distinct: str, name: str, estimate: bool
) -> DataFrame:
    """``measures`` per group, and the distinct count of one column under ``name``.

    In one aggregation an exact distinct count makes every measure's buffer cross the shuffle once per
    (group, value), which is close to once per row. Counted apart, the measures combine to one row per
    group in each map task, and only the bare (group, value) pairs are shuffled. The fact is read
    twice for it, with few columns; it should be a stored table. An estimate needs one reading.
    """
    columns = [value.alias(alias) for alias, value in measures.items()]
    if estimate:
        return fact.groupBy(*groups).agg(*columns, F.approx_count_distinct(distinct).alias(name))
    pairs = fact.select(*groups, distinct).distinct()
    counted = pairs.groupBy(*groups).agg(F.count(distinct).alias(name))
    return null_safe_join(fact.groupBy(*groups).agg(*columns), counted, groups)


def sales_by_category(fact: DataFrame, run: Run = Run(), estimate_distinct: bool = False) -> DataFrame:
    measures = {
        "total_revenue": money.total(F.col("revenue")),
        "total_revenue_with_tax": money.total(F.col("revenue_with_tax")),
        "avg_price": money.mean(F.col("unit_price")),
        "total_orders": F.count("order_id"),
        "max_price": F.max("unit_price"),
        "min_price": F.min("unit_price"),
        "avg_rating": money.mean(F.col("rating_rate")),
    }
    groups = ["category", "order_year", "order_month"]
    rows = _aggregate(fact, groups, measures, "product_id", "unique_products", estimate_distinct)
    return _stamp(rows, run.table("gold", "fact_orders"), run)


def sales_by_month_sketched(fact: DataFrame, run: Run = Run()) -> DataFrame:
    """Sales by category and month whose distinct products stay a sketch, so that months can be united.

    One pass and one shuffled row per group and task; the sketches hold a few kilobytes each, whatever the
    number of products.
    """
    rows = fact.groupBy("category", "order_year", "order_month").agg(
        money.total(F.col("revenue")).alias("total_revenue"),
        F.count("order_id").alias("total_orders"),
        F.hll_sketch_agg("product_id", F.lit(settings.SKETCH_BITS)).alias("products_sketch"),
    )
    return _stamp(rows, run.table("gold", "fact_orders"), run)


def sales_by_year(months: DataFrame, run: Run = Run()) -> DataFrame:
    """The years of ``sales_by_month_sketched``, without reading the fact again.

    ``unique_products`` is an estimate, off by 1.04 / sqrt(2 ** ``settings.SKETCH_BITS``) (one standard error).
    """
    rows = months.groupBy("category", "order_year").agg(
        money.total(F.col("total_revenue")).alias("total_revenue"),
        F.sum("total_orders").alias("total_orders"),
        F.hll_sketch_estimate(F.hll_union_agg("products_sketch")).alias("unique_products"),
    )
    return _stamp(rows, run.table("gold", "agg_sales_by_month"), run)


def sales_by_date(fact: DataFrame, run: Run = Run(), estimate_distinct: bool = False) -> DataFrame:
    measures = {
        "daily_revenue": money.total(F.col("revenue")),
        "daily_orders": F.count("order_id"),
        "avg_order_value": money.mean(F.col("unit_price")),
    }
    groups = ["order_year", "order_month", "order_day", "is_weekend"]
    rows = _aggregate(fact, groups, measures, "product_id", "unique_products_sold", estimate_distinct)
    return _stamp(rows, run.table("gold", "fact_orders"), run)


def top_products(fact: DataFrame, products: DataFrame, run: Run = Run(), k: int | None = None) -> DataFrame:
    """Products by revenue, all of them or the first ``k``.

    The fact is aggregated before the join, and with ``k`` also limited before it.
    """
    rows = fact.groupBy("product_id").agg(
        money.total(F.col("revenue")).alias("total_revenue"),
        F.count("order_id").alias("total_orders"),
        money.mean(F.col("rating_rate")).alias("avg_rating"),
    )
    order = [F.desc("total_revenue"), F.asc("product_id")]
    if k is not None:
        rows = top_k(rows, order, k)
    details = products.select("product_id", "product_name", "category", "category_group", "price_tier")
    rows = rows.join(details, "product_id", "left").orderBy(*order)
    return _stamp(rows, run.table("gold", "fact_orders"), run)


# Folders of a stored fact, by the column of the date dimension that each one holds.
DATE_FOLDERS = {"order_year": "year", "order_month": "month"}


def star(
    fact: DataFrame,
    date_dim: DataFrame | None = None,
    customer_dim: DataFrame | None = None,
    product_dim: DataFrame | None = None,
    folders: dict[str, str] | None = None,
) -> DataFrame:
    """The fact with its dimensions' columns, left-joined; names clashing with the fact get a prefix.

    No hint is given: Spark broadcasts a dimension while its size allows, and otherwise shuffles
    with AQE splitting the partitions of hot keys.

    ``folders`` names the columns a stored fact is partitioned by that follow from its date, each with the
    date dimension's column it equals (``DATE_FOLDERS``). They are joined on besides the date. This changes
    no row, but a later filter on any column of the date dimension, such as a season, then prunes the
    fact's folders when the query runs, which a date alone cannot. A fact whose folders contradict its
    dates finds no day for those rows. Filters on a large dimension reach the fact as bloom filters once
    Spark expects them to pay.
    """
    joined = fact
    parts = (
        (date_dim, "full_date", F.to_date("order_date"), "date_"),
        (customer_dim, "customer_id", F.col("customer_id"), "customer_"),
        (product_dim, "product_id", F.col("product_id"), "product_"),
    )
    for dim, key, fact_key, prefix in parts:
        if dim is None:
            continue
        columns = [c for c in dim.columns if c != key and not c.startswith("_")]
        own = (folders or {}) if dim is date_dim else {}
        renamed = dim.select(
            F.col(key).alias("__dim_key"),
            *[F.col(c).alias(f"__dim_{folder}") for folder, c in own.items()],
            *[F.col(c).alias(prefix + c if c in joined.columns else c) for c in columns],
        )
        met = [fact_key == F.col("__dim_key"), *[F.col(folder) == F.col(f"__dim_{folder}") for folder in own]]
        joined = joined.join(renamed, met, "left").drop("__dim_key", *[f"__dim_{folder}" for folder in own])
    return joined
