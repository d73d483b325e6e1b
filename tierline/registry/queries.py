"""One query per operator, over whole test tables."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.functions import dates, keys, labels, money, records, text
from tierline.operators import audit, clean, incremental, joins, layout, numbering, quality, upsert, windows
from tierline.plans import bronze, delta, gold, layers, silver
from tierline.registry import inputs
from tierline.registry.inputs import RUN, load
from tierline.session import scratch_path, stage
from tierline.sources import files, tables
from tierline.streaming.load import stream_upsert

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _business(df: DataFrame) -> DataFrame:
    """Without audit columns; timestamps without zone, as in the test tables."""
    kept = df.select(*[c for c in df.columns if not c.startswith("_")])
    zoned = [f.name for f in kept.schema if f.dataType.typeName() == "timestamp"]
    return kept.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


# --- Marts, star ------------------------------------------------------------------------------


@query
def sales_by_category(spark, sf):
    return _business(gold.sales_by_category(inputs.sale_lines(spark, sf), RUN))


@query
def sales_by_category_estimate(spark, sf):
    """The mart with estimated distinct counts, which need one shuffle less, held against the exact ones."""
    lines = inputs.sale_lines(spark, sf)
    mart = _business(gold.sales_by_category(lines, RUN, estimate_distinct=True))
    named = [name for name in ("category", "order_year", "order_month") if name in mart.columns]
    exact = lines.groupBy(*named).agg(F.countDistinct("product_id").alias("exact"))
    close = F.abs(F.col("unique_products") - F.col("exact")) <= 0.2 * F.col("exact")
    return joins.null_safe_join(mart, exact, named).withColumn("estimate_close", close).drop("unique_products", "exact")


@query
def sales_by_year_rollup(spark, sf):
    """Years united from a stored monthly mart, and whether the estimate of products is near the exact count."""
    lines = inputs.sale_lines(spark, sf)
    years = gold.sales_by_year(stage(_sketched_months(lines), "months"), RUN)
    exact = lines.groupBy("category", "order_year").agg(F.countDistinct("product_id").alias("exact"))
    near = F.abs(F.col("unique_products") - F.col("exact")) <= 0.05 * F.col("exact")
    joined = joins.null_safe_join(_business(years), exact, ["category", "order_year"])
    return joined.withColumn("estimate_is_near", near).drop("unique_products", "exact")


def _sketched_months(lines):
    return _business(gold.sales_by_month_sketched(lines, RUN))


@query
def sales_by_date(spark, sf):
    return _business(gold.sales_by_date(inputs.sale_lines(spark, sf), RUN))


def _product_dim(spark, sf):
    return gold.dim_product(
        silver.transform_products(silver.clean_products(inputs.products(spark, sf), RUN), RUN), RUN
    )


@query
def top_products(spark, sf):
    return _business(gold.top_products(inputs.sale_lines(spark, sf), _product_dim(spark, sf), RUN))


@query
def top_ten_products(spark, sf):
    return _business(gold.top_products(inputs.sale_lines(spark, sf), _product_dim(spark, sf), RUN, k=10))


@query
def top_k_per_category(spark, sf):
    revenue = (
        inputs.sale_lines(spark, sf)
        .groupBy("category", "product_id")
        .agg(money.total(F.col("revenue")).alias("total_revenue"))
    )
    return windows.top_k(revenue, [F.desc("total_revenue"), F.asc("product_id")], 5, ["category"])


@query
def dim_product(spark, sf):
    return _business(_product_dim(spark, sf))


def _silver_customers(spark, sf):
    return silver.transform_customers(silver.clean_customers(inputs.customers(spark, sf), RUN), RUN)


@query
def dim_customer(spark, sf):
    return _business(gold.dim_customer(_silver_customers(spark, sf), RUN))


@query
def dim_date(spark, sf):
    return _business(gold.dim_date_covering(load(spark, sf, "lineitem"), "l_shipdate", RUN))


def _silver_orders(spark, sf):
    cleaned = stage(silver.clean_orders(inputs.order_lines(spark, sf), RUN), "silver_orders")
    return silver.transform_orders(cleaned, RUN)


@query
def fact_orders(spark, sf):
    return _business(gold.fact_orders(_silver_orders(spark, sf), RUN))


@query
def star_by_season_region(spark, sf):
    lines = inputs.sale_lines(spark, sf).select("order_id", "product_id", "order_date", "revenue")
    buyers = load(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id")
    )
    customers = inputs.customers(spark, sf).select(
        "customer_id", labels.region(text.raised(F.col("country"))).alias("region")
    )
    products = inputs.products(spark, sf).filter(F.col("updated_at") == "2024-01-15")
    products = products.select(
        "product_id", labels.category_group(text.lowered(F.col("category"))).alias("category_group")
    )
    days = gold.dim_date_covering(load(spark, sf, "lineitem"), "l_shipdate", RUN)
    joined = gold.star(lines.join(buyers, "order_id", "left"), days, customers, products)
    return joined.groupBy("season", "region", "category_group").agg(
        money.total(F.col("revenue")).alias("total_revenue"), F.count("order_id").alias("total_orders")
    )


def _stored_sales(spark, sf) -> str:
    """Sale lines with their buyers in a folder for each month."""
    buyers = load(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id")
    )
    columns = ["order_id", "product_id", "order_date", "order_year", "order_month", "revenue"]
    lines = inputs.sale_lines(spark, sf).select(*columns)
    path = scratch_path(spark, "sales")
    layout.write_partitioned(lines.join(buyers, "order_id", "left"), path, ["order_year", "order_month"])
    return path


@query
def star_one_quarter(spark, sf):
    """The summer of one year over a fact in monthly folders, by the stored dimensions: a filter on the date
    dimension alone, so that only three folders are read."""
    customers = gold.dim_customer(_silver_customers(spark, sf), RUN).select("customer_id", "region")
    days = stage(gold.dim_date_covering(load(spark, sf, "lineitem"), "l_shipdate", RUN), "days")
    fact = spark.read.parquet(_stored_sales(spark, sf))
    joined = gold.star(fact, days, customers, _product_dim(spark, sf), gold.DATE_FOLDERS)
    summer = joined.filter((F.col("year") == 1997) & (F.col("season") == "Summer"))
    return summer.groupBy("year", "month", "region", "category_group", "supplier_country").agg(
        money.total(F.col("revenue")).alias("total_revenue"), F.count("order_id").alias("total_orders")
    )


@query
def orphans(spark, sf):
    stocked = load(spark, sf, "part").filter(F.col("p_type") != "PROMO")
    return quality.orphans(load(spark, sf, "lineitem"), stocked, "l_partkey", "p_partkey")


# --- Silver tables ----------------------------------------------------------------------------


@query
def silver_orders(spark, sf):
    return _business(silver.clean_orders(inputs.order_lines(spark, sf), RUN))


@query
def silver_products(spark, sf):
    return _business(silver.clean_products(inputs.products(spark, sf), RUN))


@query
def silver_customers(spark, sf):
    return _business(silver.clean_customers(inputs.customers(spark, sf), RUN))


@query
def silver_orders_transformed(spark, sf):
    return _business(_silver_orders(spark, sf))


@query
def silver_products_transformed(spark, sf):
    cleaned = silver.clean_products(inputs.products(spark, sf), RUN)
    return _business(silver.transform_products(cleaned, RUN))


@query
def silver_customers_transformed(spark, sf):
    return _business(_silver_customers(spark, sf))


# --- Cleaning ---------------------------------------------------------------------------------


@query
def dedup_latest(spark, sf):
    return clean.dedup_latest(load(spark, sf, "lineitem"), ["l_orderkey"], ["l_shipdate"])


@query
def dedup_latest_event(spark, sf):
    return clean.dedup_latest(load(spark, sf, "events"), ["user_id"], ["ts"], ["event_id"])


@query
def require_not_null(spark, sf):
    return _business(
        clean.require(inputs.customers(spark, sf), ["customer_id", "email", "signup_date"])
    )


@query
def valid_price(spark, sf):
    shifted = load(spark, sf, "events").withColumn("value", F.col("value") - 20)
    return clean.keep_positive(shifted, "value").select("event_id", "value")


@query
def text_normalise(spark, sf):
    rows = inputs.products(spark, sf).select(
        "product_id", "updated_at", "product_name", "category", "country", "supplier_id"
    )
    return clean.normalise(
        rows, trim=["product_name"], lower=["category"], upper=["country", "supplier_id"]
    )


@query
def email_flag(spark, sf):
    email = text.lowered(F.col("email"))
    return inputs.customers(spark, sf).select(
        "customer_id", email.alias("email"), text.is_valid_email(email).alias("is_valid_email")
    )


@query
def names_concat(spark, sf):
    first = F.trim("first_name")
    last = F.when(F.col("is_active") == 1, F.col("last_name"))
    return inputs.customers(spark, sf).select(
        "customer_id",
        text.full_name(first, last).alias("full_name"),
        text.display_name(first, last).alias("display_name"),
    )


@query
def stock_clamp(spark, sf):
    return inputs.products(spark, sf).select(
        "product_id", "updated_at", labels.clamp_low(F.col("stock_qty")).alias("stock_qty")
    )


# --- Derived columns --------------------------------------------------------------------------


@query
def price_bucket(spark, sf):
    return load(spark, sf, "events").select(
        "event_id", labels.price_bucket(F.col("value")).alias("price_bucket")
    )


@query
def stock_status(spark, sf):
    stock = labels.clamp_low(F.col("stock_qty"))
    return inputs.products(spark, sf).select(
        "product_id", "updated_at", labels.stock_status(stock).alias("stock_status")
    )


@query
def price_tier(spark, sf):
    return inputs.products(spark, sf).select(
        "product_id", "updated_at", labels.price_tier(F.col("price")).alias("price_tier")
    )


@query
def tenure_bucket(spark, sf):
    days = dates.tenure_days(F.col("signup_date"), RUN.as_of)
    return inputs.customers(spark, sf).select(
        "customer_id", days.alias("tenure_days"), labels.tenure_bucket(days).alias("tenure_bucket")
    )


@query
def category_group(spark, sf):
    category = text.lowered(F.col("category"))
    return inputs.order_lines(spark, sf).groupBy(labels.category_group(category).alias("category_group")).count()


@query
def region_map(spark, sf):
    country = text.raised(F.col("country"))
    return inputs.customers(spark, sf).select(
        "customer_id", country.alias("country"), labels.region(country).alias("region")
    )


@query
def region_lookup(spark, sf):
    nations = load(spark, sf, "nation").join(
        load(spark, sf, "region").filter(F.col("r_name") != "AFRICA"),
        F.col("n_regionkey") == F.col("r_regionkey"),
    )
    customers = load(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return joins.lookup(customers, nations, "c_nationkey", "n_nationkey", "r_name", "region", "OTHER")


@query
def flags(spark, sf):
    return inputs.order_lines(spark, sf).select(
        "order_id",
        "product_id",
        labels.is_highly_rated(F.col("rating_rate")).alias("is_highly_rated"),
        labels.is_domestic(F.upper("category")).alias("is_domestic"),
        labels.is_active(F.col("rating_count")).alias("is_active"),
    )


@query
def date_parts(spark, sf):
    return load(spark, sf, "orders").select(
        "o_orderkey",
        *[part.alias(name) for name, part in dates.date_parts(F.col("o_orderdate"), "order_").items()],
    )


@query
def is_weekend(spark, sf):
    return load(spark, sf, "events").select(
        "event_id", dates.is_weekend(F.dayofweek("ts")).alias("is_weekend")
    )


@query
def season_of_month(spark, sf):
    return load(spark, sf, "orders").select(
        "o_orderkey", labels.season(F.month("o_orderdate")).alias("season")
    )


@query
def parsed_timestamps(spark, sf):
    """Dates as text, a third of them in words no date pattern matches."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    raw = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("day "), day)).otherwise(day)
    return load(spark, sf, "orders").select(
        "o_orderkey", dates.parse_timestamp(raw).cast("timestamp_ntz").alias("order_date")
    )


@query
def revenue_tax(spark, sf):
    price = F.col("o_totalprice")
    return load(spark, sf, "orders").select(
        "o_orderkey",
        money.revenue(price).alias("revenue"),
        money.revenue_with_tax(price).alias("revenue_with_tax"),
        money.net_revenue(price).alias("net_revenue"),
        money.price_with_tax(price).alias("price_with_tax"),
    )


@query
def net_of_discount(spark, sf):
    net = money.net_revenue(F.col("l_extendedprice"), F.col("l_discount"))
    return load(spark, sf, "lineitem").select("l_orderkey", "l_partkey", net.alias("net_revenue"))


@query
def inventory_value(spark, sf):
    value = money.inventory_value(F.col("price"), F.col("stock_qty"))
    return inputs.products(spark, sf).select("product_id", "updated_at", value.alias("inventory_value"))


@query
def surrogate_keys(spark, sf):
    return load(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        keys.surrogate("l_orderkey", "l_partkey", "l_returnflag").alias("line_sk"),
    )


@query
def surrogate_unique(spark, sf):
    numbered = load(spark, sf, "orders").select(keys.surrogate("o_orderkey", mode="xxhash64").alias("order_sk"))
    return numbered.agg(F.count("order_sk").alias("rows"), F.countDistinct("order_sk").alias("keys"))


@query
def surrogate_monotonic_unique(spark, sf):
    numbered = load(spark, sf, "lineitem").select(keys.surrogate(mode="monotonic").alias("line_sk"))
    return numbered.agg(F.count("line_sk").alias("rows"), F.countDistinct("line_sk").alias("keys"))


@query
def surrogate_dense_two_runs(spark, sf):
    """Numbers of customers with an order: those of a first run keep theirs, a second run's follow without gaps."""
    path = scratch_path(spark, "numbers")
    for orders in (inputs.base_orders(spark, sf), load(spark, sf, "orders")):
        numbered = numbering.number_keys(orders.select("o_orderkey", "o_custkey"), path, ["o_custkey"], "customer_sk")
    return numbered


@query
def audit_columns(spark, sf):
    stamped = audit.stamp(load(spark, sf, "orders"), "gold", "orders", RUN.name, RUN.env, RUN.ts)
    stamped = audit.stamp_raw(stamped, "api", RUN.ts)
    return stamped.withColumns(
        {name: F.col(name).cast("timestamp_ntz") for name in ("_gold_ingest_ts", "_ingest_ts")}
    )


# --- Windows ----------------------------------------------------------------------------------


@query
def rank_in_category(spark, sf):
    lines = stage(inputs.order_lines(spark, sf).select("order_id", "product_id", "category", "rating_rate"), "lines")
    return windows.dense_rank_within(lines, ["category"], "rating_rate", "rank_in_category")


@query
def rank_by_price(spark, sf):
    lines = stage(inputs.order_lines(spark, sf).select("order_id", "category", "price"), "lines")
    return windows.dense_rank_within(lines, ["category"], "price", "price_rank", descending=False)


@query
def inventory_rank(spark, sf):
    value = money.inventory_value(F.col("price"), F.col("stock_qty")).alias("inventory_value")
    rows = inputs.products(spark, sf).select("product_id", "updated_at", "category", value)
    order = [F.desc("inventory_value"), F.asc("product_id"), F.asc("updated_at")]
    return windows.number_within(rows, ["category"], order, "inventory_rank")


LINE_ORDER = [
    "l_shipdate", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax",
]


def _sixteenth(df: DataFrame) -> int:
    """A bound that the three return flags exceed, each holding a third of the rows."""
    return max(1, df.count() // 16)


@query
def number_in_hot_groups(spark, sf):
    lines = load(spark, sf, "lineitem").select("l_returnflag", *LINE_ORDER)
    order = [F.desc("l_shipdate"), *[F.asc(c) for c in LINE_ORDER[1:]]]
    return windows.number_within(lines, ["l_returnflag"], order, "line_rank", _sixteenth(lines))


@query
def rank_in_hot_groups(spark, sf):
    lines = load(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", "l_extendedprice")
    return windows.dense_rank_within(
        lines, ["l_returnflag"], "l_extendedprice", "price_rank", rows_per_task=_sixteenth(lines)
    )


@query
def price_change_in_hot_groups(spark, sf):
    lines = load(spark, sf, "lineitem").select("l_returnflag", *LINE_ORDER)
    rows = windows.previous_within(
        lines, ["l_returnflag"], LINE_ORDER, "l_extendedprice", "prev_price", _sixteenth(lines)
    )
    change = money.price_change(F.col("l_extendedprice"), F.col("prev_price"))
    return rows.withColumn("price_change", change)


@query
def seniority_rank(spark, sf):
    days = dates.tenure_days(F.col("signup_date"), RUN.as_of).alias("tenure_days")
    region = labels.region(text.raised(F.col("country"))).alias("region")
    rows = inputs.customers(spark, sf).select("customer_id", region, days)
    return windows.dense_rank_within(rows, ["region"], "tenure_days", "seniority_rank")


PRICE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice"]


@query
def price_change(spark, sf):
    lines = load(spark, sf, "lineitem").select("l_partkey", *PRICE_ORDER)
    rows = windows.previous_within(lines, ["l_partkey"], PRICE_ORDER, "l_extendedprice", "prev_price")
    change = money.price_change(F.col("l_extendedprice"), F.col("prev_price"))
    return rows.withColumn("price_change", change)


# --- Incremental ------------------------------------------------------------------------------


@query
def upsert_orders(spark, sf):
    later = inputs.later_orders(spark, sf)
    delta = incremental.rows_after(later, "o_orderdate", "1998-12-31 00:00:00")
    return upsert.merge_frames(inputs.base_orders(spark, sf), delta, "o_orderkey", ["o_orderdate"])


@query
def upsert_new_columns(spark, sf):
    """The delta brings a column and lacks another."""
    delta = inputs.later_orders(spark, sf).filter(F.col("o_orderstatus") == "F")
    delta = delta.withColumn("o_channel", F.lit("web")).drop("o_orderpriority")
    return upsert.merge_frames(inputs.base_orders(spark, sf), delta, "o_orderkey", ["o_orderdate"])


@query
def upsert_partitions(spark, sf):
    """Re-priced urgent orders merged into a table partitioned by priority."""
    path = scratch_path(spark, "merged")
    orders = load(spark, sf, "orders")
    layout.write_partitioned(orders, path, ["o_orderpriority"])
    urgent = orders.filter(F.col("o_orderpriority") == "1-URGENT")
    changed = urgent.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    upsert.merge_into_partitions(spark, path, changed, "o_orderkey", ["o_orderpriority"], ["o_orderdate"])
    return spark.read.parquet(path)


@query
def incremental_slice(spark, sf):
    return incremental.rows_after(load(spark, sf, "orders"), "o_orderdate", "1999-06-30")


@query
def incremental_slice_inclusive(spark, sf):
    return incremental.rows_after(load(spark, sf, "orders"), "o_orderdate", "1999-06-30", inclusive=True)


@query
def incremental_two_runs(spark, sf):
    root = scratch_path(spark, "incremental")
    for source in (inputs.base_orders(spark, sf), inputs.later_orders(spark, sf)):
        incremental.load(source, root, "orders", "incremental", "o_orderdate", "o_orderkey")
    return incremental.current(spark, root, "orders")


@query
def incremental_null_marks(spark, sf):
    """Filled orders first, then all; low-priority ones carry no date and must enter all the same."""
    root = scratch_path(spark, "incremental")
    dated = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate"))
    orders = load(spark, sf, "orders").withColumn("o_orderdate", dated)
    for source in (orders.filter("o_orderstatus = 'F'"), orders):
        incremental.load(source, root, "orders", "incremental", "o_orderdate", "o_orderkey")
    return incremental.current(spark, root, "orders")


@query
def money_large_amounts(spark, sf):
    """Amounts beyond exact decimals, factors of nothing, and more decimals than six."""
    big, fine = F.round("o_totalprice") * 1e9, F.col("o_orderkey") + 0.123456789
    return load(spark, sf, "orders").select(
        "o_orderkey",
        money.revenue(big).alias("revenue"),
        money.revenue(big * 1e5).alias("huge_revenue"),
        money.price_with_tax(big).alias("with_tax"),
        money.price_with_tax(fine).alias("fine_with_tax"),
        money.net_revenue(big, F.lit(0.0)).alias("full"),
        money.net_revenue(big, F.lit(1.0)).alias("free"),
        money.inventory_value(big, F.lit(0)).alias("no_stock"),
    )


@query
def money_large_totals(spark, sf):
    """Sums of large amounts and of one that is not finite, which counts as null."""
    big = F.when(F.col("o_orderkey") == 1, F.lit(float("inf"))).otherwise(F.round("o_totalprice") * 1e9)
    priced = load(spark, sf, "orders").select("o_orderpriority", big.alias("price"))
    return priced.groupBy("o_orderpriority").agg(money.total(F.col("price")).alias("total"))


@query
def money_fine_totals(spark, sf):
    """Totals and means of amounts finer than millionths, mixed with large ones and with cents."""
    kinds = [F.lit(4e-7), F.lit(1e-9), F.lit(1e6 + 4e-7), F.lit(1e15), F.lit(-3.0000004), F.round("o_totalprice", 2)]
    amount = F.element_at(F.array(*kinds), (F.col("o_orderkey") % len(kinds) + 1).cast("int"))
    priced = load(spark, sf, "orders").select("o_orderpriority", (F.col("o_orderkey") % 6 < 3).alias("fine"), amount.alias("price"))
    return priced.groupBy("o_orderpriority", "fine").agg(
        money.total(F.col("price")).alias("total"), money.mean(F.col("price")).alias("mean")
    )


@query
def upsert_named_table(spark, sf):
    """Two upserts by the name of a table that is not there at first; read through the catalog."""
    root, name = scratch_path(spark, "named"), f"tierline_named_{uuid.uuid4().hex}"
    fresh = incremental.rows_after(inputs.later_orders(spark, sf), "o_orderdate", "1998-12-31 00:00:00")
    for new in (inputs.base_orders(spark, sf), fresh):
        incremental.upsert_table(new, root, name, "o_orderkey", ["o_orderdate"], ["o_orderstatus"])
    return tables.read_table(spark, name)


@query
def pipeline_two_runs(spark, sf):
    """All layers twice, the raw orders and customers by their load modes; orders through the catalog."""
    root, run = scratch_path(spark, "layers"), replace(RUN, database_prefix=f"tierline_{uuid.uuid4().hex}")
    for orders in (inputs.base_orders(spark, sf), inputs.later_orders(spark, sf)):
        layers.build_tables(
            spark,
            orders=inputs.whole_orders(orders),
            products=inputs.products(spark, sf),
            customers=inputs.customers(spark, sf),
            dates=gold.dim_date(spark, run=run),
            run=run,
            root=root,
        )
    silver_orders = tables.read_table(spark, run.table("silver", "silver_orders_transformed"))
    return _business(silver_orders).select("order_id", "category", "price", "order_date", "order_year", "order_month")


def _rated(orders: DataFrame) -> DataFrame:
    """Raw orders of several ratings; in a later delivery some have a price that is not valid."""
    rated = inputs.whole_orders(orders).withColumn("rating_rate", (F.col("order_id") % 9) / 2)
    late = F.col("order_date") > F.lit(inputs.SPLIT_DATE).cast("timestamp_ntz")
    return rated.withColumn("price", F.when(late & (F.col("order_id") % 11 == 0), -1.0).otherwise(F.col("price")))


def _two_deliveries(spark, sf) -> str:
    root = scratch_path(spark, "delta")
    fresh = incremental.rows_after(inputs.later_orders(spark, sf), "o_orderdate", "1998-12-31 00:00:00")
    for rows in (inputs.base_orders(spark, sf), fresh):
        delta.follow_orders(spark, root, _rated(rows), RUN)
    return root


@query
def layers_delta_run(spark, sf):
    """Transformed orders after a second delivery that replaces, adds and takes away some."""
    rows = _business(delta.orders(spark, _two_deliveries(spark, sf)))
    return rows.select("order_id", "product_id", "category", "price", "order_date", "rank_in_category", "price_change")


@query
def layers_delta_marts(spark, sf):
    """Sales by category after that delivery, of which only touched groups were computed anew."""
    rows = _business(delta.mart(spark, _two_deliveries(spark, sf), "agg_sales_by_category"))
    return rows.select("category", "order_year", "order_month", "total_revenue", "avg_price", "total_orders", "unique_products")


@query
def optimised_table(spark, sf):
    """A partitioned catalog table z-ordered in place: its rows, and whether its folders are still pruned."""
    name = f"tierline_optimised_{uuid.uuid4().hex}"
    tables.save_table(load(spark, sf, "orders"), name, ["o_orderpriority"])
    layout.optimise_table(spark, name, ["o_orderkey", "o_custkey", "o_orderpriority"], scratch_path(spark, "optimised"), 1 << 18)
    return tables.read_table(spark, name)


@query
def zorder_spans(spark, sf):
    """How well a lookup by each column skips files, here by names that share a prefix and by dates: the
    share of files whose range holds a value is at most a half on average."""
    orders = load(spark, sf, "orders").withColumn("name", F.format_string("Customer#%012d", "o_custkey"))
    opened = _opened_shares(spark, orders, ["name", "o_orderdate"])
    return opened.select("column", (F.col("share") <= 0.5).alias("skips_half"))


def _opened_shares(spark, rows, columns):
    """The share of files whose range holds a value, on average over all rows, for each z-order column."""
    path, source = scratch_path(spark, "zorder"), scratch_path(spark, "named")
    rows.write.parquet(source)
    sixteenth = quality.table_stats(spark, source).first()["bytes"] // 16
    layout.zorder(spark, source, path, columns, file_bytes=sixteenth)
    ordered = spark.read.parquet(path)
    shares = []
    for column in columns:
        ranges = ordered.groupBy("_metadata.file_path").agg(F.min(column).alias("least"), F.max(column).alias("most"))
        values = ordered.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
        met = values.join(F.broadcast(ranges), F.col("value").between(F.col("least"), F.col("most")), "left")
        share = F.sum("n") / (F.lit(ordered.count()) * F.lit(ranges.count()))
        shares.append(met.agg(share.alias("share")).select(F.lit(column).alias("column"), "share"))
    return shares[0].unionByName(shares[1])


@query
def zorder_spans_prefixes(spark, sf):
    """The same for two string columns: keys of two prefixes, and one odd key besides."""
    odd = F.col("o_orderkey") == F.lit(load(spark, sf, "orders").agg(F.min("o_orderkey")).first()[0])
    rows = load(spark, sf, "orders").select(
        "*",
        F.when(odd, "X1").when(F.col("o_orderkey") % 2 == 0, F.format_string("Customer#%012d", "o_custkey"))
        .otherwise(F.format_string("Supplier#%012d", "o_custkey")).alias("buyer"),
        F.when(odd, "Y1").otherwise(F.format_string("Order#%012d", F.pmod(F.xxhash64("o_orderkey"), F.lit(100000)))).alias("code"),
    )
    return _opened_shares(spark, rows, ["buyer", "code"]).select("column", (F.col("share") <= 0.4).alias("skips_most"))


@query
def stream_late_files(spark, sf):
    """Orders of one day arrive late, after later ones: no row is lost and the mark stays."""
    base = scratch_path(spark, "stream")
    orders = load(spark, sf, "orders")
    late = F.col("o_orderpriority") == "5-LOW"
    early = F.col("o_orderdate") <= F.lit("1998-12-31").cast("timestamp_ntz")
    for arrival in (orders.filter(~late), orders.filter(late & early), orders.filter(late & ~early)):
        arrival.write.mode("append").parquet(f"{base}/in")
        stream_upsert(
            spark, f"{base}/in", arrival.schema, f"{base}/checkpoint", f"{base}/out", "orders", "o_orderkey", ["o_orderdate"]
        )
    mark = F.lit(incremental.read_mark(spark, f"{base}/out", "orders")).cast("timestamp_ntz")
    return incremental.current(spark, f"{base}/out", "orders").withColumn("mark", mark)


@query
def top_2000_per_flag(spark, sf):
    order = [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber"), F.asc("l_partkey"), F.asc("l_suppkey")]
    lines = load(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return windows.top_k(lines, order, 2000, ["l_returnflag"])


@query
def incremental_partitions(spark, sf):
    """The same two runs into a table partitioned by a column that re-dated rows move across."""
    root = scratch_path(spark, "incremental")
    for source in (inputs.base_orders(spark, sf), inputs.later_orders(spark, sf)):
        dated = source.withColumn("order_year", F.year("o_orderdate"))
        incremental.load(
            dated, root, "orders", "incremental", "o_orderdate", "o_orderkey", partition_by=["order_year"]
        )
    return incremental.current(spark, root, "orders").drop("order_year")


@query
def full_load_two_runs(spark, sf):
    root = scratch_path(spark, "full")
    for source in (inputs.base_orders(spark, sf), inputs.later_orders(spark, sf)):
        incremental.load(source, root, "orders", "full_load")
    return incremental.current(spark, root, "orders")


@query
def high_mark_state(spark, sf):
    root = scratch_path(spark, "state")
    incremental.load(load(spark, sf, "orders"), root, "orders", "incremental", "o_orderdate", "o_orderkey")
    state = spark.read.schema(incremental.STATE_SCHEMA).json(f"{root}/orders/state")
    return state.select("table_name", "last_watermark")


@query
def stream_upsert_orders(spark, sf):
    base = scratch_path(spark, "stream")
    source, checkpoint, root = f"{base}/in", f"{base}/checkpoint", f"{base}/out"
    delta = incremental.rows_after(inputs.later_orders(spark, sf), "o_orderdate", "1998-12-31 00:00:00")
    for arrival in (inputs.base_orders(spark, sf), delta):
        arrival.write.mode("append").parquet(source)
        stream_upsert(
            spark, source, arrival.schema, checkpoint, root, "orders", "o_orderkey", ["o_orderdate"]
        )
    return incremental.current(spark, root, "orders")


# --- Sources and layout -----------------------------------------------------------------------


@query
def json_fields_default(spark, sf):
    """A field of JSON text: absent in purchases, and not JSON at all in errors."""
    props = (
        F.when(F.col("event_type") == "purchase", F.lit("{}"))
        .when(F.col("event_type") == "error", F.lit("k=1"))
        .otherwise(F.col("props"))
    )
    return load(spark, sf, "events").select(
        "event_id", records.json_field(props, "k int", "k", 0).alias("k")
    )


@query
def json_scan(spark, sf):
    """Nested order records written as JSON lines; nulls are left out, so defaults apply."""
    path = scratch_path(spark, "json")
    part = load(spark, sf, "part")
    rated = F.struct((F.col("p_size") / 10).alias("rate"), F.col("p_size").alias("count"))
    part.select(
        F.col("p_partkey").cast("int").alias("id"),
        F.when(F.col("p_type") != "SMALL", F.col("p_name")).alias("title"),
        F.col("p_type").alias("category"),
        F.when(F.col("p_type") != "PROMO", F.col("p_retailprice")).alias("price"),
        F.when(F.col("p_type") != "LARGE", rated).alias("rating"),
    ).write.json(path)
    return _business(bronze.orders_from_json(spark, path, RUN))


@query
def csv_scan(spark, sf):
    path = scratch_path(spark, "csv")
    inputs.products(spark, sf).write.option("header", True).option("sep", ";").option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)
    return _business(bronze.products_from_csv(spark, path, RUN, sep=";"))


def _reported(good, bad):
    """How many lines were taken and how many were set apart, by reason."""
    taken = good.select(F.lit("taken").alias("reason"))
    return taken.unionByName(bad.select("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))


@query
def json_quarantine(spark, sf):
    """Orders as JSON lines, some cut short and some with a word for a price."""
    path, orders = scratch_path(spark, "json"), load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    whole = F.to_json(F.struct("o_orderkey", "o_totalprice"))
    worded = F.to_json(F.struct("o_orderkey", F.lit("dear").alias("o_totalprice")))
    line = F.when(F.col("o_orderkey") % 7 == 0, F.substring(whole, 1, 9)).when(F.col("o_orderkey") % 7 == 1, worded).otherwise(whole)
    orders.select(line.alias("value")).write.text(path)
    return _reported(*files.split_malformed(spark, path, orders.schema, "json"))


@query
def csv_quarantine(spark, sf):
    """Orders as CSV lines, some with a field too few and some with a word for a price."""
    path, orders = scratch_path(spark, "csv"), load(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    key = F.col("o_orderkey").cast("string")
    price = F.when(F.col("o_orderkey") % 7 == 1, "dear").otherwise(F.col("o_totalprice").cast("string"))
    line = F.when(F.col("o_orderkey") % 7 == 0, key).otherwise(F.concat_ws("|", key, price, "o_orderstatus"))
    orders.select(line.alias("value")).write.text(path)
    return _reported(*files.split_malformed(spark, path, orders.schema, "csv", "|"))


@query
def domestic_suppliers(spark, sf):
    """Products by whether their supplier is of the home country, which some are."""
    rows = inputs.products(spark, sf).filter("updated_at = '2024-01-15'")
    return rows.select("product_id", labels.is_domestic(F.upper(F.trim("country"))).alias("is_domestic"))


@query
def catalog_table(spark, sf):
    name = f"tierline_orders_{uuid.uuid4().hex}"
    tables.save_table(load(spark, sf, "orders"), name, path=scratch_path(spark, "table"))
    return tables.read_table(spark, name)


@query
def catalog_database(spark, sf):
    """A table in a database of its own: whether it is there before and after, and the rows written."""
    name = f"tierline_db_{uuid.uuid4().hex}.orders"
    tables.ensure_database(spark, name.split(".")[0])
    before = tables.exists(spark, name)
    written = tables.save_table(load(spark, sf, "orders"), name)
    after = tables.exists(spark, name)
    rows = tables.read_table(spark, name).agg(F.count(F.lit(1)).alias("rows_read"))
    return rows.withColumns(
        {"rows_written": F.lit(written).cast("bigint"), "before": F.lit(before), "after": F.lit(after)}
    )


@query
def partitioned_read(spark, sf):
    path = scratch_path(spark, "partitioned")
    orders = load(spark, sf, "orders").withColumns(
        {"order_year": F.year("o_orderdate"), "order_month": F.month("o_orderdate")}
    )
    layout.write_partitioned(orders, path, ["order_year", "order_month"])
    return spark.read.parquet(path)


@query
def partition_overwrite(spark, sf):
    """A second write replaces the folders it has rows for and leaves the others."""
    path = scratch_path(spark, "overwrite")
    orders = load(spark, sf, "orders")
    layout.write_partitioned(orders, path, ["o_orderstatus"])
    layout.write_partitioned(
        orders.filter(F.col("o_orderstatus") == "F").withColumn("o_totalprice", F.lit(1.0)),
        path,
        ["o_orderstatus"],
    )
    return spark.read.parquet(path)


@query
def evolved_read(spark, sf):
    early, late = scratch_path(spark, "early"), scratch_path(spark, "late")
    inputs.base_orders(spark, sf).drop("o_orderpriority").write.parquet(early)
    incremental.rows_after(load(spark, sf, "orders"), "o_orderdate", "1998-12-31").write.parquet(late)
    return layout.read_evolved(spark, early, late)


@query
def evolved_types(spark, sf):
    """Older orders with int keys, float prices and no priority, newer ones as they are, under one stored schema."""
    path = scratch_path(spark, "evolving")
    narrow = {"o_orderkey": F.col("o_orderkey").cast("int"), "o_totalprice": F.col("o_totalprice").cast("float")}
    layout.append_evolving(inputs.base_orders(spark, sf).withColumns(narrow).drop("o_orderpriority"), path)
    layout.append_evolving(incremental.rows_after(load(spark, sf, "orders"), "o_orderdate", "1998-12-31"), path)
    return layout.read_evolving(spark, path)


@query
def bronze_rejects(spark, sf):
    """Products as CSV, some with a field too few and some with a word for a price: taken and set apart."""
    path = scratch_path(spark, "csv")
    rows = inputs.products(spark, sf).select("product_id", "product_name", "category", "price", "stock_qty", "supplier_id", "country", "updated_at")
    texts = [F.concat(F.lit('"'), F.col(name).cast("string"), F.lit('"')) for name in rows.columns]
    worded = F.when(F.col("product_id") % 7 == 1, "dear").otherwise(texts[3])
    line = F.when(F.col("product_id") % 7 == 0, texts[0]).otherwise(F.concat_ws(",", *texts[:3], worded, *texts[4:]))
    rows.select(line.alias("value")).write.text(path)
    return _reported(*bronze.products_and_rejects(spark, path, RUN, header=False))


@query
def zorder_rows(spark, sf):
    path = scratch_path(spark, "zorder")
    layout.zorder(
        spark, f"{sf}/lineitem.parquet", path, ["l_partkey", "l_shipdate", "l_returnflag"], file_bytes=1 << 20
    )
    return spark.read.parquet(path)


@query
def compact_rows(spark, sf):
    small, path = scratch_path(spark, "small"), scratch_path(spark, "compact")
    load(spark, sf, "orders").repartition(40).write.parquet(small)
    layout.compact(spark, small, path)
    return spark.read.parquet(path)


LARGE_FILE = 2 << 20


def _fragments(size: int) -> tuple[int, int, int]:
    """The size of a large file, and how many tasks write the large and the small ones of a table of ``size`` bytes.

    Five folders share four fifths of the table in large files and one fifth in small ones, of which six or more
    make a large one."""
    large = min(size // 8, LARGE_FILE)
    return large, max(1, size * 4 // 25 // max(1, large)), max(20, math.ceil(size / 25 / max(1, large / 6)))


@query
def compact_small_files(spark, sf):
    """Orders in folders that each hold large files and many small ones, after packing the small ones.

    A large file has LARGE_FILE bytes or up to twice that, so that more orders make more files and no task
    writes more than one of them a folder."""
    path, orders = scratch_path(spark, "fragments"), load(spark, sf, "orders")
    recent, (large, larges, smalls) = F.col("o_orderkey") % 5 == 0, _fragments(quality.table_stats(spark, orders).first()["bytes"])
    orders.filter(~recent).repartition(larges).write.partitionBy("o_orderpriority").parquet(path)
    orders.filter(recent).repartition(smalls).write.mode("append").partitionBy("o_orderpriority").parquet(path)
    layout.compact_small(spark, path, large)
    return spark.read.parquet(path)


@query
def table_stats(spark, sf):
    return quality.table_stats(spark, f"{sf}/lineitem.parquet").selectExpr("rows", "columns", "files", "bytes > 0 AS has_bytes")


@query
def profile(spark, sf):
    rules = {
        "valid_email": text.is_valid_email(text.lowered(F.col("email"))),
        "recent_signup": F.col("signup_date") >= F.lit("2001-01-01").cast("timestamp_ntz"),
    }
    return quality.profile(inputs.customers(spark, sf), rules, exact_distinct="country")


@query
def profile_values(spark, sf):
    """Exact distinct counts and the most frequent values of several columns, one of them a key."""
    return quality.value_profile(load(spark, sf, "orders"), ["o_orderpriority", "o_custkey", "o_orderkey"])


@query
def profile_quantiles(spark, sf):
    """Whether sketched quantiles of prices and keys are within a hundredth of their rank."""
    orders = load(spark, sf, "orders").select("o_totalprice", "o_custkey")
    found = quality.quantile_profile(orders, list(orders.columns), [0.1, 0.5, 0.9])
    long = orders.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("number")) for c in orders.columns]))
    )
    below, upto = F.avg((F.col("number") < F.col("value")).cast("int")), F.avg((F.col("number") <= F.col("value")).cast("int"))
    met = long.join(F.broadcast(found), "column").groupBy("column", "share").agg(below.alias("below"), upto.alias("upto"))
    near = (F.col("below") <= F.col("share") + 0.01) & (F.col("upto") >= F.col("share") - 0.01)
    return met.select("column", "share", near.alias("is_near"))
