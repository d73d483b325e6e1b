"""The order, product and customer entities expressed over the test tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.functions import dates, money
from tierline.operators.clean import normalise
from tierline.settings import Run

RUN = Run(as_of=dt.date(2001, 8, 2), ts=dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc))
SPLIT_DATE = dt.datetime(1998, 12, 31)

# Raw labels and country codes given to the test tables' types and nations.
RAW_CATEGORIES = {
    "ECONOMY": " Electronics",
    "STANDARD": "Shoes",
    "SMALL": "FITNESS ",
    "MEDIUM": "Kitchen",
    "LARGE": "Gadgets",
    "PROMO": "Books",
}
SUPPLIER_COUNTRIES = {
    "ECONOMY": "in",
    "STANDARD": "cn ",
    "SMALL": "us",
    "MEDIUM": "de",
    "LARGE": " in",
    "PROMO": "jp",
}
NATION_CODES = [
    "in", "sg", "jp", "cn", "us", "ca", "uk", "de", "fr", "it", "au", "nz", "br", "za", "mx", "in",
    "us", "uk", "jp", "au", "de", "ke", "ar", "ca", "cn",
]


def load(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _by_type(mapping: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])[F.col("p_type")]


def order_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Raw orders: line items with their part."""
    part = load(spark, sf, "part").select(
        "p_partkey",
        F.col("p_name").alias("product_name"),
        _by_type(RAW_CATEGORIES).alias("category"),
        (F.col("p_size") / 10).alias("rating_rate"),
    )
    lines = load(spark, sf, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    return lines.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        "product_name",
        "category",
        F.col("l_extendedprice").alias("price"),
        "rating_rate",
        F.col("l_quantity").cast("int").alias("rating_count"),
        F.col("l_shipdate").alias("order_date"),
        F.lit(" Web ").alias("source"),
    )


def sale_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Every line item with the columns the marts aggregate."""
    lines = normalise(order_lines(spark, sf), trim=["product_name"], lower=["category"])
    price = F.col("price")
    return lines.withColumns(
        dates.date_parts(F.col("order_date"), "order_")
        | {
            "unit_price": price,
            "revenue": money.revenue(price),
            "revenue_with_tax": money.revenue_with_tax(price),
        }
    )


def products(spark: SparkSession, sf: str) -> DataFrame:
    """Raw products, each delivered twice with differing values."""
    part = load(spark, sf, "part")

    def delivery(day: str, extra: int) -> DataFrame:
        price = F.col("p_retailprice").cast("decimal(18,2)") - (895 - extra)
        return part.select(
            F.col("p_partkey").alias("product_id"),
            F.concat(F.lit(" "), "p_name").alias("product_name"),
            _by_type(RAW_CATEGORIES).alias("category"),
            price.cast("double").alias("price"),
            (F.col("p_size") - 10 + extra).cast("bigint").alias("stock_qty"),
            F.lower("p_brand").alias("supplier_id"),
            _by_type(SUPPLIER_COUNTRIES).alias("country"),
            F.lit(day).alias("updated_at"),
        )

    return delivery("2024-01-15", 0).unionByName(delivery("2024-01-10", 3))


def customers(spark: SparkSession, sf: str) -> DataFrame:
    """Raw customers; signed up on the day of their last order, so some have no sign-up date."""
    last_order = load(spark, sf, "orders").groupBy("o_custkey").agg(F.max("o_orderdate").alias("signup"))
    joined = (
        load(spark, sf, "customer")
        .join(load(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(last_order, F.col("c_custkey") == F.col("o_custkey"), "left")
    )
    name = F.split("c_name", "#")
    codes = F.array(*[F.lit(code) for code in NATION_CODES])
    ending = F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(".COM")
    return joined.select(
        F.col("c_custkey").alias("customer_id"),
        F.concat(F.lit(" "), name[0]).alias("first_name"),
        name[1].alias("last_name"),
        F.concat(F.lit(" "), F.upper(F.replace("c_name", F.lit("#"), F.lit("@"))), ending).alias("email"),
        F.col("c_custkey").cast("string").alias("phone"),
        F.concat("n_name", F.lit(" ")).alias("city"),
        F.get(codes, F.col("n_nationkey")).alias("country"),
        F.col("signup").alias("signup_date"),
        F.col("signup").alias("updated_at"),
        F.when(F.col("c_acctbal") > 0, 1).otherwise(0).cast("bigint").alias("is_active"),
    )


def base_orders(spark: SparkSession, sf: str) -> DataFrame:
    """The orders table as a first run sees it."""
    return load(spark, sf, "orders").filter(F.col("o_orderdate") <= F.lit(SPLIT_DATE).cast("timestamp_ntz"))


def later_orders(spark: SparkSession, sf: str) -> DataFrame:
    """The orders table as a second run sees it: all orders, the finished ones re-dated and re-priced."""
    finished = F.col("o_orderstatus") == "F"
    moved = F.col("o_orderdate") + F.expr("interval 400 days")
    return load(spark, sf, "orders").withColumns(
        {
            "o_orderdate": F.when(finished, moved).otherwise(F.col("o_orderdate")),
            "o_totalprice": F.when(finished, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
        }
    )


def whole_orders(orders: DataFrame) -> DataFrame:
    """Raw orders with one line each, so that order_id is a key."""
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("product_id"),
        F.lit("Basket").alias("product_name"),
        F.col("o_orderpriority").alias("category"),
        F.col("o_totalprice").alias("price"),
        F.lit(4.5).alias("rating_rate"),
        F.lit(1).alias("rating_count"),
        F.col("o_orderdate").alias("order_date"),
        F.lit("web").alias("source"),
    )
