"""Cleaned and enriched tables of orders, products and customers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.functions import dates, labels, money, text
from tierline.operators.audit import stamp
from tierline.operators.clean import dedup_latest, keep_positive, normalise, require
from tierline.operators.joins import null_safe_join
from tierline.operators.windows import dense_rank_within, number_within, previous_within
from tierline.settings import Run


def _valid_rows(
    df: DataFrame, key: str, latest: list[str], required: list[str], positive: str | None, run: Run
) -> DataFrame:
    """One valid row per key.

    By default the survivor of a key is chosen first and then has to be valid. With
    ``validate_first`` an invalid row cannot displace a valid one, and the filters reach the scan.
    """

    def valid(rows: DataFrame) -> DataFrame:
        rows = require(rows, required)
        return keep_positive(rows, positive) if positive else rows

    if run.validate_first:
        return dedup_latest(valid(df), [key], latest)
    return valid(dedup_latest(df, [key], latest))


def clean_orders(orders: DataFrame, run: Run = Run()) -> DataFrame:
    rows = _valid_rows(
        orders, "order_id", ["order_date"], ["order_id", "product_id", "price"], "price", run
    )
    rows = normalise(rows, trim=["product_name"], lower=["category", "source"])
    rows = rows.withColumns(
        {
            "price_bucket": labels.price_bucket(F.col("price")),
            "is_highly_rated": labels.is_highly_rated(F.col("rating_rate")),
        }
    )
    return stamp(rows, "silver", "orders", run.name, run.env, run.ts)


def clean_products(products: DataFrame, run: Run = Run()) -> DataFrame:
    rows = _valid_rows(
        products, "product_id", ["updated_at"], ["product_id", "product_name", "price"], "price", run
    )
    rows = normalise(rows, trim=["product_name"], lower=["category"], upper=["country", "supplier_id"])
    stock = labels.clamp_low(F.col("stock_qty"))
    rows = rows.withColumns(
        {
            "stock_qty": stock,
            "stock_status": labels.stock_status(stock),
            "price_with_tax": money.price_with_tax(F.col("price")),
        }
    )
    return stamp(rows, "silver", "products", run.name, run.env, run.ts)


def clean_customers(customers: DataFrame, run: Run = Run()) -> DataFrame:
    rows = _valid_rows(customers, "customer_id", ["updated_at"], ["customer_id", "email"], None, run)
    rows = normalise(
        rows, trim=["first_name", "last_name", "city"], lower=["email"], upper=["country"]
    )
    rows = rows.withColumns(
        {
            "is_valid_email": text.is_valid_email(F.col("email")),
            "full_name": text.full_name(F.col("first_name"), F.col("last_name")),
            "is_active": labels.is_active(F.col("is_active")),
            "signup_date": dates.parse_timestamp(F.col("signup_date")),
            "updated_at": dates.parse_timestamp(F.col("updated_at")),
        }
    )
    return stamp(rows, "silver", "customers", run.name, run.env, run.ts)


def transform_orders(orders: DataFrame, run: Run = Run(), ranks: DataFrame | None = None) -> DataFrame:
    """``ranks`` (category, rating_rate, rank_in_category) are taken as given where ``orders`` are not all."""
    price = F.col("price")
    rows = orders.withColumns(
        dates.date_parts(F.col("order_date"), "order_")
        | {
            "revenue": money.revenue(price),
            "revenue_with_tax": money.revenue_with_tax(price),
            "net_revenue": money.net_revenue(price),
        }
    )
    # the window first: measuring its output for the rank prunes it, while the rank's join would stay
    rows = previous_within(
        rows, ["product_id"], ["order_date", "order_id"], "price", "prev_price", run.rows_per_task
    )
    if ranks is None:
        rows = dense_rank_within(rows, ["category"], "rating_rate", "rank_in_category", rows_per_task=run.rows_per_task)
    else:
        rows = null_safe_join(rows, ranks, ["category", "rating_rate"])
    rows = rows.withColumn("price_change", money.price_change(price, F.col("prev_price")))
    source = run.table("silver", "silver_orders")
    return stamp(rows, "silver_transformed", source, run.name, run.env, run.ts)


def transform_products(products: DataFrame, run: Run = Run()) -> DataFrame:
    price = F.col("price")
    rows = products.withColumns(
        {
            "category_group": labels.category_group(F.col("category")),
            "inventory_value": money.inventory_value(price, F.col("stock_qty")),
            "price_tier": labels.price_tier(price),
            "is_domestic_supplier": labels.is_domestic(F.col("country")),
        }
    )
    rows = number_within(
        rows, ["category"], [F.desc("inventory_value"), F.asc("product_id")], "inventory_rank", run.rows_per_task
    )
    source = run.table("silver", "silver_products")
    return stamp(rows, "silver_transformed", source, run.name, run.env, run.ts)


def transform_customers(customers: DataFrame, run: Run = Run()) -> DataFrame:
    tenure = dates.tenure_days(F.col("signup_date"), run.as_of)
    rows = customers.withColumns(
        {
            "tenure_days": tenure,
            "tenure_bucket": labels.tenure_bucket(tenure),
            "region": labels.region(F.col("country")),
            "display_name": text.display_name(F.col("first_name"), F.col("last_name")),
        }
    )
    rows = dense_rank_within(
        rows, ["region"], "tenure_days", "seniority_rank", rows_per_task=run.rows_per_task
    )
    source = run.table("silver", "silver_customers")
    return stamp(rows, "silver_transformed", source, run.name, run.env, run.ts)
