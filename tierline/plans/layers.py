"""All layers together: raw frames in, silver and gold frames (or tables) out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession

from tierline.operators import incremental, layout
from tierline.operators.quality import table_stats
from tierline.plans import gold, silver
from tierline.settings import LOAD_FOLDERS, PARTITION_COLUMNS, ZORDER_COLUMNS, Run
from tierline.sources.tables import publish, read_table, save_table

Keep = Callable[[str, DataFrame], DataFrame]


def build(
    orders: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    dates: DataFrame,
    run: Run = Run(),
    keep: Keep = lambda name, df: df,
) -> dict[str, DataFrame]:
    """Every silver and gold frame by name.

    ``keep(name, df)`` may store a frame and return the stored copy, so that what follows reads it
    instead of computing it again. The default keeps frames lazy, which leaves the whole chain to
    Catalyst and suits asking for one result.
    """
    made: dict[str, DataFrame] = {}

    def add(name: str, df: DataFrame) -> DataFrame:
        made[name] = keep(name, df)
        return made[name]

    silver_orders = add("silver_orders", silver.clean_orders(orders, run))
    silver_products = add("silver_products", silver.clean_products(products, run))
    silver_customers = add("silver_customers", silver.clean_customers(customers, run))
    orders_out = add("silver_orders_transformed", silver.transform_orders(silver_orders, run))
    products_out = add("silver_products_transformed", silver.transform_products(silver_products, run))
    customers_out = add("silver_customers_transformed", silver.transform_customers(silver_customers, run))
    product_dim = add("dim_product", gold.dim_product(products_out, run))
    add("dim_customer", gold.dim_customer(customers_out, run))
    add("dim_date", dates)
    fact = add("fact_orders", gold.fact_orders(orders_out, run))
    add("agg_sales_by_category", gold.sales_by_category(fact, run))
    add("agg_sales_by_date", gold.sales_by_date(fact, run))
    add("agg_top_products", gold.top_products(fact, product_dim, run))
    return made


def _partitions(name: str, df: DataFrame) -> list[str] | None:
    """Partition columns of a silver table, once it has them."""
    if not name.startswith("silver_"):
        return None
    columns = PARTITION_COLUMNS[name.split("_")[1]]
    return columns if set(columns) <= set(df.columns) else None


def build_tables(
    spark: SparkSession,
    orders: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    dates: DataFrame,
    run: Run = Run(),
    root: str | None = None,
) -> dict[str, int]:
    """Write every layer to catalog tables and return their row counts.

    Each table is computed once: what follows reads the stored copy. With ``root`` the raw tables are
    kept below it and brought up to date by their configured load modes, which rewrite only folders
    that new rows touch; without, they are overwritten.
    """
    counts: dict[str, int] = {}

    def keep(name: str, df: DataFrame) -> DataFrame:
        layer = "silver" if name.startswith("silver_") else "gold"
        table = run.table(layer, name)
        counts[table] = save_table(df, table, _partitions(name, df))
        return read_table(spark, table)

    raw = {"bronze_orders": orders, "bronze_products": products, "bronze_customers": customers}
    stored = {}
    for name, df in raw.items():
        table, short = run.table("bronze", name), name.removeprefix("bronze_")
        if root is None:
            counts[table] = save_table(df, table)
        else:
            state = incremental.load_configured(df, root, short)
            publish(spark, table, f"{root}/{short}/{state.snapshot}", list(LOAD_FOLDERS.get(short, {})))
            counts[table] = read_table(spark, table).count()
        stored[short] = read_table(spark, table)
    build(**stored, dates=dates, run=run, keep=keep)
    return counts


def optimise_tables(spark: SparkSession, root: str, run: Run = Run()) -> dict[str, Row]:
    """Z-order the silver tables, make the copies below ``root`` current, and return their figures."""
    stats = {}
    for name, columns in ZORDER_COLUMNS.items():
        table = run.table("silver", f"silver_{name}_transformed")
        layout.optimise_table(spark, table, columns, root)
        stats[table] = table_stats(spark, read_table(spark, table)).first()
    return stats
