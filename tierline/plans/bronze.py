"""Raw tables: orders from JSON, products from CSV, customers from a database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierline.functions.dates import parse_timestamp
from tierline.operators.audit import stamp_raw
from tierline.settings import Run
from tierline.sources.files import flattened, read_csv, read_json_records, split_malformed
from tierline.sources.jdbc import read_jdbc_partitioned

# Input schemas and the defaults of absent fields.
ORDER_RECORD = (
    "id int, title string, category string, price double, rating struct<rate: double, count: int>"
)
ORDER_FIELDS = {
    "order_id": ("id", None),
    "product_id": ("id", None),
    "product_name": ("title", ""),
    "category": ("category", ""),
    "price": ("price", 0.0),
    "rating_rate": ("rating.rate", 0.0),
    "rating_count": ("rating.count", 0),
}
PRODUCT_SCHEMA = (
    "product_id bigint, product_name string, category string, price double, stock_qty bigint, "
    "supplier_id string, country string, updated_at string"
)


def orders_from_json(spark: SparkSession, path: str, run: Run = Run(), source: str = "rest_api") -> DataFrame:
    """Order records; the order date is the time of the run, as the records carry none."""
    return _orders(read_json_records(spark, path, ORDER_RECORD, ORDER_FIELDS), run, source)


def orders_and_rejects(
    spark: SparkSession, path: str, run: Run = Run(), source: str = "rest_api"
) -> tuple[DataFrame, DataFrame]:
    """The orders of ``orders_from_json`` from lines that fit, and (record, reason, file) of the others."""
    good, bad = split_malformed(spark, path, StructType.fromDDL(ORDER_RECORD), "json")
    return _orders(good.select(*flattened(ORDER_FIELDS)), run, source), bad


def _orders(records: DataFrame, run: Run, source: str) -> DataFrame:
    now = F.current_timestamp() if run.ts is None else F.lit(run.ts)
    dated = records.withColumns({"order_date": F.date_trunc("second", now), "source": F.lit(source)})
    return stamp_raw(dated, "api", run.ts)


def products_from_csv(
    spark: SparkSession, path: str, run: Run = Run(), source: str = "csv", **options
) -> DataFrame:
    return stamp_raw(read_csv(spark, path, PRODUCT_SCHEMA, **options), source, run.ts)


def products_and_rejects(
    spark: SparkSession, path: str, run: Run = Run(), source: str = "csv", sep: str = ",", header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """The products of lines that fit the schema, and (record, reason, file) of the others."""
    good, bad = split_malformed(spark, path, StructType.fromDDL(PRODUCT_SCHEMA), "csv", sep, header=header)
    return stamp_raw(good, source, run.ts), bad


def customers_from_table(table: DataFrame, run: Run = Run(), source: str = "database") -> DataFrame:
    """``table`` as read from the database, with its date texts parsed."""
    parsed = {name: parse_timestamp(F.col(name)) for name in ("signup_date", "updated_at")}
    return stamp_raw(table.withColumns(parsed), source, run.ts)


def customers_from_jdbc(
    spark: SparkSession, url: str, table: str, bounds: tuple[int, int], partitions: int, run: Run = Run()
) -> DataFrame:
    """Customers read as ``partitions`` ranges of customer_id; ``bounds`` are its lowest and highest."""
    rows = read_jdbc_partitioned(spark, url, table, "customer_id", *bounds, partitions)
    return customers_from_table(rows, run)
