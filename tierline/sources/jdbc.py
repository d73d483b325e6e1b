"""Database snapshots read in parallel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def partition_options(
    url: str,
    table: str,
    column: str,
    lower: int | str,
    upper: int | str,
    partitions: int,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options for a scan split on ``column``.

    The bounds only place the splits; rows outside them, and nulls, land in the outer partitions.
    """
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_size),
    }


def read_jdbc_partitioned(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    lower: int | str,
    upper: int | str,
    partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """The table as ``partitions`` concurrent queries; filters and columns are pushed to the database."""
    options = partition_options(url, table, column, lower, upper, partitions) | (properties or {})
    return spark.read.format("jdbc").options(**options).load()
