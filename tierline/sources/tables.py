"""Catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def save_table(
    df: DataFrame,
    name: str,
    partition_by: list[str] | None = None,
    path: str | None = None,
    options: dict[str, str] | None = None,
    file_format: str = "parquet",
) -> int:
    """Overwrite table ``name`` and return its row count, observed during the write.

    With ``path`` the table is external. ``df`` must not read the table it overwrites.
    """
    database, _, _ = name.rpartition(".")
    if database:
        ensure_database(df.sparkSession, database)
    rows = Observation()
    observed = df.observe(rows, F.count(F.lit(1)).alias("rows"))
    if partition_by:
        observed = observed.hint("rebalance", *partition_by)
    writer = observed.write.mode("overwrite").format(file_format).options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return rows.get["rows"]


def publish(spark: SparkSession, name: str, path: str, without: list[str] | None = None) -> None:
    """Make ``name`` show the Parquet files at ``path``, in one step of the catalog.

    ``name`` becomes a view, which lists files anew for each query and takes added columns as they are.
    """
    database, _, _ = name.rpartition(".")
    if database:
        ensure_database(spark, database)
    columns = f"* EXCEPT ({', '.join(without)})" if without else "*"
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM parquet.`{path}`")


def folders_of(spark: SparkSession, name: str) -> list[str]:
    """The columns that table ``name`` is partitioned by."""
    return [column.name for column in spark.catalog.listColumns(name) if column.isPartition]


def _next(name: str) -> str:
    return f"{name}__next"


def replace_files(spark: SparkSession, name: str, path: str) -> None:
    """Make the Parquet files at ``path``, of the same columns and folders, those of table ``name``.

    The table that takes over is complete before the old one goes; ``finish_replacing`` completes a run
    that died before the renaming. Files of an external table stay where they are, others are deleted.
    """
    folders = folders_of(spark, name)
    spark.sql(f"DROP TABLE IF EXISTS {_next(name)}")
    spark.sql(f"CREATE TABLE {_next(name)} LIKE {name} LOCATION '{path}'")
    if folders:
        spark.catalog.recoverPartitions(_next(name))
    spark.sql(f"DROP TABLE {name}")
    finish_replacing(spark, name)


def finish_replacing(spark: SparkSession, name: str) -> None:
    """Give the replacement its name, if a run has got that far."""
    if not exists(spark, name) and exists(spark, _next(name)):
        spark.sql(f"ALTER TABLE {_next(name)} RENAME TO {name}")
