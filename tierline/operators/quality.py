"""Data-quality reports. Each is a DataFrame, not console output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StructType


def profile(
    df: DataFrame,
    rules: dict[str, Column] | None = None,
    distinct: list[str] = (),
    exact_distinct: str | None = None,
) -> DataFrame:
    """(metric, subject, value) rows from one pass over ``df``.

    Metrics: rows, columns, nulls per column, violations per rule (rule not true), and distinct
    counts. ``distinct`` columns are estimated in the same pass; one column may be counted exactly.
    ``value_profile`` counts several exactly.
    """
    measures = [("rows", "*", F.count(F.lit(1)))]
    measures += [("nulls", name, F.count_if(F.col(name).isNull())) for name in df.columns]
    for name, rule in (rules or {}).items():
        measures.append(("violations", name, F.count_if(~F.coalesce(rule, F.lit(False)))))
    measures += [("distinct_estimate", name, F.approx_count_distinct(name)) for name in distinct]
    if exact_distinct is not None:
        measures.append(("distinct", exact_distinct, F.countDistinct(exact_distinct)))
    totals = df.agg(*[value.cast("bigint").alias(f"m{i}") for i, (_, _, value) in enumerate(measures)])

    def line(metric: str, subject: str, value: Column) -> Column:
        return F.struct(
            F.lit(metric).alias("metric"), F.lit(subject).alias("subject"), value.alias("value")
        )

    lines = [line(metric, subject, F.col(f"m{i}")) for i, (metric, subject, _) in enumerate(measures)]
    lines.append(line("columns", "*", F.lit(len(df.columns)).cast("bigint")))
    return totals.select(F.inline(F.array(*lines)))


def value_profile(df: DataFrame, columns: list[str], top: int = 3) -> DataFrame:
    """(column, rows, nulls, distinct, place, value, value_rows): per column its exact counts, with one row for
    each of its ``top`` most frequent values (the smaller first among equals), as text.

    All columns are counted in one aggregation over (column, value), which combines repeated values before the
    shuffle: a hot value crosses it once per task. The most frequent values are limited before the second
    one, so no task gets all values of a column. A column of nulls alone has one row without a value; an
    empty table has none.
    """
    pairs = [F.struct(F.lit(c).alias("column"), _as_text(df, c).alias("value")) for c in columns]
    counted = df.select(F.inline(F.array(*pairs))).groupBy("column", "value").agg(F.count(F.lit(1)).alias("value_rows"))
    totals = counted.groupBy("column").agg(
        F.sum("value_rows").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("value_rows"))), F.lit(0)).alias("nulls"),
        F.count("value").alias("distinct"),
    )
    order = Window.partitionBy("column").orderBy(F.desc("value_rows"), "value")
    heavy = counted.filter(F.col("value").isNotNull()).withColumn("place", F.row_number().over(order).cast("bigint"))
    found = totals.join(heavy.filter(F.col("place") <= top), "column", "left")
    return found.select("column", "rows", "nulls", "distinct", "place", "value", "value_rows")


def _as_text(df: DataFrame, column: str) -> Column:
    kind, value = df.schema[column].dataType, F.col(column)
    if isinstance(kind, BinaryType):
        return F.hex(value)
    if isinstance(kind, (ArrayType, MapType, StructType)):
        return F.when(value.isNotNull(), F.to_json(F.struct(column)))
    return value.cast("string")


def quantile_profile(df: DataFrame, columns: list[str], shares: list[float], accuracy: int = 10_000) -> DataFrame:
    """(column, share, value): quantiles of number columns, as double, from sketches of one pass over ``df``.

    The rank of a value is off by at most rows / ``accuracy``. Nulls do not count; a column without values
    has null quantiles.
    """
    sketches = [F.percentile_approx(F.col(c).cast("double"), shares, accuracy).alias(f"q{i}") for i, c in enumerate(columns)]
    lines = [
        F.struct(F.lit(c).alias("column"), F.lit(share).alias("share"), F.get(f"q{i}", F.lit(j)).alias("value"))
        for i, c in enumerate(columns)
        for j, share in enumerate(shares)
    ]
    return df.agg(*sketches).select(F.inline(F.array(*lines)))


def orphans(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str | None = None) -> DataFrame:
    """Keys of ``fact`` that ``dim`` lacks, with their row counts; a null key counts as lacking.

    Facts are counted per key before the join, so a hot key crosses the shuffle as one row per task.
    """
    keys = dim.select(F.col(dim_key or fact_key).alias("__dim_key"))
    counted = fact.groupBy(fact_key).agg(F.count(F.lit(1)).alias("fact_rows"))
    return counted.join(keys, counted[fact_key] == keys["__dim_key"], "left_anti")


def key_collisions(df: DataFrame, key: str) -> DataFrame:
    """Values of ``key`` that occur more than once."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def table_stats(spark: SparkSession, source: str | DataFrame) -> DataFrame:
    """One row: rows, columns, files and bytes of the Parquet table at a path, or of one just read.
    Reads no column."""
    table = spark.read.parquet(source) if isinstance(source, str) else source
    files = table.groupBy("_metadata.file_path", "_metadata.file_size").agg(F.count(F.lit(1)).alias("n"))
    return files.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.lit(len(table.columns)).cast("bigint").alias("columns"),
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("file_size"), F.lit(0)).alias("bytes"),
    )
