"""Join helpers shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from tierline import settings


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join on equal keys where null equals null; the key columns of ``left`` are kept."""
    renamed = right.withColumnsRenamed({name: f"__right_{name}" for name in on})
    match = reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(f"__right_{name}")) for name in on])
    return left.join(renamed, match, how).drop(*[f"__right_{name}" for name in on])


def lookup(
    df: DataFrame, mapping: DataFrame, column: str, key: str, label: str, name: str, otherwise: str
) -> DataFrame:
    """Labels ``df[column]`` from a mapping table too long for a literal ``map_values``.

    The mapping is reduced to one label (the smallest) per key, so rows are never multiplied. Spark
    picks a broadcast or, with AQE skew handling, a shuffled join by the size of the mapping.
    """
    unique = (
        mapping.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("__lookup_key"))
        .agg(F.min(label).alias("__label"))
    )
    return (
        df.join(unique, df[column] == unique["__lookup_key"], "left")
        .withColumn(name, F.coalesce("__label", F.lit(otherwise)))
        .drop("__lookup_key", "__label")
    )


def row_bytes(df: DataFrame, columns: list[str]) -> Column:
    """Bytes that the given columns take in a row: text and bytes by length, nested values by twice that
    of their JSON text, the rest at 16 per value."""
    width = F.lit(16 * len(columns) + 16).cast("bigint")
    for name in columns:
        kind = df.schema[name].dataType
        if isinstance(kind, (StringType, BinaryType)):
            width = width + F.coalesce(F.octet_length(name), F.lit(0))
        elif isinstance(kind, (ArrayType, MapType, StructType)):
            width = width + 2 * F.octet_length(F.to_json(F.struct(name)))
    return width


def broadcast_if(df: DataFrame, size: int) -> DataFrame:
    """Broadcast ``df`` when its checked ``size`` in bytes is within bounds; else let Spark shuffle."""
    return F.broadcast(df) if size <= settings.BROADCAST_BYTES else df
