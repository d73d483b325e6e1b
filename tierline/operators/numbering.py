"""Dense surrogate keys that stay: a stored map from business keys to numbers."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline import session
from tierline.operators.joins import null_safe_join

_PLACE_BITS = 33  # of monotonically_increasing_id, the place within a partition


def key_map(spark: SparkSession, path: str, keys: list[str], name: str) -> DataFrame:
    """(keys, name): the numbers given so far."""
    return spark.read.parquet(path).select(*keys, name)


def number_keys(rows: DataFrame, path: str, keys: list[str], name: str = "sk") -> DataFrame:
    """``rows`` with ``name``, the number of their business key in the map stored at ``path``.

    Keys that the map lacks get the numbers after its last one, without gaps and in the order of the keys, and
    are added to it; a number once given never changes. Null is a key like any other. The new keys are
    distinct ones, range-partitioned, and a number is the place in its partition after the counts of those
    before, so nothing is numbered in one task; the driver gets one count per partition. One writer at a
    time. A run that dies while it adds keys may leave a gap, never a number given twice.
    """
    spark = rows.sparkSession
    if name in rows.columns:
        raise ValueError(f"{name} is a column of the rows already")
    wanted, last = rows.select(*keys).distinct(), 0
    known = session.exists(spark, path)
    if known:
        last = key_map(spark, path, keys, name).agg(F.max(name)).first()[0] or 0
        wanted = null_safe_join(wanted, key_map(spark, path, keys, name), keys, "left_anti")
    ordered = wanted.repartitionByRange(*keys).sortWithinPartitions(*keys)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    fresh = session.stage(ordered.select(*keys, F.spark_partition_id().alias("__part"), place.alias("__place")), "keys")
    counts = sorted(map(tuple, fresh.groupBy("__part").count().collect()))
    before = itertools.accumulate((count for _, count in counts), initial=last + 1)
    firsts = spark.createDataFrame([(part, first) for (part, _), first in zip(counts, before)], "__part int, __first bigint")
    numbered = fresh.join(F.broadcast(firsts), "__part").withColumn(name, F.col("__first") + F.col("__place"))
    if counts or not known:
        numbered.select(*keys, name).write.mode("append").parquet(path)
    return null_safe_join(rows, key_map(spark, path, keys, name), keys)
