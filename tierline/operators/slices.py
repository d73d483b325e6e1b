"""Splitting window groups that are too large for one task.

A window sorts each group in a single task. Rows of a group that is too large for that are
range-partitioned by (group, order) instead, so that the group runs on over neighbouring slices;
what a slice needs from those before it is one row per (group, slice).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline import session
from tierline.operators.joins import broadcast_if, null_safe_join, row_bytes

ROW = "__row"
SLICE = "__slice"


def split_hot(
    df: DataFrame, keys: list[str], rows_per_task: int
) -> tuple[DataFrame | None, DataFrame | None, int]:
    """``df`` as (rows of ordinary groups, rows of too large groups, how many the latter are).

    Measuring is one pre-aggregated pass over the key columns. There can be no more than
    rows / rows_per_task large groups, so their keys are few.
    """
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    if not keys:
        rows = groups.first()[0]
        return (None, df, rows) if rows > rows_per_task else (df, None, 0)
    large = session.stage(groups.filter(F.col("__rows") > rows_per_task), "hot")
    rows, size = large.agg(F.sum("__rows"), F.sum(row_bytes(large, keys))).first()
    if rows is None:
        return df, None, 0
    hot = broadcast_if(large.select(*keys), size)
    return null_safe_join(df, hot, keys, "left_anti"), null_safe_join(df, hot, keys, "left_semi"), rows


def slice_groups(
    df: DataFrame, keys: list[str], order: list[Column], rows: int, rows_per_task: int
) -> DataFrame:
    """``df`` staged with ``__slice``, ascending along (keys, order), and a unique ``__row``.

    Staging first pins ``__row``, which lets even equal rows fall into different slices. Staging
    the sliced rows again pins their slice: the bounds of a range partitioning are sampled anew
    whenever a plan runs, and the passes that follow must agree on them.
    """
    pinned = session.stage(df.withColumn(ROW, F.monotonically_increasing_id()), "rows")
    parts = max(1, math.ceil(rows / rows_per_task))
    ordered = pinned.repartitionByRange(parts, *[F.col(k) for k in keys], *order, F.col(ROW))
    return session.stage(ordered.withColumn(SLICE, F.spark_partition_id()), "slices")


def join_to_slices(sliced: DataFrame, carried: DataFrame, keys: list[str]) -> DataFrame:
    """``sliced`` with what each (group, slice) takes from those before it.

    There are no more such pairs than slices and large groups together. They are written and measured,
    so that the sliced rows need not be shuffled once more for them.
    """
    small = session.stage(carried, "carried")
    size = small.agg(F.sum(row_bytes(small, small.columns))).first()[0] or 0
    return null_safe_join(sliced, broadcast_if(small, size), [*keys, SLICE])
