"""Ranks, row numbers, change from the previous row, and top-k.

Numbers are bigint: a group may hold more rows than an int can count.

``rows_per_task`` bounds what one task sorts. Groups are measured first (a pass over the key columns
only), and those beyond the bound are computed in slices with the same result, see ``slices``. Pass
None to skip the measurement where groups are known to be small.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline import session, settings
from tierline.operators.clean import ties
from tierline.operators.joins import broadcast_if, null_safe_join, row_bytes
from tierline.operators.slices import ROW, SLICE, join_to_slices, slice_groups, split_hot

MIN_REPEAT = 20  # rows per distinct value from which ranking the values beats ranking the rows


def number_within(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    name: str,
    rows_per_task: int | None = settings.ROWS_PER_TASK,
) -> DataFrame:
    """row_number of each row in its group. All other columns break ties, so sliced or not the numbers agree."""
    order = [*order, *ties(df, keys)]

    def plain(rows: DataFrame) -> DataFrame:
        window = Window.partitionBy(*keys).orderBy(*order)
        return rows.withColumn(name, F.row_number().over(window).cast("bigint"))

    if rows_per_task is None:
        return plain(df)
    ordinary, hot, hot_rows = split_hot(df, keys, rows_per_task)
    if hot is None:
        return plain(ordinary)
    sliced = _number_sliced(hot, keys, order, name, hot_rows, rows_per_task)
    return sliced if ordinary is None else plain(ordinary).unionByName(sliced)


def _number_sliced(
    df: DataFrame, keys: list[str], order: list[Column], name: str, rows: int, rows_per_task: int
) -> DataFrame:
    sliced = slice_groups(df, keys, order, rows, rows_per_task)
    inside = Window.partitionBy(*keys, SLICE).orderBy(*order, ROW)
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    counts = sliced.groupBy(*keys, SLICE).count()
    offsets = counts.select(*keys, SLICE, F.sum("count").over(earlier).alias("__before"))
    numbered = join_to_slices(sliced.withColumn(name, F.row_number().over(inside)), offsets.filter("__before > 0"), keys)
    position = F.col(name) + F.coalesce("__before", F.lit(0))
    return numbered.withColumn(name, position.cast("bigint")).drop(ROW, SLICE, "__before")


def dense_rank_within(
    df: DataFrame,
    keys: list[str],
    by: str,
    name: str,
    descending: bool = True,
    rows_per_task: int | None = settings.ROWS_PER_TASK,
) -> DataFrame:
    """dense_rank of ``by`` in each group; nulls rank last when descending.

    Values that hardly repeat take one window over the rows. Otherwise the distinct values are ranked
    and joined back: the rows are then neither sorted nor, while the values fit a broadcast, shuffled.
    So it also goes for a group too large for one task, whose distinct values are sliced if need be.
    """
    order = [F.desc(by) if descending else F.asc(by)]
    pair = [*keys, by]

    def plain() -> DataFrame:
        rank = F.dense_rank().over(Window.partitionBy(*keys).orderBy(*order))
        return df.withColumn(name, rank.cast("bigint"))

    if rows_per_task is None:
        return plain()
    groups = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.approx_count_distinct(by).alias("values"),
        F.max(row_bytes(df, pair)).alias("width"),
    )
    found = groups.agg(F.max("n"), F.sum("n"), F.sum("values"), F.max("width")).first()
    largest, rows, values, width = (value or 0 for value in found)
    if largest <= rows_per_task and values * MIN_REPEAT > rows:
        return plain()
    distinct = df.select(*pair).distinct()
    most = 2 * values  # twice the estimate is far outside its error
    if most <= rows_per_task:
        ranked = number_within(distinct, keys, order, name, None)
    else:
        ranked = number_within(session.stage(distinct, "values"), keys, order, name, rows_per_task)
    if most * width > settings.BROADCAST_BYTES and values * MIN_REPEAT <= rows:
        # hashed: so few values beside the rows of each task, and the rows need not be sorted to meet them
        return null_safe_join(df, ranked.hint("shuffle_hash"), pair)
    return null_safe_join(df, broadcast_if(ranked, most * width), pair)


def previous_within(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: str,
    name: str,
    rows_per_task: int | None = settings.ROWS_PER_TASK,
) -> DataFrame:
    """``value`` of the preceding row of the group, ascending by ``order``; null on the first row.

    All other columns break ties, so the result depends neither on the layout nor on slicing.
    """
    ascending = [*[F.asc(column) for column in order], *ties(df, [*keys, *order])]

    def plain(rows: DataFrame) -> DataFrame:
        return rows.withColumn(name, F.lag(value).over(Window.partitionBy(*keys).orderBy(*ascending)))

    if rows_per_task is None:
        return plain(df)
    ordinary, hot, hot_rows = split_hot(df, keys, rows_per_task)
    if hot is None:
        return plain(ordinary)
    sliced = _previous_sliced(hot, keys, ascending, value, name, hot_rows, rows_per_task)
    return sliced if ordinary is None else plain(ordinary).unionByName(sliced)


def _previous_sliced(
    df: DataFrame, keys: list[str], order: list[Column], value: str, name: str, rows: int, rows_per_task: int
) -> DataFrame:
    sliced = slice_groups(df, keys, order, rows, rows_per_task)
    inside = Window.partitionBy(*keys, SLICE).orderBy(*order, ROW)
    inner = sliced.withColumns({name: F.lag(value).over(inside), "__nth": F.row_number().over(inside)})
    tails = inner.groupBy(*keys, SLICE).agg(F.max_by(value, "__nth").alias("__last"))
    carried = F.lag("__last").over(Window.partitionBy(*keys).orderBy(SLICE)).alias("__carried")
    joined = join_to_slices(inner, tails.select(*keys, SLICE, carried), keys)
    previous = F.when(F.col("__nth") == 1, F.col("__carried")).otherwise(F.col(name))
    return joined.withColumn(name, previous).drop(ROW, SLICE, "__nth", "__carried")


GROUP_LIMIT = 1000  # Spark's own bound for limiting groups before the shuffle
SHARES = 8  # shares of ``rows_per_task`` rows that the first rows of a too large group are sought in


def top_k(
    df: DataFrame,
    order: list[Column],
    k: int,
    keys: list[str] | None = None,
    rows_per_task: int | None = settings.ROWS_PER_TASK,
) -> DataFrame:
    """The first ``k`` rows, overall or per group. All other columns break ties, whatever ``k``.

    Spark limits small groups on the map side. For a larger ``k`` the rows are numbered; those of too
    large groups are dealt out to even shares first, of which only the first ``k`` of a group go on. A ``k``
    that would leave the shares nearly whole has the groups numbered in slices instead.
    """
    keys = keys or []
    if k <= GROUP_LIMIT:
        order = [*order, *ties(df, keys)]
        if not keys:
            return df.orderBy(*order).limit(k)
        window = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn("__nth", F.row_number().over(window)).filter(F.col("__nth") <= k).drop("__nth")

    def first(rows: DataFrame, bound: int | None) -> DataFrame:
        return number_within(rows, keys, order, "__nth", bound).filter(F.col("__nth") <= k).drop("__nth")

    if rows_per_task is None or 4 * k > rows_per_task:
        return first(df, rows_per_task)
    ordinary, hot, hot_rows = split_hot(df, keys, rows_per_task)
    if hot is None:
        return first(ordinary, None)
    shares = math.ceil(hot_rows / max(4 * k, rows_per_task // SHARES))
    best = first(session.stage(_first_of_shares(hot, keys, order, k, shares), "first"), rows_per_task)
    return best if ordinary is None else first(ordinary, None).unionByName(best)


def _first_of_shares(df: DataFrame, keys: list[str], order: list[Column], k: int, shares: int) -> DataFrame:
    """The first ``k`` rows of each group in each of ``shares`` equal parts of ``df``: all that may be among its
    first ``k``. The part of a row is pinned, and equal rows spread over the parts too."""
    order = [*order, *ties(df, keys)]
    pinned = session.stage(df.withColumn(ROW, F.monotonically_increasing_id()), "rows")
    dealt = pinned.withColumn(SLICE, F.pmod(F.xxhash64(ROW), F.lit(shares)).cast("int")).drop(ROW)
    window = Window.partitionBy(SLICE, *keys).orderBy(*order)
    numbered = dealt.repartitionById(shares, F.col(SLICE)).withColumn("__nth", F.row_number().over(window))
    return numbered.filter(F.col("__nth") <= k).drop("__nth", SLICE)
