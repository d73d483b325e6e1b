"""Row-level cleaning: dedup, required columns, valid ranges, text normalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, CalendarIntervalType, DataType, MapType, StructType, VariantType

from tierline.functions import text

_PICK = "__pick"


def _orderable(data_type: DataType) -> bool:
    if isinstance(data_type, ArrayType):
        return _orderable(data_type.elementType)
    if isinstance(data_type, StructType):
        return all(_orderable(f.dataType) for f in data_type)
    return not isinstance(data_type, (MapType, VariantType, CalendarIntervalType))


def ties(df: DataFrame, besides: list[str]) -> list[Column]:
    """An order by all other columns, so that only equal rows tie: those without an order, such as maps,
    last and by a hash of their JSON."""
    others = [f for f in df.schema if f.name not in besides]
    plain = [F.asc(f.name) for f in others if _orderable(f.dataType)]
    return plain + [F.xxhash64(F.to_json(F.struct(f.name))) for f in others if not _orderable(f.dataType)]


def dedup_latest(
    df: DataFrame, keys: list[str], latest: list[str] | None = None, tie_break: list[str] | None = None
) -> DataFrame:
    """One row per key: the greatest by ``latest``, ties by ``tie_break`` ascending.

    By default every remaining column breaks ties, so the survivor never depends on partitioning.
    Spark turns the ``== 1`` filter into a group limit before the shuffle: each map task sends at
    most one row per key, which keeps a hot key small.
    """
    latest = latest or []
    order = [F.desc(name) for name in latest]
    order += ties(df, [*keys, *latest]) if tie_break is None else [F.asc(name) for name in tie_break]
    best = Window.partitionBy(*keys).orderBy(*(order or [F.lit(1)]))
    return df.withColumn(_PICK, F.row_number().over(best)).filter(F.col(_PICK) == 1).drop(_PICK)


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows where none of ``columns`` is null (or NaN)."""
    return df.dropna(subset=columns)


def keep_positive(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) > 0)


def normalise(
    df: DataFrame, trim: list[str] = (), lower: list[str] = (), upper: list[str] = ()
) -> DataFrame:
    """Trim the named columns; those under ``lower`` or ``upper`` also change case."""
    return df.withColumns(
        {name: text.trimmed(F.col(name)) for name in trim}
        | {name: text.lowered(F.col(name)) for name in lower}
        | {name: text.raised(F.col(name)) for name in upper}
    )
