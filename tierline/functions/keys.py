"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _length_prefixed(column: Column) -> Column:
    text = column.cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("N"))


def surrogate(*business_key: str, mode: str = "md5") -> Column:
    """A key for one row.

    ``md5``: 128 bits of the business key. Repeatable, and collision-free in practice at any row
    count. Parts are length-prefixed, so (a, null), (null, a) and (a, '') stay apart.
    ``xxhash64``: a bigint, repeatable. 64 bits start to collide at some billion rows; check it
    with ``quality.key_collisions``.
    ``monotonic``: a bigint, unique within one run but different in the next.
    """
    if mode == "monotonic":
        return F.monotonically_increasing_id()
    if mode == "xxhash64":
        return F.xxhash64(*business_key)
    if mode == "md5":
        return F.md5(F.concat(*[_length_prefixed(F.col(name)) for name in business_key]))
    raise ValueError(f"unknown surrogate mode: {mode}")
