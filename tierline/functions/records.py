"""Fields of nested records, with defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def field(path: str, default=None, cast: str | None = None) -> Column:
    """The field at a dotted path; absent and null both take ``default``."""
    value = F.col(path)
    value = value.try_cast(cast) if cast else value
    return value if default is None else F.coalesce(value, F.lit(default))


def json_field(text: Column, schema: str | StructType, path: str, default=None) -> Column:
    """One field out of JSON text; malformed text takes ``default`` too."""
    value = F.from_json(text, schema)
    for name in path.split("."):
        value = value.getField(name)
    return value if default is None else F.coalesce(value, F.lit(default))
