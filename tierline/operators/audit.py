"""Audit columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The timestamp column of each layer.
TIMESTAMP_COLUMNS = {
    "bronze": "_ingest_ts",
    "silver": "_silver_ingest_ts",
    "silver_transformed": "_transform_ts",
    "gold": "_gold_ingest_ts",
}


def _now(ts: dt.datetime | None) -> Column:
    return F.current_timestamp() if ts is None else F.lit(ts)


def stamp(
    df: DataFrame, layer: str, source: str, pipeline: str, env: str, ts: dt.datetime | None = None
) -> DataFrame:
    """Add (or refresh) load time, layer, source, pipeline and environment."""
    return df.withColumns(
        {
            TIMESTAMP_COLUMNS[layer]: _now(ts),
            "_layer": F.lit(layer),
            "_source_table": F.lit(source),
            "_pipeline": F.lit(pipeline),
            "_env": F.lit(env),
        }
    )


def stamp_raw(
    df: DataFrame,
    source: str,
    ts: dt.datetime | None = None,
    pipeline: str | None = None,
    env: str | None = None,
) -> DataFrame:
    """The short form for raw tables: load time and source, and on request pipeline and environment."""
    columns = {"_ingest_ts": _now(ts), "_source": F.lit(source)}
    if pipeline is not None:
        columns["_pipeline_name"] = F.lit(pipeline)
    if env is not None:
        columns["_env"] = F.lit(env)
    return df.withColumns(columns)
