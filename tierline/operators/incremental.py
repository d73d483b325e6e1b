"""High-mark incremental loads into versioned snapshots.

A table lives below ``root/table``: ``snapshot-N`` folders with data and an append-only ``state``
log. One line of that log names the current snapshot and its high mark together, and is written
after the data. A run that dies before leaves the old state valid; the next run writes the same
snapshot again, and the keyed upsert absorbs rows it meets twice. One writer per table at a time.

A table with folders is updated in place. The rows of the folders a run touches are written beside the
table first; the line that commits them calls them ``pending``, and a second line says that the folders
hold them. A run that dies in between loses nothing: readers take the pending rows in place of the
touched folders, and the next run moves them in before anything else.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampType

from tierline import settings
from tierline.operators.upsert import apply_merge, merge_frames, merged_view, one_per_key, prepare_merge
from tierline.session import discard, stage
from tierline.sources.tables import publish

STATE_SCHEMA = "table_name string, last_watermark string, seq bigint, snapshot string, pending string"


class State(NamedTuple):
    mark: str | None
    seq: int
    snapshot: str
    pending: str | None = None


def _state_path(root: str, table: str) -> str:
    return f"{root}/{table}/state"


def read_state(spark: SparkSession, root: str, table: str) -> State | None:
    """The last committed state; None only if the table was never loaded."""
    try:
        log = spark.read.schema(STATE_SCHEMA).json(_state_path(root, table))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    last = log.filter(F.col("table_name") == table).orderBy(F.desc("seq"), F.asc_nulls_first("pending")).first()
    return State(last["last_watermark"], last["seq"], last["snapshot"], last["pending"]) if last else None


def write_state(spark: SparkSession, root: str, table: str, state: State) -> None:
    """Append ``state``; call it after the data it names is written."""
    row = [(table, state.mark, state.seq, state.snapshot, state.pending)]
    frame = spark.createDataFrame(row, STATE_SCHEMA).coalesce(1)
    frame.write.mode("append").json(_state_path(root, table))


def read_mark(spark: SparkSession, root: str, table: str) -> str | None:
    state = read_state(spark, root, table)
    return state.mark if state else None


def current(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """The committed rows, or None before the first load."""
    state = read_state(spark, root, table)
    if state is None:
        return None
    path = f"{root}/{table}/{state.snapshot}"
    return merged_view(spark, path, f"{root}/{table}/{state.pending}") if state.pending else spark.read.parquet(path)


def settled(spark: SparkSession, root: str, table: str) -> State | None:
    """The last committed state, with its pending rows moved in."""
    state = read_state(spark, root, table)
    if state is None or state.pending is None:
        return state
    prepared = f"{root}/{table}/{state.pending}"
    apply_merge(spark, f"{root}/{table}/{state.snapshot}", prepared)
    state = state._replace(pending=None)
    write_state(spark, root, table, state)
    discard(spark, prepared)
    return state


def rows_after(df: DataFrame, column: str, mark: str | None, inclusive: bool = False) -> DataFrame:
    """Rows beyond the mark, and those without one; all rows if there is no mark.

    A row whose mark column is null could otherwise never enter; the upsert absorbs its repetition.

    ``inclusive`` also takes rows equal to the mark, for sources that add more of them later; the
    upsert makes the repetition harmless. The mark is a literal, so the filter reaches the scan.
    """
    if mark is None:
        return df
    bound = _mark_value(mark, df.schema[column].dataType)
    beyond = F.col(column) >= bound if inclusive else F.col(column) > bound
    return df.filter(beyond | F.col(column).isNull())


def _mark_value(mark: str, kind: DataType) -> Column:
    return F.lit(f"{mark}Z" if isinstance(kind, TimestampType) else mark).cast(kind)


def high_mark(df: DataFrame, column: str, stored: str | None = None) -> str | None:
    """The greatest mark of ``df`` and ``stored``: a mark never moves back.

    Points in time are written in UTC, so the session's zone does not shift the next slice.
    """
    kind = df.schema[column].dataType
    newest = F.max(column)
    if stored is not None:
        newest = F.greatest(newest, _mark_value(stored, kind))
    if isinstance(kind, TimestampType):  # as the clock of UTC shows it
        seconds = F.unix_micros(newest).cast("decimal(24,6)") / F.lit(1_000_000).cast("decimal(7,0)")
        newest = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    return df.agg(newest.cast("string")).first()[0]


def commit(
    spark: SparkSession, df: DataFrame, root: str, table: str, mark: str | None, partition_by: list[str] | None = None
) -> State:
    """Write ``df`` as the next snapshot, then make it current."""
    last = read_state(spark, root, table)
    seq = last.seq + 1 if last else 1
    state = State(mark, seq, f"snapshot-{seq:06d}")
    if partition_by and df.isEmpty():
        partition_by = None  # folders could not tell the schema of no rows
    # overwrite clears only what an unfinished run may have left at this not yet current path
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*(partition_by or []))
    writer.parquet(f"{root}/{table}/{state.snapshot}")
    write_state(spark, root, table, state)
    return state


def load(
    df: DataFrame,
    root: str,
    table: str,
    mode: str = "incremental",
    mark_col: str | None = None,
    pk: str | None = None,
    inclusive: bool = False,
    partition_by: list[str] | None = None,
) -> State:
    """Bring ``table`` up to date with source ``df``.

    ``full_load`` replaces the rows. ``incremental`` takes the rows beyond the mark, upserts them by
    ``pk`` and moves the mark. The new mark is read before the rows are, so rows that arrive in
    between are loaded again next time rather than lost. With ``partition_by`` a run rewrites only
    the folders it touches, in place, instead of a whole new snapshot.
    """
    spark = df.sparkSession
    if mode == "full_load":
        return commit(spark, df, root, table, None, partition_by)
    if mode != "incremental":
        raise ValueError(f"unknown load mode: {mode}")
    last = settled(spark, root, table)
    fresh = rows_after(df, mark_col, last.mark if last else None, inclusive)
    if last is not None:
        fresh = stage(fresh, "fresh")  # the merge reads it several times, and the source may be a long chain
    mark = high_mark(fresh, mark_col, last.mark if last else None)
    if last is not None and fresh.isEmpty():
        return last
    return upsert_rows(spark, fresh, root, table, pk, [mark_col], mark, partition_by)


def upsert_rows(
    spark: SparkSession,
    fresh: DataFrame,
    root: str,
    table: str,
    pk: str,
    latest: list[str] | None,
    mark: str | None,
    partition_by: list[str] | None = None,
) -> State:
    """Upsert ``fresh`` into the table, as a new snapshot or folder by folder, and commit ``mark``."""
    last = settled(spark, root, table)
    if partition_by is None:
        old = current(spark, root, table)
        merged = one_per_key(fresh, pk, latest) if old is None else merge_frames(old, fresh, pk, latest)
        return commit(spark, merged, root, table, mark)
    if last is None or current(spark, root, table).isEmpty():
        return commit(spark, one_per_key(fresh, pk, latest), root, table, mark, partition_by)
    state = State(mark, last.seq + 1, last.snapshot, f"pending-{last.seq + 1:06d}")
    path = f"{root}/{table}/{last.snapshot}"
    prepare_merge(spark, path, fresh, pk, partition_by, latest, f"{root}/{table}/{state.pending}")
    write_state(spark, root, table, state)
    return settled(spark, root, table)


def load_configured(df: DataFrame, root: str, table: str) -> State:
    """``load`` with the mode, mark column, key and folders that the settings give for ``table``.

    The folder columns derive from others, so that an incremental run rewrites only those it touches;
    ``loaded`` reads the rows without them.
    """
    folders = settings.LOAD_FOLDERS.get(table, {})
    placed = df.withColumns({name: F.expr(rule) for name, rule in folders.items()})
    return load(placed, root, table, **settings.LOAD_MODES[table], partition_by=list(folders) or None)


def loaded(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """What ``load_configured`` has brought in so far."""
    rows = current(spark, root, table)
    return None if rows is None else rows.drop(*settings.LOAD_FOLDERS.get(table, {}))


def upsert_table(
    new: DataFrame, root: str, name: str, pk: str, latest: list[str] | None = None, partition_by: list[str] | None = None
) -> State:
    """Upsert ``new`` into catalog table ``name``, kept below ``root`` and created if absent."""
    spark = new.sparkSession
    state = upsert_rows(spark, new, root, name, pk, latest, read_mark(spark, root, name), partition_by)
    publish(spark, name, f"{root}/{name}/{state.snapshot}")
    return state
