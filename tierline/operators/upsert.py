"""Keyed upsert: matched rows are replaced, new rows added, the rest stays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.operators.clean import dedup_latest
from tierline.operators.joins import null_safe_join
from tierline.operators.layout import write_partitioned
from tierline.session import discard, scratch_path

MOST_FOLDERS = 10_000  # values of a folder column named in a filter


def one_per_key(new: DataFrame, pk: str, latest: list[str] | None = None) -> DataFrame:
    """``new`` with one row per key, the last by ``latest``; rows without a key all stay."""
    keyed = dedup_latest(new.filter(F.col(pk).isNotNull()), [pk], latest)
    return keyed.unionByName(new.filter(F.col(pk).isNull()))


def merge_frames(
    old: DataFrame, new: DataFrame, pk: str, latest: list[str] | None = None, unique: bool = False
) -> DataFrame:
    """``old`` upserted with ``new``.

    A null key matches nothing: null-keyed rows of ``old`` stay and those of ``new`` are added.
    Columns only in ``new`` are added; columns only in ``old`` keep their value on matched rows.
    ``old`` must hold each key once. Pass ``unique=True`` where ``new`` is known to as well.

    While the keys of ``new`` are few, Spark broadcasts them and ``old`` streams through without a
    shuffle; otherwise AQE splits skewed partitions of the shuffled join.
    """
    fresh = new if unique else one_per_key(new, pk, latest)
    absent = [name for name in old.columns if name not in new.columns]
    if absent:
        kept_values = old.join(new.select(pk).distinct(), pk, "left_semi").select(pk, *absent)
        fresh = fresh.join(kept_values, pk, "left")
    untouched = old.join(new.select(pk).distinct(), pk, "left_anti")
    return untouched.unionByName(fresh, allowMissingColumns=True)


def merge_into_partitions(
    spark: SparkSession,
    path: str,
    new: DataFrame,
    pk: str,
    partition_by: list[str],
    latest: list[str] | None = None,
) -> None:
    """Upsert ``new`` into the partitioned Parquet table at ``path``, rewriting only touched folders.

    For tables far larger than what arrives. Readers may see folders change one by one, and a driver
    lost while they do leaves the table half merged: ``incremental.load`` prepares and applies the
    merge apart and so survives that.
    """
    prepared = scratch_path(spark, "merge")
    prepare_merge(spark, path, new, pk, partition_by, latest, prepared)
    apply_merge(spark, path, prepared)
    discard(spark, prepared)


def prepare_merge(
    spark: SparkSession,
    path: str,
    new: DataFrame,
    pk: str,
    partition_by: list[str],
    latest: list[str] | None,
    prepared: str,
) -> None:
    """Write the folders a merge touches, and all rows they will hold, below ``prepared``.

    Touched are the folders that new rows go to and those that replaced rows leave. Finding the latter
    reads the key column only, and no more where ``partition_by`` derives from the key. The new rows, one
    per key, are stored before all else, as they are read several times.
    """
    table = spark.read.parquet(path)
    one_per_key(new, pk, latest).write.mode("overwrite").parquet(f"{prepared}/fresh")
    fresh = spark.read.schema(new.schema).parquet(f"{prepared}/fresh")
    leaving = table.select(pk, *partition_by).join(fresh.select(pk), pk, "left_semi")
    places = fresh.select(*partition_by).union(leaving.select(*partition_by)).distinct()
    places.write.mode("overwrite").parquet(f"{prepared}/touched")
    touched = spark.read.schema(places.schema).parquet(f"{prepared}/touched")
    old = null_safe_join(folders_in(table, touched, partition_by), touched, partition_by, "left_semi")
    merged = merge_frames(old, fresh, pk, unique=True)
    merged.write.mode("overwrite").parquet(f"{prepared}/rows")


def apply_merge(spark: SparkSession, path: str, prepared: str) -> None:
    """Replace the touched folders by their prepared rows. Repeating it gives the same table."""
    rows, touched = (spark.read.parquet(f"{prepared}/{part}") for part in ("rows", "touched"))
    write_partitioned(rows, path, touched.columns)
    emptied = null_safe_join(touched, rows.select(*touched.columns), touched.columns, "left_anti")
    _drop_folders(spark, path, emptied)


def merged_view(spark: SparkSession, path: str, prepared: str) -> DataFrame:
    """The table at ``path`` as it is once the prepared merge is applied, however far that has come."""
    rows, touched = (spark.read.parquet(f"{prepared}/{part}") for part in ("rows", "touched"))
    table = spark.read.schema(rows.schema).parquet(path)
    return null_safe_join(table, touched, touched.columns, "left_anti").unionByName(rows)


def folders_in(table: DataFrame, touched: DataFrame, partition_by: list[str]) -> DataFrame:
    """``table`` filtered to values that ``touched`` has, column by column, so that the scan lists only
    folders that may be touched. A column with more than ``MOST_FOLDERS`` values stays unfiltered; the
    caller's join decides either way."""
    for column in partition_by:
        values = [row[0] for row in touched.select(column).distinct().limit(MOST_FOLDERS + 1).collect()]
        if len(values) > MOST_FOLDERS:
            continue
        named = [value for value in values if value is not None]
        condition = F.col(column).isin(named) if named else F.lit(False)
        table = table.filter(condition | F.col(column).isNull() if None in values else condition)
    return table


def _drop_folders(spark: SparkSession, path: str, places: DataFrame) -> None:
    """Delete folders that lost all their rows; an overwrite leaves them as they are."""
    if places.isEmpty():
        return
    columns = places.columns
    stale = null_safe_join(folders_in(spark.read.parquet(path), places, columns), places, columns, "left_semi")
    folders = stale.select(F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("folder")).distinct()
    for row in folders.toLocalIterator():
        # the metadata column holds the path as an encoded URI
        discard(spark, spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(row["folder"])).toString())
