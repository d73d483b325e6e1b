"""File layout: partitioned writes, growing schemas, compaction, z-ordering."""

from __future__ import annotations

import functools
import itertools
import json
import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from tierline import session, settings
from tierline.operators.joins import broadcast_if, null_safe_join, row_bytes
from tierline.operators.quality import table_stats
from tierline.sources import tables

_Z = "__z"
_SALT = "__salt"
_CELL = "__cell"
_BIN = "__bin"
_FILE = "__file"
_PACKING = "_packing"  # readers skip names with an underscore
_SCHEMAS = "_schemas"
_INTEGERS = [ByteType, ShortType, IntegerType, LongType]
Z_BITS = 62  # of a z-value, a bigint
MOST_BITS = 9  # for each column, unless asked for


def write_partitioned(df: DataFrame, path: str, columns: list[str], mode: str = "overwrite") -> None:
    """One folder per value of ``columns``; overwriting replaces only the folders ``df`` has rows for.

    The rebalance hint gathers a value's rows to avoid tiny files, and lets AQE split the values
    that hold more rows than one task should write.
    """
    (
        df.hint("rebalance", *columns)
        .write.mode(mode)
        .partitionBy(*columns)
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )


def read_evolved(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet files of differing schemas under the union of their columns."""
    return spark.read.option("mergeSchema", True).parquet(*paths)


def _wider(one: DataType, other: DataType, where: str) -> DataType:
    """The type that Parquet files of either type can be read as."""
    if one == other:
        return one
    if isinstance(one, StructType) and isinstance(other, StructType):
        return widened(one, other, f"{where}.")
    if isinstance(one, ArrayType) and isinstance(other, ArrayType):
        return ArrayType(_wider(one.elementType, other.elementType, f"{where}[]"))
    if isinstance(one, MapType) and isinstance(other, MapType):
        return MapType(_wider(one.keyType, other.keyType, where), _wider(one.valueType, other.valueType, f"{where}[]"))
    kinds = {type(one), type(other)}
    if kinds <= set(_INTEGERS):
        return max(one, other, key=lambda kind: _INTEGERS.index(type(kind)))
    if kinds <= {*_INTEGERS[:-1], FloatType, DoubleType}:
        return DoubleType()
    if kinds == {DateType, TimestampNTZType}:
        return TimestampNTZType()
    if kinds == {DecimalType}:
        scale = max(one.scale, other.scale)
        digits = max(one.precision - one.scale, other.precision - other.scale)
        if digits + scale <= 38:
            return DecimalType(digits + scale, scale)
    raise ValueError(f"{where}: files of {one.simpleString()} and {other.simpleString()} cannot be read as one column")


def widened(one: StructType, other: StructType, where: str = "") -> StructType:
    """The columns of both schemas, each of a type that holds what either has: integers and decimals widen,
    float and short integers become double, dates become timestamps. Raises where no such type is."""
    theirs = {field.name: field for field in other}
    both = [
        StructField(field.name, _wider(field.dataType, theirs[field.name].dataType, where + field.name) if field.name in theirs else field.dataType)
        for field in one
    ]
    return StructType(both + [StructField(field.name, field.dataType) for field in other if field.name not in one.names])


def evolving_schema(spark: SparkSession, path: str) -> StructType:
    """All columns ever appended to the table at ``path``, from the schemas stored beside its files."""
    if not session.exists(spark, f"{path}/{_SCHEMAS}"):
        return StructType()
    stored = sorted(row.value for row in spark.read.text(f"{path}/{_SCHEMAS}").distinct().collect())
    versions = sorted((json.loads(line) for line in stored), key=lambda version: version["version"])
    return functools.reduce(widened, [StructType.fromJson(version["schema"]) for version in versions], StructType())


def append_evolving(df: DataFrame, path: str) -> None:
    """Append ``df`` to the table at ``path``, which may lack columns of it or have narrower ones.

    The schema is stored with the table when it grows, before the rows are: a run that dies between leaves
    columns without rows. Raises, and writes nothing, where a column's types do not fit together.
    """
    spark, known = df.sparkSession, evolving_schema(df.sparkSession, path)
    schema = widened(known, df.schema)
    if schema != known:
        line = json.dumps({"version": len(schema.names), "schema": schema.jsonValue()})
        spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(f"{path}/{_SCHEMAS}")
    df.write.mode("append").parquet(path)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path`` under all its columns, older rows with nulls or widened values. Planning opens no
    file of rows, however many there are."""
    return spark.read.schema(evolving_schema(spark, path)).parquet(path)


def _read(spark: SparkSession, source: str | DataFrame) -> DataFrame:
    return spark.read.parquet(source) if isinstance(source, str) else source


def compact(
    spark: SparkSession,
    source: str | DataFrame,
    target: str,
    file_bytes: int = settings.FILE_BYTES,
    partition_by: list[str] | None = None,
) -> None:
    """Rewrite many small files as few of about ``file_bytes``.

    A scan already packs small files into splits; coalescing joins neighbouring splits without a
    shuffle. A table with folders keeps them by ``partition_by``. ``source`` is a path or a table as read.
    """
    if partition_by:
        write_partitioned(_read(spark, source), target, partition_by)
        return
    files = max(1, math.ceil(table_stats(spark, source).first()["bytes"] / file_bytes))
    _read(spark, source).coalesce(files).write.parquet(target)


def _packed_files(spark: SparkSession, path: str, file_bytes: int) -> DataFrame:
    """(path, file_path, folder, bin, number): the files below ``path`` to be written as one, by their bin.

    Files of less than three quarters of ``file_bytes`` are laid end to end in each folder, and the line is
    cut every ``file_bytes``. A bin with one file gains nothing and is left out. Only the listing is read.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(path)
        .select("path", "_metadata.file_path", F.col("length").alias("size"))
    )
    small = listed.filter(F.col("size") < 0.75 * file_bytes).withColumn("folder", F.regexp_replace("path", "/[^/]+$", ""))
    line = F.sum("size").over(Window.partitionBy("folder").orderBy("size", "path")) - F.col("size")
    binned = small.withColumn("bin", F.floor(line / file_bytes))
    several = binned.withColumn("files", F.count(F.lit(1)).over(Window.partitionBy("folder", "bin"))).filter("files > 1")
    numbers = several.select("folder", "bin").distinct()
    numbers = numbers.withColumn("number", F.row_number().over(Window.orderBy("folder", "bin")) - 1)
    return several.join(numbers, ["folder", "bin"]).select("path", "file_path", "folder", "number")


def _finish_packing(spark: SparkSession, path: str) -> None:
    """Put the files of a prepared packing in the place of those they were made of; may be repeated."""
    work = f"{path}/{_PACKING}"
    if session.exists(spark, f"{work}/plan"):
        plan = spark.read.parquet(f"{work}/plan")
        for row in plan.select("path").toLocalIterator():
            session.discard(spark, row.path)
        for row in plan.select("number", "folder").distinct().toLocalIterator():
            session.move_files(spark, f"{work}/rows/{_BIN}={row.number}", row.folder)
    session.discard(spark, work)


def compact_small(spark: SparkSession, path: str, file_bytes: int = settings.FILE_BYTES) -> int:
    """Replace the small files of the Parquet table at ``path``, folder by folder, by fewer of about
    ``file_bytes``, and return how many went.

    Larger files, and small ones without a partner in their folder, are neither read nor touched. Rows of a
    bin meet in one task. The new files and the plan of the replacement are written before anything is
    replaced: a run that dies before leaves the table as it was, and the next run completes one that died
    later. Readers may miss rows while files change places, and nobody else may write meanwhile. The driver
    moves files one by one, as a commit does. An empty table stays as it is.
    """
    _finish_packing(spark, path)
    work = f"{path}/{_PACKING}"
    _packed_files(spark, path, file_bytes).write.parquet(f"{work}/planned")
    plan = spark.read.parquet(f"{work}/planned")
    files, bins, longest = plan.agg(F.count(F.lit(1)), F.max("number"), F.sum(F.length("file_path") + 32)).first()
    if files:
        paths = [row.path for row in plan.select("path").toLocalIterator()]
        rows = spark.read.option("mergeSchema", True).parquet(*paths).withColumn(_FILE, F.col("_metadata.file_path"))
        bin_of = broadcast_if(plan.select(F.col("file_path").alias(_FILE), F.col("number").alias(_BIN)), longest)
        gathered = rows.join(bin_of, _FILE).drop(_FILE).repartitionById(bins + 1, F.col(_BIN))
        gathered.write.partitionBy(_BIN).parquet(f"{work}/rows")
        session.rename(spark, f"{work}/planned", f"{work}/plan")
    _finish_packing(spark, path)
    return files


def _ordinal(column: str, data_type: DataType) -> Column:
    """A number that follows the order of ``column``, which is no string."""
    value = F.col(column)
    if isinstance(data_type, DateType):
        return F.unix_date(value).cast("double")
    if isinstance(data_type, (TimestampType, TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    if isinstance(data_type, BooleanType):
        return value.cast("int").cast("double")
    return value.cast("double")


def _by_bounds(value: Column, bounds: list, results: list[int]) -> Column:
    """The result for the interval of the ascending ``bounds`` that holds ``value``, by bisection."""
    if not bounds:
        return F.lit(results[0]).cast("bigint")
    middle = len(bounds) // 2
    return F.when(
        value < bounds[middle], _by_bounds(value, bounds[:middle], results[: middle + 1])
    ).otherwise(_by_bounds(value, bounds[middle + 1 :], results[middle + 1 :]))


def _spread(position: int, bits: int, stride: int, offset: int) -> int:
    """The bits of ``position`` moved ``stride`` apart."""
    return sum(((position >> bit) & 1) << (bit * stride + offset) for bit in range(bits))


def _text_bounds(df: DataFrame, column: str, intervals: int) -> list[str]:
    """Values that cut the rows of ``df`` into about equal intervals along a string column.

    Exact, from whole values: rows are counted per distinct value, the values range-partitioned, and
    each partition runs its counts up from those of the partitions before it. Only a value in which an
    interval ends leaves its partition, so the driver gets less than ``intervals`` of them and one
    count per partition.
    """
    counted = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))
    ranged = counted.filter(F.col("value").isNotNull()).repartitionByRange("value")
    values = session.stage(ranged.withColumn("part", F.spark_partition_id()), "values")
    totals = sorted(map(tuple, values.groupBy("part").agg(F.sum("rows")).collect()))
    if not totals:
        return []
    *ends, total = itertools.accumulate(rows for _, rows in totals)
    before = [(part, end) for (part, _), end in zip(totals, [0, *ends])]
    offsets = df.sparkSession.createDataFrame(before, "part int, before bigint")
    end = F.col("before") + F.sum("rows").over(Window.partitionBy("part").orderBy("value"))
    placed = values.join(F.broadcast(offsets), "part").withColumn("end", end)
    step = F.lit(total / intervals)
    crossed = F.floor(F.col("end") / step) > F.floor((F.col("end") - F.col("rows")) / step)
    return sorted(row.value for row in placed.filter(crossed & (F.col("end") < total)).select("value").collect())


def with_z_value(df: DataFrame, columns: list[str], name: str, bits: int = 5) -> DataFrame:
    """Adds the interleaved bits of each column's quantile position; nulls sort first.

    Quantiles rather than raw values make each bit halve the rows, whatever the distribution. They
    come from all rows: of numbers and times by sketches that merge, of strings by counting their
    distinct values. At most ``2**bits`` values per column come to the driver.
    """
    if not 1 <= bits * len(columns) <= Z_BITS:
        raise ValueError(f"{len(columns)} columns of {bits} bits do not fit a z-value of {Z_BITS} bits")
    kinds = {c: df.schema[c].dataType for c in columns}
    ordinals = {f"__ordinal_{c}": _ordinal(c, kind) for c, kind in kinds.items() if not isinstance(kind, StringType)}
    numbered = df.withColumns(ordinals) if ordinals else df
    steps = [i / 2**bits for i in range(1, 2**bits)]
    sketched = numbered.approxQuantile(list(ordinals), steps, min(0.01, 0.25 / 2**bits)) if ordinals else []
    found = dict(zip(ordinals, sketched))
    z = F.lit(0).cast("bigint")
    for index, column in enumerate(columns):
        ordinal = f"__ordinal_{column}"
        if ordinal in found:
            value, bounds = F.col(ordinal), sorted(set(found[ordinal]))
        else:
            value, bounds = F.col(column), _text_bounds(df, column, 2**bits)
        results = [_spread(position, bits, len(columns), index) for position in range(len(bounds) + 1)]
        part = F.when(value.isNull(), 0).otherwise(_by_bounds(value, bounds, results))
        z = z.bitwiseOR(part.cast("bigint"))
    return numbered.withColumn(name, z).drop(*ordinals)


def _aligned_files(celled: DataFrame, folders: list[str], depth: int, most: int) -> tuple[DataFrame, int]:
    """(folders, cell, first, parts) for each cell of ``depth`` bits along the curve, and how many files there are.

    A file takes the widest aligned run of cells, a power of two of them, with no more than ``most`` rows; so
    it covers one box of the columns' ranges, where a cut just anywhere would leave files with rows on both
    sides of a jump of the curve. A single cell beyond that is cut into ``parts`` files from ``first`` on.
    """
    cells = session.stage(celled.groupBy(*folders, _CELL).agg(F.count(F.lit(1)).alias("rows")), "cells")
    level = F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("level")
    above = cells.select("*", level).withColumn("node", F.expr(f"shiftright({_CELL}, level)"))
    nodes = above.groupBy(*folders, "level", "node").agg(F.sum("rows").alias("held"))
    fitting = null_safe_join(above, nodes.filter(F.col("held") <= most), [*folders, "level", "node"], "inner")
    widest = fitting.groupBy(*folders, _CELL).agg(F.max(F.struct("level", "node")).alias("own"))
    alone = F.struct(F.lit(-1).alias("level"), F.col(_CELL).alias("node"))
    owned = null_safe_join(cells, widest, [*folders, _CELL]).select(
        *folders,
        _CELL,
        F.coalesce("own", alone).alias("own"),
        F.when(F.col("own").isNull(), F.ceil(F.col("rows") / most)).otherwise(1).alias("parts"),
    )
    files = owned.select(*folders, "own", "parts").distinct()
    end = F.sum("parts").over(Window.orderBy(*folders, "own").rowsBetween(Window.unboundedPreceding, 0))
    numbered = files.withColumn("first", end - F.col("parts")).drop("parts")
    found = session.stage(null_safe_join(owned, numbered, [*folders, "own"]).drop("own"), "files")
    return found, found.agg(F.max(F.col("first") + F.col("parts"))).first()[0] or 1


def zorder(
    spark: SparkSession,
    source: str | DataFrame,
    target: str,
    columns: list[str],
    bits: int | None = None,
    file_bytes: int = settings.FILE_BYTES,
    partition_by: list[str] | None = None,
) -> None:
    """Rewrite the table at ``source`` so that rows close in all of ``columns`` share files.

    Without ``bits`` each column is cut into as many intervals as there are files, up to
    2**MOST_BITS; ``partition_by`` keeps a table's folders, each in z-order. Files end where boxes of the
    curve end, so they hold three quarters to one and a half of ``file_bytes`` where rows spread evenly,
    less where they do not. Within a cell rows are ordered by the columns themselves. Rows of one cell,
    however many, spread over tasks by their place in the source files: a salt that is stable when a
    task runs again.
    """
    table = _read(spark, source)
    stats = table_stats(spark, table).first()
    files = max(1, math.ceil(stats["bytes"] / file_bytes))
    if bits is None:
        bits = max(1, min(max(5, math.ceil(math.log2(files))), MOST_BITS, Z_BITS // len(columns)))
    folders = partition_by or []
    depth = min(bits * len(columns), math.ceil(math.log2(files)) + 4)
    placed = with_z_value(table.withColumn(_SALT, F.xxhash64("_metadata.file_path", "_metadata.row_index")), columns, _Z, bits)
    celled = placed.withColumn(_CELL, F.shiftright(_Z, bits * len(columns) - depth))
    file_of, count = _aligned_files(celled, folders, depth, max(1, math.ceil(1.5 * stats["rows"] / files)))
    size = file_of.agg(F.sum(row_bytes(file_of, file_of.columns))).first()[0] or 0
    numbered = null_safe_join(celled, broadcast_if(file_of, size), [*folders, _CELL])
    (
        numbered.withColumn(_FILE, (F.col("first") + F.pmod(_SALT, "parts")).cast("int"))
        .repartitionById(count, F.col(_FILE))
        .sortWithinPartitions(*folders, _Z, *columns)
        .select(*table.columns)
        .write.partitionBy(*folders)
        .parquet(target)
    )


def optimise_table(
    spark: SparkSession, name: str, columns: list[str], root: str, file_bytes: int = settings.FILE_BYTES
) -> None:
    """Z-order catalog table ``name`` by ``columns``, or compact it where there are none, and make the
    copy, written below ``root``, current.

    The table keeps its folders, and the columns of those are left out of the z-order: a folder has
    one value of each. Give ``root`` a place that lasts.
    """
    tables.finish_replacing(spark, name)
    rows, folders = tables.read_table(spark, name), tables.folders_of(spark, name)
    path = f"{root}/{name}-{uuid.uuid4().hex}"
    inner = [column for column in columns if column not in folders]
    if rows.isEmpty():
        return
    if inner:
        zorder(spark, rows, path, inner, file_bytes=file_bytes, partition_by=folders)
    else:
        compact(spark, rows, path, file_bytes, folders)
    tables.replace_files(spark, name, path)
