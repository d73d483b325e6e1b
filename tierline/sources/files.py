"""File sources. Schemas are explicit: no inference pass, and files that drift do not change types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tierline.functions.records import field
from tierline.session import stage

_RECORD, _FILE = "__record", "__file"


def read_json_records(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    fields: dict[str, tuple] | None = None,
    multiline: bool = False,
) -> DataFrame:
    """JSON records flattened to typed columns.

    ``fields`` maps an output column to ``(dotted path, default)``; a default of None leaves nulls.
    Absent keys, JSON nulls and values of the wrong type read as null, hence as the default. With
    one record per line large files are split; ``multiline`` reads a whole file in one task.
    """
    records = spark.read.schema(schema).option("mode", "PERMISSIVE").option("multiLine", multiline).json(path)
    if fields is None:
        return records
    return records.select(*flattened(fields))


def flattened(fields: dict[str, tuple]) -> list[Column]:
    """The columns that ``fields`` describes, as for ``read_json_records``."""
    return [field(where, default).alias(name) for name, (where, default) in fields.items()]


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    sep: str = ",",
    encoding: str = "utf-8",
    header: bool = True,
    mode: str = "PERMISSIVE",
) -> DataFrame:
    reader = spark.read.schema(schema).option("sep", sep).option("encoding", encoding)
    return reader.option("header", header).option("mode", mode).csv(path)


def split_malformed(
    spark: SparkSession, path: str, schema: StructType, file_format: str, sep: str = ",", **options
) -> tuple[DataFrame, DataFrame]:
    """(rows that fit ``schema``, the others as (record, reason, file)) of JSON lines or CSV.

    The files are parsed once, into a stored copy that both read, and between them they hold every line;
    count ``reason`` for a report.
    A missing key of JSON is null and no fault; a CSV line needs as many fields as the schema.
    """
    typed = StructType([*schema.fields, StructField(_RECORD, StringType())])
    reader = spark.read.schema(typed).options(**options).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _RECORD)
    record = F.col(_RECORD)
    if file_format == "json":
        rows = reader.json(path)
        broken = F.try_parse_json(record).isNull()
        reason = F.when(broken, "not JSON").otherwise("a value of the wrong type")
    else:
        rows = reader.option("sep", sep).option("columnPruning", False).csv(path)
        short = F.size(F.split(record, F.concat(F.lit("\\Q"), F.lit(sep), F.lit("\\E")), -1)) != len(schema.fields)
        reason = F.when(short, "another number of fields").otherwise("a value of the wrong type")
    stored = stage(rows.withColumn(_FILE, F.col("_metadata.file_path")), "parsed")
    bad = stored.filter(record.isNotNull()).select(record.alias("record"), reason.alias("reason"), F.col(_FILE).alias("file"))
    return stored.filter(record.isNull()).drop(_RECORD, _FILE), bad


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def literal_rows(spark: SparkSession, rows: list[tuple], schema: str | StructType) -> DataFrame:
    """A few rows given in code, for fixtures and small lookups."""
    return spark.createDataFrame(rows, schema)


def with_constant(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))
