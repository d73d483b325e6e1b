"""The incremental load as a stream: new files only, then stop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tierline.operators.incremental import high_mark, read_mark, upsert_rows
from tierline.session import stage


def stream_upsert(
    spark: SparkSession,
    source: str,
    schema: str | StructType,
    checkpoint: str,
    root: str,
    table: str,
    pk: str,
    latest: list[str],
    file_format: str = "parquet",
    max_files: int | None = None,
    partition_by: list[str] | None = None,
) -> int:
    """Upsert the files that arrived in ``source`` since the last run; returns the batches processed.

    The checkpoint remembers which files were read, and ``availableNow`` ends the query once they
    are in. A batch may be delivered twice after a failure; the keyed upsert makes that harmless.
    Without ``partition_by`` each batch rewrites the snapshot, so leave ``max_files`` unset unless one
    run's files are too many for one pass.
    """
    batches = 0

    def apply(batch: DataFrame, batch_id: int) -> None:
        nonlocal batches
        own = batch.sparkSession  # a batch lives in the query's clone of the session
        fresh = stage(batch, "batch")  # read several times below
        mark = high_mark(fresh, latest[0], read_mark(own, root, table))
        upsert_rows(own, fresh, root, table, pk, latest, mark, partition_by)
        batches += 1

    reader = spark.readStream.schema(schema).format(file_format)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    query = (
        reader.load(source)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return batches
