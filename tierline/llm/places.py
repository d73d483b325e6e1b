"""Numbers of rows in the order of their groups, without a group in one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.operators.joins import broadcast_if
from tierline.session import stage


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``place``, the number of a row in its ``tree`` in the order given, and ``n``, how
    many the tree has.

    Rows are range-partitioned by (tree, order), so a tree of any size runs on over neighbouring
    partitions; between those only counts move, one a (tree, partition).
    """
    by = ["tree", *order, "__id"]
    pinned = stage(rows.withColumn("__id", F.monotonically_increasing_id()), "leaves")
    ranged = pinned.repartitionByRange(*by).sortWithinPartitions(*[F.asc_nulls_first(c) for c in by]).drop("__id")
    schema = T.StructType([*ranged.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("pos", T.LongType())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, held = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            trees = batch.column("tree").dictionary_encode()
            codes = trees.indices.to_numpy()
            begins = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
            lengths = np.diff(np.append(begins, len(codes)))
            pos = np.arange(len(codes)) - np.repeat(begins, lengths)
            names = trees.dictionary.to_pylist()
            if names[codes[0]] == last:
                pos[: lengths[0]] += held
            last, held = names[codes[-1]], int(pos[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(codes), part, np.int32)), pa.array(pos)], names=schema.names
            )

    found = stage(ranged.mapInArrow(counted, schema), "places")
    counts = found.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("rows"))
    upto = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = stage(
        counts.select(
            "tree",
            "part",
            (F.sum("rows").over(upto) - F.col("rows")).alias("before"),
            F.sum("rows").over(Window.partitionBy("tree")).alias("n"),
        ),
        "counts",
    )
    size = before.agg(F.sum(F.octet_length("tree") + 64)).first()[0] or 0
    joined = found.join(broadcast_if(before, size), ["tree", "part"])
    return joined.withColumn("place", F.col("before") + F.col("pos")).drop("part", "pos", "before")
