"""Whole texts reach Python in bounded batches."""

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tierline.llm import batches, packing, simhash


@pytest.fixture
def unset(spark):
    before = spark.conf.get(batches.SETTING)
    spark.conf.unset(batches.SETTING)
    yield
    spark.conf.set(batches.SETTING, before)


def sizes(rows):
    def count(found):
        for batch in found:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    return [r.n for r in rows.mapInArrow(count, "n long").collect()]


@pytest.mark.parametrize("through", ["prints", "pack"])
def test_a_task_of_many_texts(spark, unset, through):
    docs = spark.range(0, 3500, 1, 1).select(F.col("id").alias("doc_id"), F.concat(F.lit("some words "), "id").alias("text"))
    assert max(sizes(docs)) == 3500
    if through == "prints":
        found = simhash.fingerprints(docs).collect()
    else:
        found = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).collect()
    assert sorted(r.doc_id for r in found) == list(range(3500))
    assert max(sizes(docs)) <= batches.ROWS and sum(sizes(docs)) == 3500


def test_a_smaller_setting_stays(spark, unset):
    spark.conf.set(batches.SETTING, "300")
    simhash.fingerprints(spark.createDataFrame([(1, "a b c d")], "doc_id long, text string")).collect()
    assert spark.conf.get(batches.SETTING) == "300"
