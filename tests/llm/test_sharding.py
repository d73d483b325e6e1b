"""Sharding against what a permutation must satisfy."""

import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tierline.llm import sharding

SCHEMA = "doc_id long, text string, shard string, number int"


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_permutes(spark, n):
    got = [r[0] for r in spark.range(n).select(sharding.permuted(F.col("id"), n, 3)).collect()]
    assert sorted(got) == list(range(n))
    if n > 100:
        assert got != list(range(n))
        again = [r[0] for r in spark.range(n).select(sharding.permuted(F.col("id"), n, 4)).collect()]
        assert again != got


def check(docs, rows, shards):
    want = Counter((d.doc_id, len((d.text or "").encode()) + 16, zlib.crc32((d.text or "").encode())) for d in docs)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots.get(i, [])) for i in range(shards)]
    assert max(sizes) - min(sizes) <= 1


def test_edge_rows(spark):
    docs = spark.createDataFrame(
        [(None, None, "x", 1), (None, None, "x", 1), (1, "", "x", 1), (2, "é" * 5000, None, 2), (2, "é" * 5000, None, 3)]
        + [(7, "same", None, 0)] * 50, SCHEMA,
    )
    check(docs.collect(), sharding.assigned(docs, 7).collect(), 7)
    assert sharding.assigned(docs.limit(0), 7).count() == 0


def test_reruns_and_layouts_agree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sharding.assigned(docs, 40).collect()
    check(docs.collect(), rows, 40)
    assert sorted(rows) == sorted(sharding.assigned(docs.repartition(5), 40).collect())


def test_written_shards(spark, tmp_path):
    docs = spark.createDataFrame([(i % 5, f"t{i % 3}", "", 0) for i in range(30)], SCHEMA)
    path = sharding.write_shards(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(path)
    assert Counter((r.doc_id, r.text) for r in back.collect()) == Counter((r.doc_id, r.text) for r in docs.collect())
    assert sorted(r["count"] for r in back.groupBy("shard").count().collect()) == [7, 7, 8, 8]


def test_shards_of_many_files_keep_their_slots(spark, tmp_path):
    rows = [(i, f"text {i} " * (i % 9), "", 0) for i in range(3000)] + [(None, "again", "", 0)] * 900 + [(4, None, None, None)] * 3
    docs = spark.createDataFrame(rows, SCHEMA)
    path = sharding.write_shards(docs, str(tmp_path / "out"), 3, file_bytes=8000)
    back = spark.read.parquet(path).select("*", F.input_file_name().alias("file")).collect()
    assert Counter((r.doc_id, r.text) for r in back) == Counter(r[:2] for r in rows)
    place = {r.doc_id: (r.shard, r.slot) for r in sharding.assigned(docs, 3).collect()}
    files = {}
    for r in back:
        files.setdefault((r.shard, r.file), []).append(r)
    for (shard, _), held in files.items():
        known = [place[r.doc_id] for r in held if r.doc_id is not None and r.text is not None and r.doc_id != 4]
        assert all(s == shard for s, _ in known) and [t for _, t in known] == sorted(t for _, t in known)
    assert min(Counter(s for s, _ in files).values()) > 3
    none = sharding.write_shards(docs.limit(0), str(tmp_path / "none"), 3)
    assert not spark.read.schema(SCHEMA).parquet(none).count()


def test_numbers_of_many_copies(spark, monkeypatch):
    monkeypatch.setattr(sharding, "COPIES", 7)
    rows = spark.range(500).selectExpr("id % 2 AS a")
    assert sorted(r.number for r in sharding.numbered(rows).collect()) == list(range(500))


def feistel(number, n, seed, hashed):
    """The permutation in plain Python, with the round function's values looked up."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    b = max(1, -(-n // a))
    x = number
    while True:
        for r in range(1, sharding.ROUNDS + 1):
            left, right = divmod(x, b)
            left = (left + hashed[seed, 0, r, right] % a) % a
            right = (right + hashed[seed, 1, r, left] % b) % b
            x = left * b + right
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 2, 7, 50, 333])
def test_places_equal_the_walk_in_plain_python(spark, n):
    seed, shards = 11, 4
    wide = math.isqrt(n) + 2
    keys = spark.range(wide).selectExpr("id AS half").crossJoin(spark.range(2).selectExpr("cast(id as int) AS side"))
    keys = keys.select("*", F.explode(F.sequence(F.lit(1), F.lit(sharding.ROUNDS))).alias("r"))
    values = keys.withColumn("h", F.xxhash64(F.lit(seed).cast("bigint"), "side", "r", "half"))
    hashed = {(seed, v.side, v.r, v.half): v.h for v in values.collect()}
    got = spark.range(n).select("id", sharding.placed(F.col("id"), n, shards, seed).alias("p")).collect()
    for row in got:
        walked = feistel(row.id, n, seed, hashed)
        assert (row.p.shard, row.p.slot) == (walked % shards, walked // shards)
