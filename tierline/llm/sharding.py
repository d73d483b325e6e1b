"""Sharding by a keyed permutation of global row numbers.

Rows are numbered 0..n-1 in an order that depends on their values alone. A Feistel network over a
domain barely larger than n, walked until it lands below n, permutes the numbers, so the shard and
slot of any row number follow from (seed, n, shards) by arithmetic: no sort, no stored mapping. Shards
hold counts at most one apart and slots are gapless.

A null text counts as empty and a null id is a value like any other; rows equal in id, size and
checksum are interchangeable and get distinct places; an empty table gives an empty one. Equal texts
under different ids are different rows and are spread like all others.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.exprs import let, whole
from tierline.operators.joins import null_safe_join
from tierline.session import stage

ROUNDS = 4  # double rounds
WALK = 64  # steps of the walk; see ``permuted``
BUCKET_ROWS = 1_000_000
SALTS = 64
COPIES = 1 << 16  # numbers of a repeated row that are listed at a time
FILE_BYTES = 1 << 28
MOST_PIECES = 1 << 16
_UP_TO = (Window.unboundedPreceding, Window.currentRow)


def permuted(number: Column, n: int, seed: int) -> Column:
    """A bijection of 0..n-1, keyed by ``seed``.

    The domain is a x b with a = ceil(sqrt(n)) and b = ceil(n / a): fewer than a of its points lie
    beyond n. The walk visits points beyond n at most once each, so WALK steps always suffice while
    a*b - n <= WALK; past that n exceeds 4096, fewer than one step in 64 goes on, and a row that were
    still beyond n after all of them fails the job instead of taking a wrong place.
    """
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    b = max(1, -(-n // a))

    def scrambled(round_: Column, half: Column, side: int, size: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed).cast("bigint"), F.lit(side), round_, half), F.lit(size))

    def double_round(x: Column, round_: Column) -> Column:
        left, right = F.floor(x / b).cast("bigint"), F.pmod(x, F.lit(b))
        turned = (left + scrambled(round_, right, 0, a)) % a
        return let(turned, lambda t: t * b + (right + scrambled(round_, t, 1, b)) % b)

    def network(x: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x, double_round)

    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(min(WALK, a * b - n))) if a * b > n else F.array().cast("array<int>"),
        network(number),
        lambda x, _: F.when(x < n, x).otherwise(network(x)),
    )
    return let(walked, lambda x: F.when(x < n, x).otherwise(F.raise_error(F.lit("walk left the domain")).cast("bigint")))


def placed(number: Column, n: int, shards: int, seed: int) -> Column:
    """struct(shard, slot) of a row number."""
    return let(permuted(number, n, seed), lambda p: F.struct(
        (p % shards).cast("int").alias("shard"), F.floor(p / shards).cast("bigint").alias("slot")
    ))


def numbered(rows: DataFrame, name: str = "number") -> DataFrame:
    """A narrow table with a global row number 0..n-1, ascending by bucket and then by all columns.

    Only counts cross between buckets: one row per bucket. Equal rows are counted before they move and
    spread again afterwards, so a row repeated without bound sits in no single task. ``rows`` is read
    more than once: give a stored table.
    """
    keys = rows.columns
    n = rows.count()
    buckets = max(256, math.ceil(n / BUCKET_ROWS))
    salted = rows.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    groups = salted.groupBy(*keys, "__salt").agg(F.count(F.lit(1)).alias("__n"))
    groups = groups.withColumn("__bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    inside = Window.partitionBy("__bucket").orderBy(*keys, "__salt")
    run = groups.withColumn("__end", F.sum("__n").over(inside.rowsBetween(*_UP_TO)))
    totals = rows.groupBy(F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("__bucket")).agg(
        F.count(F.lit(1)).alias("__rows")
    )
    before = totals.select(
        "__bucket", (F.sum("__rows").over(Window.orderBy("__bucket").rowsBetween(*_UP_TO)) - F.col("__rows")).alias("__before")
    )
    ends = run.join(before, "__bucket").withColumn("__end", F.col("__end") + F.col("__before"))
    spread = ends.repartition(*keys, "__salt")
    first, step = F.col("__end") - F.col("__n"), F.lit(COPIES).cast("bigint")
    runs = spread.select(*keys, "__end", F.explode(F.sequence(first, F.col("__end") - 1, step)).alias("__from"))
    upto = F.least(F.col("__from") + step, F.col("__end")) - 1
    return runs.select(*keys, F.explode(F.sequence("__from", upto)).alias(name))


def described(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32) of each row: UTF-8 bytes plus 16, and their CRC-32."""
    body = whole(F.col(text))
    return docs.select(
        key, (F.octet_length(body) + 16).cast("bigint").alias("size"), F.crc32(F.encode(body, "UTF-8")).alias("text_crc32")
    )


def assigned(docs: DataFrame, shards: int, seed: int = 11, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, number, shard, slot) for each row of ``docs``."""
    rows = stage(described(docs, key, text), "sizes")
    n = rows.count()
    found = numbered(rows)
    place = placed(F.col("number"), n, shards, seed) if n else F.struct(F.lit(0).alias("shard"), F.lit(0).cast("bigint").alias("slot"))
    return found.withColumn("__at", place).select(*rows.columns, "number", "__at.shard", "__at.slot")


def write_shards(
    docs: DataFrame, path: str, shards: int, seed: int = 11, key: str = "doc_id", text: str = "text", file_bytes: int = FILE_BYTES
) -> str:
    """Writes key and text below ``path``, one folder a shard, ascending by slot within each file.

    A shard's slots are cut into even runs of about ``file_bytes``, so a shard of any size is written by
    many tasks; only a file may hold several runs, one after another, never a run several files. Rows meet
    their places by key, size and checksum. Rows equal in all three have neighbouring numbers, so each
    different text takes a range of them, in the order of the text's digest, and no task gathers the copies.
    """
    same = [key, "size", "text_crc32"]
    body = whole(F.col(text))
    own = docs.select(
        key, F.col(text).alias("text"),
        (F.octet_length(body) + 16).cast("bigint").alias("size"), F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
    )
    slots = stage(assigned(docs, shards, seed, key, text), "places")
    n, total = slots.agg(F.count(F.lit(1)), F.sum("size")).first()
    rows_each = max(1, n * file_bytes // max(total or 0, 1))
    pieces = min(MOST_PIECES, max(1, shards * -(-n // (shards * rows_each))))
    counted = own.groupBy(*same, "text").agg(F.count(F.lit(1)).alias("n"))
    end = F.sum("n").over(Window.partitionBy(*same).orderBy(F.sha2("text", 256)).rowsBetween(*_UP_TO))
    firsts = slots.groupBy(*same).agg(F.min("number").alias("first"))
    texts = null_safe_join(counted.withColumn("end", end), firsts, same, "inner").alias("d")
    met = [F.col(f"s.{c}").eqNullSafe(F.col(f"d.{c}")) for c in same]
    inside = F.expr("s.number < d.first + d.end and s.number >= d.first + d.end - d.n")
    rows = slots.alias("s").join(texts, [*met, inside]).select(f"d.{key}", "d.text", "s.shard", "s.slot")
    cut = rows.repartition(pieces, "shard", F.floor(F.col("slot") / rows_each))
    cut.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return path
