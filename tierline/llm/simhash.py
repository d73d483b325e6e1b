"""SimHash near-duplicates by tiled exact comparison.

A text's fingerprint sums the bits of its shingles' hashes; two texts are near copies at ``radius`` or
fewer differing bits. Equal fingerprints are one class before anything is compared. The distinct
fingerprints are dealt to tiles by population count; tile pairs whose counts differ by more than the
radius are never formed, the others are compared exactly with numpy (exclusive or, bit counts), again
skipping runs whose half-word counts are too far apart. A tile pair returns spanning links only, at most
one a fingerprint, so a large group of near copies yields few rows.

Null text counts as empty. A text without words has fingerprint 0, one with fewer words than a shingle
is one shingle. Repeated rows get equal results; an empty table gives an empty one; texts may be long.
Keys are longs; a row whose key is null is fingerprinted, counts as larger than all keys and is its own
class's member, never its name unless the class has no other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.batches import bounded, give_back
from tierline.llm.graph import attach, components
from tierline.llm.tiles import Forest
from tierline.session import stage

SHINGLE = 3
SEED = 42
RADIUS = 3
TILE = 1 << 17
LEFT, RIGHT = 128, 4096  # one block of comparisons: 4 MB
HELD = 40_000  # shingle hashes turned to bits at a time


def _hashes(text: str, shingle: int) -> list[int]:
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII letters and spaces only
    digest = xxhash.xxh64_intdigest
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= shingle:
        return [digest(joined, SEED)]
    ends, at = [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    starts = [0, *[e + 1 for e in ends]]
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :])]


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def fingerprints_of(texts: list[str], shingle: int = SHINGLE) -> np.ndarray:
    """One unsigned 64-bit fingerprint a text."""
    out = np.zeros(len(texts), np.uint64)
    weights = np.left_shift(np.uint64(1), np.arange(64, dtype=np.uint64))

    def close(rows: list[int], counts: list[int], held: list[int]) -> None:
        if not rows:
            return
        bits = _bit_counts(np.array(held, np.uint64))
        firsts = np.concatenate([[0], np.cumsum(counts)[:-1]])
        sums = np.add.reduceat(bits, firsts, axis=0, dtype=np.int64)
        out[rows] = ((2 * sums > np.array(counts)[:, None]) * weights).sum(axis=1, dtype=np.uint64)

    rows: list[int] = []
    counts: list[int] = []
    held: list[int] = []
    for row, text in enumerate(texts):
        hashes = _hashes(text, shingle)
        if len(hashes) > HELD:
            every = np.array(hashes, np.uint64)
            sums = sum(_bit_counts(every[i : i + HELD]).sum(axis=0, dtype=np.int64) for i in range(0, len(every), HELD))
            out[row] = ((2 * sums > len(every)) * weights).sum(dtype=np.uint64)
        elif hashes:
            if len(held) + len(hashes) > HELD:
                close(rows, counts, held)
                rows, counts, held = [], [], []
            rows.append(row)
            counts.append(len(hashes))
            held += hashes
    close(rows, counts, held)
    return out


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(key, fp) of each row; fp is the fingerprint's 64 bits as a long."""
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField("fp", T.LongType())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                found = fingerprints_of([t or "" for t in batch.column(1).to_pylist()], shingle)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=schema.names)
            batch = whole = None
        give_back()

    return bounded(docs.select(key, F.col(text).alias("text"))).mapInArrow(hashed, schema)


def linked(left: np.ndarray, right: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of positions (i, j) with at most ``radius`` differing bits, each array of one population.

    Both sides must be ascending by the population of their low half. With populations p and q and low
    halves x and y, the distance is at least |x - y| + |(p - q) - (x - y)|, which bounds the run of
    ``right`` that a block of ``left`` meets.
    """
    low = np.uint64(0xFFFFFFFF)
    p, q = int(np.bitwise_count(left[0])), int(np.bitwise_count(right[0]))
    ours, theirs = np.bitwise_count(left & low).astype(int), np.bitwise_count(right & low).astype(int)
    least, most = -((radius - (p - q)) // 2), (radius + (p - q)) // 2  # of x - y
    for at in range(0, len(left), LEFT):
        block, halves = left[at : at + LEFT], ours[at : at + LEFT]
        begin = np.searchsorted(theirs, halves[0] - most, "left")
        end = np.searchsorted(theirs, halves[-1] - least, "right")
        for to in range(begin, end, RIGHT):
            run = right[to : min(to + RIGHT, end)]
            i, j = np.nonzero(np.bitwise_count(block[:, None] ^ run[None, :]) <= radius)
            if len(i):
                yield i + at, j + to


def _compare(radius: int):
    def compare(table: pa.Table) -> pa.Table:
        fp = table.column("fp").to_numpy().view(np.uint64)
        rep = table.column("rep").to_numpy()
        side = table.column("side").to_numpy()
        order = np.lexsort((np.bitwise_count(fp & np.uint64(0xFFFFFFFF)), side))
        fp, rep, side = fp[order], rep[order], side[order]
        n = int(np.searchsorted(side, 1))
        left, right, shift = fp[:n], (fp[n:] if n < len(fp) else fp), (n if n < len(fp) else 0)
        forest = Forest(len(fp))
        if n:  # a tile without its partner has nothing to be compared with
            own = shift == 0 and table.column("ia")[0].as_py() == table.column("ib")[0].as_py() and table.column("pa")[0].as_py() == table.column("pb")[0].as_py()
            if own or shift:
                for i, j in linked(left, right, radius):
                    forest.link(i, j + shift)
        a, b = forest.edges()
        return pa.table({"a": pa.array(rep[a]), "b": pa.array(rep[b])})

    return compare


def links(classes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Spanning links (a, b) between ``classes`` (fp, rep): distinct fingerprints and their names.

    Reads ``classes`` twice: give a stored table. The counts that come to the driver are one a
    population, 65 at most.
    """
    population = F.bit_count("fp").cast("int")
    counts = dict(classes.groupBy(population.alias("p")).count().collect())
    chunks = F.array(*[F.lit(-(-counts.get(p, 0) // TILE)) for p in range(65)])
    own = classes.select("fp", "rep", population.alias("p"))
    own = own.withColumn("i", F.pmod(F.xxhash64("fp"), F.get(chunks, F.col("p"))).cast("int"))
    around = F.sequence(F.greatest(F.lit(0), F.col("p") - radius), F.least(F.lit(64), F.col("p") + radius))

    def partners(q):
        n = F.get(chunks, q)
        tiles = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

        def pair(j):
            first = (F.col("p") < q) | ((F.col("p") == q) & (F.col("i") <= j))
            return F.struct(
                F.least("p", q).alias("pa"),
                F.when(first, F.col("i")).otherwise(j).alias("ia"),
                F.greatest("p", q).alias("pb"),
                F.when(first, j).otherwise(F.col("i")).alias("ib"),
                F.when(first, 0).otherwise(1).alias("side"),
            )

        return F.transform(tiles, pair)

    met = own.select("fp", "rep", F.explode(F.flatten(F.transform(around, partners))).alias("t"))
    return met.select("fp", "rep", "t.*").groupBy("pa", "ia", "pb", "ib").applyInArrow(_compare(radius), "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """(key, fp, component_id) of each row: the smallest key that links of near copies reach."""
    prints = stage(fingerprints(docs, key, text), "prints")
    classes = stage(prints.groupBy("fp").agg(F.min(key).cast("long").alias("rep"), F.count(F.lit(1)).alias("n")), "classes")
    named = classes.filter("rep is not null")
    found = components(links(named.select("fp", "rep"), radius))
    moved = named.join(found.withColumnRenamed("id", "rep"), "rep").select("fp", "component")
    table = named.join(moved, "fp", "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return attach(prints, table, "fp", classes.select("fp", "n")).select(key, "fp", "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row of ``docs`` for each group of near copies: the one of the smallest key.

    Rows are told apart by key and text, so an id that repeats with different texts loses none of them to
    the group of another; of rows equal in both, one stays. Rows without a key have no place in the order
    and all stay.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    named = docs.select(F.struct(F.col(key).alias("key"), F.md5(F.encode(body, "UTF-8")).alias("mark")).alias("row"), F.col(text).alias("text"))
    prints = stage(fingerprints(named.filter("row.key is not null"), "row", "text"), "prints")
    classes = stage(prints.groupBy("fp").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n")), "classes")
    found = components(links(classes.select("fp", F.col("fp").alias("rep")), radius))
    grouped = classes.join(found.withColumnRenamed("id", "fp"), "fp", "left").withColumn("group", F.coalesce("component", "fp"))
    grouped = stage(grouped.select("fp", "first", "group"), "groups")
    stays = grouped.groupBy("group").agg(F.min("first").alias("stays"))
    table = grouped.join(stays, "group").select("fp", "stays")
    rows = stage(attach(prints, table, "fp", classes.select("fp", "n")), "near")
    dropped = rows.filter("row <> stays").select(F.col("row.key").alias("__key"), F.col("row.mark").alias("__mark")).distinct()
    mark = F.md5(F.encode(body, "UTF-8"))
    left = docs.join(dropped, (F.col(key) == F.col("__key")) & (mark == F.col("__mark")), "left_anti")
    repeated = prints.groupBy("row").count().filter("count > 1")
    if repeated.limit(1).count():
        unnamed = left.filter(F.col(key).isNull())
        single = left.filter(F.col(key).isNotNull()).withColumn("__mark", mark).dropDuplicates([key, "__mark"])
        return single.drop("__mark").unionByName(unnamed)
    return left
