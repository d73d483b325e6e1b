"""Exact top-k search by inner product, with a pivot table.

Vectors are scaled to integers. A bounded sample gives the pivots, and every vector's distances to all
of them are computed once. For a query q and a candidate c no pivot p lets |d(q,p) - d(c,p)| exceed
d(q,c), so the greatest such difference is a lower bound on their distance, and with
q.c = (|q|^2 + |c|^2 - d(q,c)^2) / 2 an upper bound on their score. Candidates are scored in the order
of that bound until it falls below the k-th best score found; what follows cannot enter the result.

Vectors lie in blocks by their nearest pivot and its distance, queries in chunks alike. Each query is
first answered in its own block, which gives it a score to beat. The ranges of pivot distances then rule
out whole pairs of chunk and block before anything is sent there; the rest is searched pair by pair. A task
holds one chunk and one block of bounded size. No candidate is left out other than by its bound.

A vector that is null, or holds null or non-finite components (also once scaled), takes no part, nor
does one whose squared length exceeds 2^62: the scores of all others fit a long. Vectors of different
lengths have no score. Rows are told apart by themselves: a query that repeats is answered as often as
it occurs, and rows that share its id are candidates, those without an id the last of equal scores. An
empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.places import placed
from tierline.operators.joins import broadcast_if
from tierline.session import stage

SCALE = 256
TOP = 5
PIVOTS = 24
SAMPLE_ROWS = 2048  # rows, of the most common length, that pivots are chosen from
BLOCK = 4096  # candidates compared together
CHUNK = 1024  # queries compared together
MET = 2048  # chunks, and blocks, whose ranges are compared together
FIRST_STEP = 64  # candidates scored before the bound is first looked at again; doubled each time
NO_ID = np.iinfo(np.int64).max


def scaled(vector: Column, scale: int = SCALE) -> Column:
    """The integer components of a vector; null where it takes no part."""
    values = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).try_cast("int"))
    real = F.transform(vector, lambda x: x.cast("double") * scale)
    sound = F.forall(real, lambda x: x.isNotNull() & (F.abs(x) < 2.0**31 - 1))
    norm = F.aggregate(values, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return F.when(sound & (norm <= 2.0**62), values)


def choose_pivots(vectors: np.ndarray, count: int) -> np.ndarray:
    """Farthest-first: each pivot is the vector farthest from those before it."""
    if not len(vectors):
        return vectors
    chosen, away = [0], np.full(len(vectors), np.inf)
    while len(chosen) < min(count, len(vectors)):
        away = np.minimum(away, ((vectors - vectors[chosen[-1]]) ** 2).sum(axis=1))
        if away.max() == 0:
            break
        chosen.append(int(away.argmax()))
    return vectors[chosen]


def distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    if not len(pivots):
        return np.zeros((len(vectors), 0))
    return np.stack([np.sqrt(((vectors - p) ** 2).sum(axis=1)) for p in pivots], axis=1)


def bounds(dq: np.ndarray, nq: float, dc: np.ndarray, nc: np.ndarray) -> np.ndarray:
    """Upper bounds on the scores of one query with candidates, from pivot distances and squared
    lengths; rounding only raises them."""
    apart = (np.abs(dc - dq) - 1e-12 * (dc + dq)).max(axis=1, initial=0.0)
    return (nc + nq - apart * apart) * 0.5 + 1e-12 * (nc + nq) + 0.5


def products(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors; by way of doubles where all sums are exact there."""
    most = float(np.abs(one).max(initial=0)) * float(np.abs(many).max(initial=0)) * max(1, many.shape[1])
    if most < 2.0**53:
        return (many.astype(np.float64) @ one.astype(np.float64)).astype(np.int64)
    return many @ one


def best(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best by score, then id, then row."""
    return np.lexsort((rows, ids, -scores))[:k]


def search(query: dict, block: dict, k: int, floor: int | None, own: int | None) -> tuple[np.ndarray, int]:
    """(positions in ``block`` of the k best candidates of ``query`` that reach ``floor``, how many were
    scored). ``own`` is the row of the query, which is no candidate of itself."""
    upper = bounds(query["dist"], query["norm"], block["dist"], block["norm"])
    able = np.flatnonzero(upper >= floor) if floor is not None else np.arange(len(upper))
    if own is not None:
        able = able[block["row"][able] != own]
    order = able[np.argsort(-upper[able], kind="stable")]
    found, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, step = 0, FIRST_STEP
    while at < len(order):
        if len(found) == k and upper[order[at]] < scores.min():
            break
        fresh = order[at : at + step]
        at, step = at + len(fresh), 2 * step
        gained = products(query["vector"], block["vector"][fresh])
        both, worth = np.concatenate([found, fresh]), np.concatenate([scores, gained])
        keep = best(worth, block["id"][both], block["row"][both], k)
        found, scores = both[keep], worth[keep]
    return found, at


def _arrays(table: pa.Table) -> dict:
    def matrix(name: str) -> np.ndarray:
        column = table.column(name).combine_chunks()
        flat = column.flatten().to_numpy(zero_copy_only=False)
        return flat.reshape(table.num_rows, len(flat) // max(1, table.num_rows))

    vector = matrix("vector").astype(np.int64)
    return {
        "row": table.column("row").to_numpy(),
        "id": table.column("id").fill_null(NO_ID).to_numpy(),
        "vector": vector,
        "dist": matrix("dist"),
        "norm": (vector.astype(np.float64) ** 2).sum(axis=1),
    }


FOUND = "query long, q_row long, c_id long, c_row long, score long"


def _found(queries: dict, block: dict, k: int, floors: np.ndarray | None) -> pa.Table:
    out = [[], [], [], [], []]
    for i in range(len(queries["row"])):
        query = {name: queries[name][i] for name in ("vector", "dist", "norm")}
        at, _ = search(query, block, k, None if floors is None else int(floors[i]), int(queries["row"][i]))
        out[0].append(np.full(len(at), queries["id"][i]))
        out[1].append(np.full(len(at), queries["row"][i]))
        out[2].append(block["id"][at])
        out[3].append(block["row"][at])
        out[4].append(products(query["vector"], block["vector"][at]))
    names = [part.split()[0] for part in FOUND.split(", ")]
    return pa.table({n: np.concatenate([np.zeros(0, np.int64), *v]).astype(np.int64) for n, v in zip(names, out)})


def pivot_table(vectors: DataFrame, pivots: int = PIVOTS) -> DataFrame:
    """``vectors`` (row, id, asked, vector) with ``dim``, their length as a string, ``dist``, the distances
    to the pivots, ``near``, the nearest pivot, and ``reach``, the distance to that.

    The pivots are chosen on the driver from SAMPLE_ROWS rows of the most common length; vectors of
    another length have no distances.
    """
    common = vectors.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    sample = []
    if common:
        picked = vectors.filter(F.size("vector") == common.dim).orderBy(F.xxhash64("row"), "row").limit(SAMPLE_ROWS)
        sample = [r.vector for r in picked.select("vector").collect()]
    chosen = choose_pivots(np.array(sample, np.float64).reshape(len(sample), -1 if sample else 0), pivots)
    schema = T.StructType(
        [*vectors.schema.fields, T.StructField("dim", T.StringType()), T.StructField("dist", T.ArrayType(T.DoubleType())),
         T.StructField("near", T.IntegerType()), T.StructField("reach", T.DoubleType())]
    )

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 4096):
                batch = whole.slice(first, 4096)
                rows = batch.column("vector").to_pylist()
                dims = np.array([len(v) for v in rows])
                fits = np.flatnonzero(dims == chosen.shape[1]) if len(chosen) else np.zeros(0, np.int64)
                dist = [[] for _ in rows]
                near, reach = np.zeros(len(rows), np.int32), np.zeros(len(rows))
                if len(fits):
                    to = distances(np.array([rows[i] for i in fits], np.float64), chosen)
                    near[fits], reach[fits] = to.argmin(axis=1), to.min(axis=1)
                    for i, d in zip(fits, to):
                        dist[i] = d
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array([str(d) for d in dims], pa.string()), pa.array(dist, pa.list_(pa.float64())),
                     pa.array(near), pa.array(reach)],
                    names=schema.names,
                )

    return vectors.mapInArrow(measured, schema)


def _dealt(table: DataFrame, size: int, name: str) -> DataFrame:
    """``table`` with its rows of one length dealt to runs of ``size`` neighbours by nearest pivot."""
    rows = placed(table.withColumn("tree", F.col("dim")), ["near", "reach"])
    return stage(rows.withColumn(name, F.floor(F.col("place") / size).cast("bigint")).drop("tree", "place", "n"), name)


def _ranges(of: DataFrame, by: list[str], prefix: str, *more: Column) -> DataFrame:
    """The least and greatest distance to each pivot, the greatest squared length, of each group."""
    ends = of.select(*by, F.posexplode("dist").alias("p", "d")).groupBy(*by, "p").agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    listed = ends.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("p", "lo", "hi"))).alias(f"{prefix}_ends"))
    norm = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    sizes = of.groupBy(*by).agg(F.max(norm).alias(f"{prefix}_norm"), *more)
    return sizes.join(listed, by, "left")


def _may_meet() -> Column:
    """Whether a chunk's best possible score in a block reaches the least score its queries must beat."""
    gaps = F.zip_with("q_ends", "c_ends", lambda q, c: F.greatest(q["lo"] - c["hi"], c["lo"] - q["hi"]) - 1e-12 * (q["hi"] + c["hi"]))
    apart = F.greatest(F.coalesce(F.array_max(gaps), F.lit(0.0)), F.lit(0.0))
    lengths = F.col("q_norm") + F.col("c_norm")
    reach = (lengths - apart * apart) / 2 + 1e-12 * lengths + 0.5
    return F.col("floor").isNull() | (reach >= F.col("floor"))


def _pairs(queries: DataFrame, table: DataFrame) -> DataFrame:
    """(dim, chunk, block) where a chunk's queries may have candidates; both sides' ranges are compared
    in squares of MET by MET, so neither is broadcast or gathered."""
    least = F.when(F.count("floor") == F.count(F.lit(1)), F.min("floor")).alias("floor")
    chunks = stage(_ranges(queries, ["dim", "chunk"], "q", least), "chunks")
    blocks = stage(_ranges(table, ["dim", "block"], "c"), "blocks")
    wide = (chunks.agg(F.max("chunk")).first()[0] or 0) // MET + 1
    high = (blocks.agg(F.max("block")).first()[0] or 0) // MET + 1
    chunks = chunks.withColumn("x", F.floor(F.col("chunk") / MET)).withColumn("y", F.explode(F.sequence(F.lit(0), F.lit(high - 1))))
    blocks = blocks.withColumn("y", F.floor(F.col("block") / MET)).withColumn("x", F.explode(F.sequence(F.lit(0), F.lit(wide - 1))))
    met = chunks.join(blocks.withColumn("x", F.col("x").cast("long")), ["dim", "x", "y"]).filter(_may_meet())
    return stage(met.select("dim", "chunk", "block"), "pairs")


def top_k(
    vectors: DataFrame, asked: Column, k: int = TOP, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE,
    pivots: int = PIVOTS,
) -> DataFrame:
    """(query_id, rank, key, score): the k best candidates of each row for which ``asked`` holds.

    Ties go to the smaller key. Every other row is a candidate.
    """
    rows = vectors.select(
        F.col(key).cast("long").alias("id"), F.coalesce(asked, F.lit(False)).alias("asked"), scaled(F.col(vector), scale).alias("vector")
    )
    rows = rows.filter("vector is not null").withColumn("row", F.monotonically_increasing_id())
    measured = stage(pivot_table(stage(rows.select("row", "id", "asked", "vector"), "vectors"), pivots), "pivot-table")
    table = _dealt(measured, BLOCK, "block")

    def at_home(group: pa.Table) -> pa.Table:
        return _found(_arrays(group.filter(group.column("asked"))), _arrays(group), k, None)

    homes = table.filter("asked").select("dim", "block").distinct()
    home = stage(table.join(homes, ["dim", "block"], "left_semi").groupBy("dim", "block").applyInArrow(at_home, FOUND), "home")
    kth = home.groupBy("q_row").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("floor"))
    kth = kth.select(F.col("q_row").alias("row"), F.when(F.col("n") >= k, F.col("floor")).alias("floor"))
    queries = _dealt(table.filter("asked").withColumnRenamed("block", "home").join(kth, "row", "left"), CHUNK, "chunk")
    pairs = _pairs(queries, table)
    small = broadcast_if(pairs, 64 * pairs.count())
    names = ["dim", "chunk", "block"]
    left = queries.join(small, ["dim", "chunk"]).filter("home <> block")
    right = table.join(small, ["dim", "block"])

    def met(ours: pa.Table, theirs: pa.Table) -> pa.Table:
        if not ours.num_rows or not theirs.num_rows:
            return _found({"row": []}, {}, k, None)
        floors = ours.column("floor").fill_null(np.iinfo(np.int64).min).to_numpy()
        return _found(_arrays(ours), _arrays(theirs), k, floors)

    away = left.groupBy(*names).cogroup(right.groupBy(*names)).applyInArrow(met, FOUND)
    every = home.unionByName(away)
    order = Window.partitionBy("q_row").orderBy(F.desc("score"), "c_id", "c_row")
    ranked = every.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    def back(column: str) -> Column:
        return F.when(F.col(column) != NO_ID, F.col(column))

    return ranked.select(back("query").alias("query_id"), "rank", back("c_id").alias(key), "score")


def oracle(asked: str, k: int = TOP, scale: int = SCALE) -> str:
    """DuckDB SQL: all scores of the queries, ranked."""
    return f"""
WITH scaled AS (
  SELECT vec_id, coalesce({asked}, FALSE) AS asked, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v, row_number() OVER () AS nth
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)
SELECT query_id, rank, vec_id, score FROM (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score,
    CAST(row_number() OVER (PARTITION BY q.nth ORDER BY
      list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) DESC, c.vec_id) AS INTEGER) AS rank
  FROM scaled q JOIN scaled c ON q.nth <> c.nth AND len(q.v) = len(c.v) WHERE q.asked
) WHERE rank <= {k}
"""
