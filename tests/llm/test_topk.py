"""Top-k search against SQL and against all scores."""

import math

import compare
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tierline.llm import topk
from tierline.llm.queries import ORACLES, QUERIES

SCHEMA = "vec_id long, embedding array<double>, score string, row int, block string"


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_matches_sql(spark, sf):
    folder = f"/root/testdata/{sf}"
    found = QUERIES["op12_exact_top_k"](spark, folder)
    assert compare.differences(found, compare.duck(folder), ORACLES["op12_exact_top_k"]) == []


def brute(rows, asked, k, scale):
    able = []
    for n, (key, vector) in enumerate(rows):
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            able.append((n, key, [math.floor(scale * x) for x in vector]))
    out = []
    for n, key, v in able:
        if key is None or not asked(key):
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), (c is None, c or 0), m) for m, c, w in able if m != n and len(w) == len(v)]
        for rank, (score, (none, c), _) in enumerate(sorted(scored)[:k], 1):
            out.append((key, rank, None if none else c, -score))
    return sorted(out, key=repr)


def rows_of(seed=5, n=700):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 12))
    rows = [(i, (centres[i % 6] + rng.normal(scale=0.2, size=12)).tolist()) for i in range(n)]
    rows += [(n + i, rows[0][1]) for i in range(60)]  # copies: ties and blocks of equal vectors
    rows += [(0, rows[1][1]), (10, rows[3][1]), (None, rows[0][1]), (None, rows[5][1])]
    rows += [(n + 100 + i, v) for i, v in enumerate([None, [], [0.0] * 12, [math.nan] * 12, [math.inf] * 12, [1.0, None], [1.0, 2.0], [3.0, -1.0]])]
    return rows


@pytest.mark.parametrize("block, chunk, met", [(4096, 1024, 2048), (64, 7, 3), (1, 1, 2048)])
def test_against_all_scores(spark, monkeypatch, block, chunk, met):
    for name, value in (("BLOCK", block), ("CHUNK", chunk), ("MET", met)):
        monkeypatch.setattr(topk, name, value)
    rows = rows_of(n=120 if block == 1 else 700)
    step = 100 if block == 1 else 10
    df = spark.createDataFrame([(k, v, "s", 1, "b") for k, v in rows], SCHEMA).repartition(3)
    found = topk.top_k(df, df.vec_id % step == 0)
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect()]
    assert sorted(got, key=repr) == brute(rows, lambda k: k % step == 0, 5, 256)


def test_empty_few_and_large(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert topk.top_k(empty, empty.vec_id % 2 == 0).count() == 0
    few = spark.createDataFrame([(0, [1.0, 1.0], None, 1, None), (1, [1.0, -0.001], None, 1, None), (2, [1e300, 1.0], None, 1, None)], SCHEMA)
    assert [tuple(r) for r in topk.top_k(few, few.vec_id % 2 == 0).collect()] == [(0, 1, 1, 256 * 256 - 256)]
    wide = [(i, [(-1.0) ** i * 2.0**20 + i, 2.0**21 - i]) for i in range(8)]  # sums beyond what a double holds
    large = spark.createDataFrame([(k, v, None, 1, None) for k, v in wide], SCHEMA)
    got = [tuple(r) for r in topk.top_k(large, large.vec_id % 2 == 0).collect()]
    assert sorted(got, key=repr) == brute(wide, lambda k: k % 2 == 0, 5, 256)


def side(ids, vectors, pivots):
    vectors = np.array(vectors, np.int64)
    norm = (vectors.astype(float) ** 2).sum(axis=1)
    return {"row": np.array(ids), "id": np.array(ids), "vector": vectors, "dist": topk.distances(vectors.astype(float), pivots), "norm": norm}


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 200), st.integers(1, 6), st.integers(0, 4), st.integers(0, 2**32 - 1), st.integers(1, 9))
def test_search_is_exact(n, width, pivots, seed, k):
    rng = np.random.default_rng(seed)
    vectors = rng.integers(-9, 10, (n, width))
    chosen = topk.choose_pivots(vectors.astype(float), pivots) if pivots else np.zeros((0, width))
    block = side(range(n), vectors, chosen)
    query = {name: block[name][0] for name in ("vector", "dist", "norm")}
    at, scored = topk.search(query, block, k, None, 0)
    want = sorted((-int(v @ vectors[0]), i) for i, v in enumerate(vectors) if i)[:k]
    assert [(-int(vectors[i] @ vectors[0]), i) for i in at] == want and scored <= n


def test_bounds_eliminate():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(8, 16)) * 400
    vectors = (centres[np.arange(4000) % 8] + rng.normal(scale=20, size=(4000, 16))).astype(np.int64)
    vectors = (vectors / np.linalg.norm(vectors, axis=1)[:, None] * 256).astype(np.int64)
    block = side(range(4000), vectors, topk.choose_pivots(vectors.astype(float), 24))
    scored = [topk.search({name: block[name][i] for name in ("vector", "dist", "norm")}, block, 5, None, i)[1] for i in range(40)]
    assert np.mean(scored) < 1000
