"""Embedding near-duplicates against brute force over all pairs."""

import math

import compare
import numpy as np
import pytest

from tierline.llm import embeddings

SCHEMA = "vec_id long, embedding array<float>, label int, n long, where string"


def brute(rows, threshold=0.98):
    def usable(r):
        v = r[1]
        return r[0] is not None and r[2] is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)

    good = [r for r in rows if usable(r)]
    links, parent = {r[0]: 0 for r in rows}, {r[0]: r[0] for r in rows}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    vectors = [np.array(r[1], np.float32).astype(np.float64) for r in good]
    for i, a in enumerate(good):
        for j in range(i + 1, len(good)):
            b = good[j]
            if a[2] == b[2] and len(vectors[i]) == len(vectors[j]):
                if vectors[i] @ vectors[j] / (np.linalg.norm(vectors[i]) * np.linalg.norm(vectors[j])) >= threshold:
                    links[a[0]] += 1
                    links[b[0]] += 1
                    x, y = root(a[0]), root(b[0])
                    parent[max(x, y)] = min(x, y)
    return {k: (links[k], root(k), root(k) == k) for k in links}


def check(found, rows):
    want = brute(rows)
    assert len(found) == len(rows)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found} == want


def test_codes_find_close_pairs():
    rng = np.random.default_rng(5)
    a, z = rng.normal(size=(2, 3000, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    z -= (z * a).sum(1)[:, None] * a
    b = 0.98 * a + math.sqrt(1 - 0.98**2) * z / np.linalg.norm(z, axis=1)[:, None]
    for hashes, tables in embeddings.TABLES.items():
        x, y = embeddings.codes(a, tables, hashes), embeddings.codes(b, tables, hashes)
        met = ((x == y[:, :, :1]).any(2) | (y == x[:, :, :1]).any(2)).any(1)
        assert met.mean() > 0.999, hashes


def test_hadamard_is_a_rotation():
    x = np.random.default_rng(1).normal(size=(10, 16))
    assert np.allclose(np.linalg.norm(embeddings.hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    assert np.allclose(embeddings.hadamard(embeddings.hadamard(x)), x)


@pytest.mark.parametrize("tile,small", [(2048, 24), (16, 4)])
def test_clusters(spark, monkeypatch, tile, small):
    monkeypatch.setattr(embeddings, "TILE", tile)
    monkeypatch.setattr(embeddings, "SMALL", small)
    rng = np.random.default_rng(2)
    rows = []
    for c in range(12):
        centre = rng.normal(size=32)
        for k in range(15):
            rows.append((len(rows), (centre * (1 + k % 3) + rng.normal(size=32) * 0.11 * (k % 5)).tolist(), c % 3, 0, ""))
    rows += [(1000 + k, rows[0][1], 0, 1, "") for k in range(60)]
    check(embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect(), rows)


def test_more_hashes(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "ROWS_BY_HASHES", (10, 1 << 40))
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    wide = table.selectExpr("vec_id", "cast(embedding as array<double>) AS embedding", "label")
    check(embeddings.near_duplicates(wide).collect(), [tuple(r) for r in table.collect()])


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    v = [1.0, 2.0, 3.0]
    rows = [
        (1, v, 1), (2, v, 1), (3, [2.0, 4.0, 6.0], 1), (4, v, 2), (5, v, None), (6, None, 1), (7, [0.0] * 3, 1), (8, [nan, 1.0, 2.0], 1),
        (9, [inf, 1.0, 2.0], 1), (10, [None, 1.0, 2.0], 1), (11, [1.0, 2.0], 1), (12, [5.0], 1), (13, [6.0], 1), (14, [], 1), (15, [-1.0, -2.0, -3.0], 1),
    ]
    rows = [(*r, 0, "x") for r in rows]
    docs = spark.createDataFrame(rows, SCHEMA)
    check(embeddings.near_duplicates(docs).collect(), rows)
    nulls = embeddings.near_duplicates(spark.createDataFrame([(None, v, 1, 0, "")] * 2, SCHEMA)).collect()
    assert [(r.n_links, r.component_id, r.kept) for r in nulls] == [(0, None, True)] * 2
    assert embeddings.near_duplicates(docs.limit(0)).count() == 0


def test_real_vectors(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    check(embeddings.near_duplicates(table).collect(), [tuple(r) for r in table.collect()])


def test_matches_sql(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    assert compare.differences(embeddings.near_duplicates(table), compare.duck("/root/testdata/sf0.01"), embeddings.ORACLE) == []
