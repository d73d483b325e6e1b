"""SimHash against brute force over all pairs."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tierline.llm import graph, simhash
from tierline.llm.queries import QUERIES


def brute_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius=3):
    parent = {k: k for k in prints}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    keys = sorted(prints)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {k: root(k) for k in keys}


def check(rows, texts):
    prints = {k: brute_fingerprint(t) for k, t in texts.items()}
    want = brute_components(prints)
    assert len(rows) == len(texts)
    for r in rows:
        assert r.fp % 2**64 == prints[r.doc_id] and r.component_id == want[r.doc_id]


def test_real_texts(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    check(simhash.near_duplicates(docs).collect(), texts)
    rows = QUERIES["op8_simhash"](spark, folder).collect()
    prints = {k: brute_fingerprint(t) for k, t in texts.items()}
    assert {r.doc_id: r.fingerprint for r in rows} == {k: f"{v:016x}" for k, v in prints.items()}
    kept = {r.doc_id for r in simhash.keep_one(docs).collect()}
    assert kept == set(brute_components(prints).values())


def test_edges(spark):
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi"
    texts = {1: None, 2: "", 3: " \n", 4: "Word", 5: "WORD", 6: "É a", 7: "é a", 8: "a b c", 9: base, 10: base.upper(),
             11: "long text of words " * 30000, 12: "a\x0bb\x1cc\x85d e f g", 0: base + " rho"}
    rows = [(k, t, "x", "y") for k, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, rep string")
    check(simhash.near_duplicates(docs).collect(), texts)
    assert simhash.keep_one(docs).columns == docs.columns
    twice = docs.unionByName(docs).unionByName(spark.createDataFrame([(None, base, "x", "y")], docs.schema))
    found = simhash.near_duplicates(twice).collect()
    assert len(found) == 27 and {r.component_id for r in found if r.doc_id is None} == {9}
    kept = [r.doc_id for r in simhash.keep_one(twice).collect()]
    assert len(kept) == len(set(kept)) and None in kept
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.keep_one(docs.limit(0)).count() == 0


def test_one_id_two_texts(spark):
    one, two = "alpha beta gamma delta epsilon " * 4, "quite another text of other words entirely " * 3
    rows = [(3, one), (5, one), (5, two), (7, two), (7, two), (9, ""), (9, None), (None, one), (None, one)]
    docs = spark.createDataFrame([(k, t, "en", "s") for k, t in rows], "doc_id long, text string, row string, fp string")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect() if r.doc_id is not None), key=repr)[:2] == [(3, one), (5, two)]
    assert sum(r.doc_id is None for r in kept.collect()) == 2 and kept.count() == 5


@pytest.mark.parametrize("tile", [1 << 17, 40])
def test_tiles_lose_no_link(spark, tile, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", tile)
    monkeypatch.setattr(simhash, "LEFT", 8)
    monkeypatch.setattr(simhash, "RIGHT", 16)
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 2**63, 60)
    prints = []
    for c in centres:
        value = int(c)
        for _ in range(8):  # chains: each a few bits from the one before
            for b in rng.integers(0, 64, rng.integers(0, 5)):
                value ^= 1 << int(b)
            prints.append(value)
    prints = dict(enumerate(dict.fromkeys(prints)))
    rows = [(int(np.uint64(v).astype(np.int64)), k) for k, v in prints.items()]
    classes = spark.createDataFrame(rows, "fp long, rep long")
    found = {r.id: r.component for r in graph.components(simhash.links(classes)).collect()}
    assert {k: found.get(k, k) for k in prints} == brute_components(prints)


def test_components_of_chains_and_hubs(spark):
    pairs = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 700)] + [(7, 7), (3, 900), (900, 500)]
    found = {r.id: r.component for r in graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert all(found[i] == 100 for i in range(100, 161)) and all(found[i] == 3 for i in range(501, 700)) and 7 not in found


def test_attach_hot_keys(spark):
    rows = spark.range(40000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"))
    table = spark.range(0, 40000, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("x")).union(spark.sql("select 1L, 5L"))
    counts = rows.groupBy("k").agg(F.count("*").alias("n"))
    got = graph.attach(rows, table, "k", counts)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, rows.join(table, "k", "left").collect()), key=str)
