"""Mixing against SQL, a plain apportionment, and its own promises."""

import math
from collections import Counter, defaultdict

import compare
import pytest

from tierline.llm import mixing
from tierline.llm.queries import ORACLES, QUERIES

SCHEMA = "doc_id long, text string, source string, target string, size int"


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_matches_sql(spark, sf):
    folder = f"/root/testdata/{sf}"
    found = QUERIES["op4_mixing"](spark, folder)
    assert compare.differences(found, compare.duck(folder), ORACLES["op4_mixing"]) == []


def words(n):
    return " ".join(f"w{i}" for i in range(n))


DOCS = (
    [(i, words(10 + i % 50), f"s{i % 7}", "t", 1) for i in range(400)]
    + [(1000 + i, words(30), "hot", None, None) for i in range(300)]
    + [(None, words(40), None, None, 1), (None, None, None, None, 2), (5, "", "none", None, 2), (6, words(3), "\U0001d518", None, 2)]
)


def level_targets(sizes):
    """Reshare by weight until no source is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    left, goal, free = 1.5 * sum(sizes.values()), {}, set(order)
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] >= 2 * sizes[s]}
        if not over:
            return goal | share
        for s in over:
            goal[s] = 2.0 * sizes[s]
            left -= goal[s]
        free -= over
    return goal


def highest_quotients(goal, order, seats):
    won = Counter()
    for _ in range(seats):
        won[min((s for s in order if goal[s] > 0), key=lambda s: (-goal[s] / (2 * won[s] + 1), order.index(s)))] += 1
    return won


def test_against_plain_apportionment(spark):
    docs = spark.createDataFrame(DOCS, SCHEMA)
    rows = mixing.mixed(docs).collect()
    sizes = defaultdict(int)
    for d in DOCS:
        sizes[d[2]] += len((d[1] or "").split())
    goal = level_targets(sizes)
    order = sorted(sizes, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    taken = defaultdict(int)
    for r in rows:
        assert abs(r.target - goal[r.source]) < 1e-6 and r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    block = max(1, min(mixing.BLOCK_WORDS, math.floor(min(g for g in goal.values() if g > 0))))
    assert {r.block_words for r in rows} == {block}
    seats = round(sum(goal.values()) / block)
    for j in range(1, mixing.SHARDS + 1):
        won = highest_quotients(goal, order, seats * j // mixing.SHARDS)
        assert all(r.quotas[j - 1] == won[r.source] for r in rows)
    for s in sizes:
        assert taken[s] == min(2 * sizes[s], won[s] * block)
        assert abs(taken[s] - goal[s]) <= block
    for r in rows:
        assert sum(p.words for p in r.parts) == r.taken
        assert all(0 <= p.first_block - (r.quotas[p.shard - 1] if p.shard else 0) <= p.last_block < r.quotas[p.shard] for p in r.parts)


@pytest.mark.parametrize("sizes", [[16, 900], [20 + i for i in range(40)], [13], [1, 1, 5000], [3, 0, 2]])
def test_sources_below_a_block(spark, sizes):
    docs = spark.createDataFrame([(i, words(n), f"s{i:02}", "t", 1) for i, n in enumerate(sizes)], SCHEMA)
    rows = {r.source: r for r in mixing.mixed(docs).collect()}
    assert all(abs(r.taken - r.target) <= r.block_words <= max(1, r.target) or r.target == 0 for r in rows.values())
    assert all(r.taken > 0 for r in rows.values() if r.target >= 1)
    assert mixing.mix(docs).count() >= sum(n > 0 for n in sizes)


def test_many_sources(spark):
    goals = spark.range(20_000).selectExpr("concat('s', id) AS source", "id AS nth", "1000 + id AS source_size", "1500.0D + id % 977 AS target")
    rows = mixing.quotas(goals).collect()
    block, seats = 64, round(sum(r.target for r in rows) / 64)
    border = sorted((r.target / (2 * i + 1) for r in rows for i in range(60)), reverse=True)[seats - 1]
    for r in rows:
        assert r.block_words == block and (r.target / (2 * r.quotas[-1] - 1) >= border >= r.target / (2 * r.quotas[-1] + 1))
    assert sum(r.quotas[-1] for r in rows) == seats


def test_mix_rows(spark):
    docs = spark.createDataFrame(DOCS, SCHEMA)
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    got = Counter()
    for r in out.collect():
        got[r.source] += len(r.text.split())
    want = Counter()
    for r in mixing.mixed(docs).collect():
        want[r.source] += r.taken
    assert +got == +want
    assert Counter(out.collect()) == Counter(mixing.mix(docs.repartition(3)).collect())


def test_cut_keeps_white_space(spark):
    text = "\n a  b\tc\n\nd "
    row = spark.range(1).selectExpr(f"'{text}' AS t")
    assert row.select(mixing._first_words(row.t, mixing.F.lit(3))).first()[0] == "\n a  b\tc"


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mixed(empty).count() == 0 and mixing.mix(empty).count() == 0
    blank = spark.createDataFrame([(1, None, None, None, 1), (1, None, None, None, 1)], SCHEMA)
    assert [r.taken for r in mixing.mixed(blank).collect()] == [0, 0] and mixing.mix(blank).count() == 0
