"""The manifest against SQL and a plain recursive tree."""

import hashlib
import zlib

import compare
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tierline.llm import merkle
from tierline.llm.queries import ORACLES, QUERIES

SCHEMA = "doc_id long, text string, source string, root string, node string"


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_matches_sql(spark, sf):
    folder = f"/root/testdata/{sf}"
    found = QUERIES["op11_merkle_manifest"](spark, folder)
    assert compare.differences(found, compare.duck(folder), ORACLES["op11_merkle_manifest"]) == []


def sha(text):
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def climb(nodes, fan):
    """(top, witness of each node) level by level."""
    where, witness, level = list(range(len(nodes))), [[] for _ in nodes], list(nodes)
    while len(level) > 1:
        for m, at in enumerate(where):
            run = level[at // fan * fan : at // fan * fan + fan]
            witness[m].append(("".join(run[: at % fan]), "".join(run[at % fan + 1 :])))
            where[m] = at // fan
        level = [sha("".join(level[i : i + fan])) for i in range(0, len(level), fan)]
    return level[0], witness


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 70), st.integers(2, 4), st.data())
def test_append_against_levels(n, fan, data):
    nodes = [sha(str(i)) for i in range(n)]
    tree = merkle.Witnesses(fan)
    for node in nodes:
        tree.append(node)
    top, witness = climb(nodes, fan)
    assert tree.close() == top
    assert [list(zip(a, b)) for a, b in zip(tree.left, tree.right)] == witness
    height = data.draw(st.integers(1, 3))  # the tops of aligned blocks appended further up
    span, upper, found = fan**height, merkle.Witnesses(fan), []
    for at in range(0, n, span):
        block, node = merkle._grow(nodes[at : at + span], n, fan, height)
        upper.append(node, height if n > span else 0)
        found += [list(zip(a, b)) for a, b in zip(block.left, block.right)]
    assert upper.close() == top
    assert [f + list(zip(upper.left[m // span], upper.right[m // span])) for m, f in enumerate(found)] == witness


def test_misaligned_append_is_refused():
    tree = merkle.Witnesses(4)
    tree.append("a")
    with pytest.raises(ValueError):
        tree.append("b", 1)


def field(value):
    if value is None:
        return "-"
    return f"{len(str(value).encode())}:{value}"


def brute(rows, fan):
    leaves = sorted(
        ((r[2] is not None, (r[2] or "").encode(), r[0] is not None, r[0] or 0, sha(field(r[0]) + field(r[2]) + field(r[1]))) for r in rows)
    )
    trees = {}
    for has, name, *_, node in leaves:
        trees.setdefault((has, name), []).append(node)
    tops = {name: climb(nodes, fan) for name, nodes in trees.items()}
    root, upper = climb([tops[name][0] for name in trees], fan)
    out = []
    for (has, name), above in zip(trees, upper):
        keys = [(k, v) for h, s, k, v, _ in leaves if (h, s) == (has, name)]
        for (has_key, value), node, below in zip(keys, trees[has, name], tops[has, name][1]):
            whole = below + above
            out.append((value if has_key else None, node, tops[has, name][0], root, tuple(a for a, _ in whole), tuple(b for _, b in whole)))
    return out


ROWS = (
    [(i, f"text {i}", "hot", "r", "n") for i in range(90)]
    + [(i, None, f"s{i % 7}", None, None) for i in range(90, 140)]
    + [(200, "only", "\U0001d518", None, None), (201, "x" * 200_000, "￮", None, None), (None, "no id", None, None, None)]
    + [(300, "ties", "hot", None, None), (300, "ties too", "hot", None, None), *[(301, "same", "hot", None, None)] * 20]
    + [(302, "", "", None, None), (303, "é中", "", None, None)]
)


@pytest.mark.parametrize("fan, height", [(2, 1), (3, 2), (16, 3)])
def test_against_plain_trees(spark, fan, height):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(5)
    leaves = docs.withColumn("leaf", merkle.leaf([docs.doc_id, docs.source, docs.text]))
    found = merkle.manifest(leaves, fan=fan, height=height)
    assert found.columns == ["doc_id", "leaf", "left", "right", "subroot", "root"]
    got = [(r.doc_id, r.leaf, r.subroot, r.root, tuple(r.left), tuple(r.right)) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(brute(ROWS, fan), key=repr)
    folded = found.select(merkle.folded(found.leaf, found.left, found.right).alias("f"), "root").collect()
    assert all(r.f == r.root for r in folded)


def test_one_leaf_and_none(spark):
    one = spark.createDataFrame([(1, None, None, None, None)], SCHEMA)
    row = merkle.manifest(one.withColumn("leaf", merkle.leaf([one.doc_id]))).first()
    assert row.leaf == row.subroot == row.root == sha("1:1") and row.left == row.right == []
    empty = spark.createDataFrame([], SCHEMA)
    assert merkle.manifest(empty.withColumn("leaf", merkle.leaf([empty.doc_id]))).count() == 0


def test_tampering_shows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    shouted = {r.doc_id: r.text is not None and any("A" <= c <= "Z" for c in r.text) for r in docs}
    for r in QUERIES["op11_merkle_manifest"](spark, "/root/testdata/sf0.001").collect():
        touched = zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and shouted[r.doc_id]
        assert r.verified != touched
