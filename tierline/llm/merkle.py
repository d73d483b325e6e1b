"""A Merkle manifest of a dataset, with incremental witnesses.

Rows are leaves of one hash tree a source, in the order of their keys; the trees' tops are leaves of one
more tree, whose top names the whole dataset. Every run of ``FAN`` nodes, the last one of fewer, becomes
one node while more than one remains.

A tree is built by streaming append: ``Witnesses`` keeps one open run a height. A node that joins a run
has a partial witness; when the run is complete, its siblings extend the witness of every leaf below it
and their parent is appended one height up. Aligned blocks of ``FAN ** HEIGHT`` leaves are built in
tasks of their own, and their tops are appended to further such trees at that height. A task holds one
block, whatever the size of a source; a block's upper witness is one row, so what moves for each leaf is
its digest alone. Only the number of nodes of the largest tree comes to the driver, once a level.

Nulls are values of their own: a row without key comes first in its tree and rows without source have
one tree, the first. Rows that agree in key are ordered by digest; equal rows are as many equal leaves.
Texts may be long. An empty table has no root and an empty result.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.places import placed
from tierline.session import stage

FAN = 16
HEIGHT = 3  # a block has FAN ** HEIGHT leaves
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts one after another."""
    return F.sha2(F.concat(*parts), 256)


def leaf(fields: list[Column]) -> Column:
    """The digest of a row: each field as its UTF-8 byte count, a colon and the value; ``-`` if null."""

    def framed(field: Column) -> Column:
        value = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return digest(*[framed(f) for f in fields])


def _hash(joined: str) -> str:
    return hashlib.sha256(joined.encode()).hexdigest()


class Witnesses:
    """A tree that grows by append, and the witness of each member so far.

    ``left[m]`` and ``right[m]`` hold what stands before and after the member's ancestor in the run of
    each height, from the bottom. ``append`` takes a node of any height at which the tree is aligned,
    that is, below which no run is open.
    """

    def __init__(self, fan: int = FAN):
        self.fan = fan
        self.runs: list[list[tuple[str, int, int]]] = []  # by height: (digest, members from, to)
        self.left: list[list[str]] = []
        self.right: list[list[str]] = []

    def append(self, node: str, height: int = 0) -> None:
        if any(self.runs[:height]):
            raise ValueError("a run below this height is open")
        self.left.append([])
        self.right.append([])
        self._join(node, height, len(self.left) - 1, len(self.left))

    def _join(self, node: str, height: int, first: int, last: int) -> None:
        while len(self.runs) <= height:
            self.runs.append([])
        self.runs[height].append((node, first, last))
        if len(self.runs[height]) == self.fan:
            self._complete(height)

    def _complete(self, height: int) -> None:
        run, self.runs[height] = self.runs[height], []
        joined = "".join(node for node, _, _ in run)
        at = 0
        for node, first, last in run:
            before, after = joined[:at], joined[at + len(node) :]
            at += len(node)
            for member in range(first, last):
                self.left[member].append(before)
                self.right[member].append(after)
        self._join(_hash(joined), height + 1, run[0][1], run[-1][2])

    def close(self, height: int = 0) -> str:
        """Completes open runs until one node at ``height`` or above remains, and returns it."""
        at = 0
        while True:
            open_above = any(self.runs[at + 1 :])
            run = self.runs[at] if at < len(self.runs) else []
            if len(run) == 1 and not open_above and at >= height:
                return run[0][0]
            if run:
                self._complete(at)
            at += 1


def _grow(digests: list[str], nodes: int, fan: int, height: int) -> tuple[Witnesses, str]:
    """The tree of one block; a block of a larger tree goes up to its full height."""
    tree = Witnesses(fan)
    for node in digests:
        tree.append(node)
    return tree, tree.close(height if nodes > fan**height else 0)


def _block(span: int) -> Column:
    return F.floor(F.col("place") / span).cast("bigint").alias("block")


def _tops(nodes: DataFrame, fan: int, height: int) -> DataFrame:
    """(tree, place, n, node) of the blocks of ``nodes``, themselves nodes of a tree."""
    span = fan**height

    def top(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        n = table.column("n")[0].as_py()
        _, node = _grow(table.column("node").to_pylist(), n, fan, height)
        block = table.column("place")[0].as_py() // span
        return pa.table(
            {"tree": table.column("tree")[:1], "place": pa.array([block]), "n": pa.array([-(-n // span)]), "node": pa.array([node])}
        )

    grouped = nodes.select("tree", "place", "n", "node").groupBy("tree", _block(span))
    return stage(grouped.applyInArrow(top, "tree string, place long, n long, node string"), "tops")


def _levels(nodes: DataFrame, fan: int, height: int) -> list[DataFrame]:
    """``nodes``, their blocks, the blocks of these, and so on; the last have one node a tree."""
    levels = [nodes]
    while True:
        levels.append(_tops(levels[-1], fan, height))
        if (levels[-1].agg(F.max("n")).first()[0] or 0) <= 1:
            return levels


def _extended(nodes: DataFrame, upper: DataFrame, fan: int, height: int) -> DataFrame:
    """``nodes`` with their witnesses in the block, extended by the block's own: ``upper`` has (tree,
    place, left, right) and whatever else a block's nodes inherit, one row a block."""
    span = fan**height
    inherited = [f for f in upper.schema.fields if f.name not in ("tree", "place", "left", "right")]
    lists = [T.StructField(side, T.ArrayType(T.StringType())) for side in ("left", "right")]
    schema = T.StructType([*nodes.schema.fields, *lists, *inherited])
    ours = nodes.columns

    def extend(mine: pa.Table, above: pa.Table) -> pa.Table:
        mine = mine.select(ours).sort_by("place")
        if not mine.num_rows or not above.num_rows:
            return pa.table({f.name: [] for f in schema.fields}, schema=_arrow(schema))
        tree, _ = _grow(mine.column("node").to_pylist(), mine.column("n")[0].as_py(), fan, height)
        columns = {name: mine.column(name) for name in ours}
        for side, found in (("left", tree.left), ("right", tree.right)):
            further = above.column(side)[0].as_py()
            columns[side] = pa.array([x + further for x in found], pa.list_(pa.string()))
        for field in inherited:
            columns[field.name] = pa.array([above.column(field.name)[0].as_py()] * mine.num_rows, pa.string())
        return pa.table(columns)

    keyed = upper.withColumnRenamed("place", "block")
    return nodes.groupBy("tree", _block(span)).cogroup(keyed.groupBy("tree", "block")).applyInArrow(extend, schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _witnessed(levels: list[DataFrame], upper: DataFrame, fan: int, height: int) -> DataFrame:
    """The first level's nodes with whole witnesses; ``upper`` extends the last level's."""
    for nodes in reversed(levels[:-1]):
        upper = _extended(nodes, upper, fan, height)
        if nodes is not levels[0]:
            upper = stage(upper.drop("n", "node"), "upper")
    return upper


def manifest(
    leaves: DataFrame, key: str = "doc_id", source: str = "source", node: str = "leaf", carry: tuple[str, ...] = (),
    fan: int = FAN, height: int = HEIGHT,
) -> DataFrame:
    """(key, node, *carry, left, right, subroot, root): every leaf with its witness.

    ``leaves`` has a digest a row. ``left`` and ``right`` are arrays over the heights from the leaf to
    the root: what stands before and after one's own digest in the run that is hashed there.
    """
    named = F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))  # no source comes first
    carried = [F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)]
    rows = leaves.select(named.alias("tree"), F.col(key).alias("key"), F.col(node).alias("node"), *carried)
    nodes = stage(placed(rows, ["key", "node"]), "nodes")
    levels = _levels(nodes, fan, height)
    tops = levels[-1].select("tree", F.col("node").alias("subroot"))
    subroots = levels[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "node")
    top_nodes = stage(placed(subroots, ["name"]), "subroots")
    top_levels = _levels(top_nodes, fan, height)
    bare = F.array().cast("array<string>")
    apex = top_levels[-1].select("tree", "place", bare.alias("left"), bare.alias("right"), F.col("node").alias("root"))
    above = _witnessed(top_levels, apex, fan, height).select(F.col("name").alias("tree"), "left", "right", "root")
    upper = above.join(tops, "tree").select("tree", F.lit(0).cast("bigint").alias("place"), "left", "right", "subroot", "root")
    found = _witnessed(levels, stage(upper, "upper"), fan, height)
    return found.select(
        F.col("key").alias(key),
        F.col("node").alias(node),
        *[F.col(f"carry_{i}").alias(c) for i, c in enumerate(carry)],
        "left", "right", "subroot", "root",
    )


def proof(left: Column, right: Column) -> Column:
    """All siblings of a witness, height by height, one after another."""
    return F.array_join(F.zip_with(left, right, lambda a, b: F.concat(a, b)), "")


def folded(node: Column, left: Column, right: Column) -> Column:
    """The root that a leaf's digest and its witness lead to."""
    heights = F.zip_with(left, right, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return F.aggregate(heights, node, lambda at, run: digest(run["a"], at, run["b"]))


def oracle(tampered_text: str, every: int, fan: int = FAN, heights: int = 6) -> str:
    """DuckDB SQL for the manifest of ``documents``, for trees of up to fan ** heights leaves."""

    def framed(value: str) -> str:
        return f"coalesce(strlen({value}) || ':' || {value}, '-')"

    def hashed(text: str) -> str:
        return "sha256(" + " || ".join(framed(f"CAST({f} AS VARCHAR)") if f != "text" else framed(text) for f in FIELDS) + ")"

    def tree(name: str, group: str) -> str:
        parts = []
        for h in range(heights):
            parts.append(f"""
{name}_run{h} AS (
  SELECT {group}, place // {fan} AS run, max(n) AS n, string_agg(node, '' ORDER BY place) AS joined FROM {name}{h} GROUP BY {group}, run
), {name}{h + 1} AS (
  SELECT {group}, run AS place, (n + {fan - 1}) // {fan} AS n, CASE WHEN n > 1 THEN sha256(joined) ELSE joined END AS node FROM {name}_run{h}
)""")
        return ",".join(parts)

    def climb(name: str, start: str, group: str) -> str:
        joins, lefts, rights = [], [], []
        for h in range(heights):
            joins.append(
                f"JOIN {name}_run{h} {name}r{h} ON {name}r{h}.{group} = {start}.{group} AND {name}r{h}.run = {start}.place // {fan ** (h + 1)}"
            )
            own = f"({start}.place // {fan**h}) % {fan}"
            lefts.append(f"CASE WHEN {name}r{h}.n > 1 THEN left({name}r{h}.joined, CAST({own} * 64 AS BIGINT)) END")
            rights.append(f"CASE WHEN {name}r{h}.n > 1 THEN substr({name}r{h}.joined, CAST({own} * 64 + 65 AS BIGINT)) END")
        pairs = ", ".join(f"{{'a': {a}, 'b': {b}}}" for a, b in zip(lefts, rights))
        return f"list_filter([{pairs}], lambda x: x.a IS NOT NULL)", "\n  ".join(joins)

    low, low_joins = climb("t", "l", "tree")
    high, high_joins = climb("s", "s0", "top")
    fold = "list_reduce(list_concat([{'a': %s, 'b': ''}], witness), lambda x, y: {'a': sha256(y.a || x.a || y.b), 'b': ''}).a"
    return f"""
WITH crc_table AS (
  SELECT list(value ORDER BY i) AS entries FROM (
    SELECT i, list_reduce(list_concat([i], CAST(range(8) AS BIGINT[])), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS value
    FROM (SELECT CAST(range AS BIGINT) AS i FROM range(256))
  )
), named AS (
  SELECT *, coalesce('=' || source, '') AS tree, {hashed("text")} AS node,
    xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], [CAST(ord(c) AS BIGINT) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]),
      lambda c, b: xor(c >> 8, entries[xor(c & 255, b) + 1])), 4294967295) % {every} = 0 AS tampers
  FROM documents CROSS JOIN crc_table
), l AS (
  SELECT doc_id, tree, node, CASE WHEN tampers THEN {hashed(tampered_text)} ELSE node END AS used,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, node) - 1 AS place, count(*) OVER (PARTITION BY tree) AS n
  FROM named
), t0 AS (SELECT tree, place, n, node FROM l),{tree("t", "tree")},
s0 AS (
  SELECT 1 AS top, tree, node, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS n FROM t{heights}
),{tree("s", "top")},
upper AS (
  SELECT s0.tree, s0.node AS subroot, s{heights}.node AS root, {high} AS witness
  FROM s0 CROSS JOIN s{heights} {high_joins}
), lower AS (
  SELECT l.doc_id, l.tree, l.node AS leaf, l.used, {low} AS witness FROM l {low_joins}
), joined AS (
  SELECT doc_id, leaf, used, subroot, root, list_concat(lower.witness, upper.witness) AS witness FROM lower JOIN upper USING (tree)
)
SELECT doc_id, leaf, subroot, root,
  sha256(coalesce(array_to_string([x.a || x.b FOR x IN witness], ''), '')) AS proof_sha256,
  {fold % "used"} AS folded_root, {fold % "used"} = root AS verified
FROM joined
"""
