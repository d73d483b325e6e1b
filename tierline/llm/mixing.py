"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Each source's documents are laid in seeded order on a line of words, cut into blocks of equal size:
BLOCK_WORDS, or the least target above nothing where that is less, so every source with a target has
blocks to win. Blocks are awarded to sources by highest quotients target / (2i + 1), shard by shard: the
awards of the first j shards are the apportionment of j / shards of all blocks, so each shard holds an
integer quota of every source. A source with quotas q1, q2, ... gives its first q1 blocks to the first
shard, those up to q2 to the second and so on, going round its line at most twice; as the line is in
seeded order, they are a seeded choice. Only a document in which a quota ends is cut.

Null text has no words, a null source is a source (the last), equal rows are taken alike in sum, and
an empty table gives an empty one. Sources whose words are all taken twice stop there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.exprs import WORD, let, whole, word_count, words_of
from tierline.session import stage

WEIGHTS = (3, 1, 2)  # by place of the source in code point order, repeating
SHARE_PERCENT = 150  # of all words
LIMIT = 2  # times a source's words
BLOCK_WORDS = 64
SHARDS = 8
SEED = "17"
_UP_TO = (Window.unboundedPreceding, Window.currentRow)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, nth, source_size, target) from (source, size) rows.

    A source stops at LIMIT times its words; what it leaves is reshared by weight. With sources
    ordered by limit over weight, those at their limit are the ones for which the shares that fill
    everybody up to that level still fit the total; the comparison is in integers.
    The windows run over one row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    nth = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("nth") % len(weights) + 1).cast("int"))
    rows = totals.withColumn("nth", nth).withColumn("weight", weight.cast("bigint"))
    rows = rows.withColumn("cap", LIMIT * F.col("source_size"))
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "nth")
    all_rows = Window.partitionBy(F.lit(0))
    rows = rows.select(
        "*",
        F.sum("cap").over(by_level.rowsBetween(*_UP_TO)).alias("caps"),
        (F.sum("weight").over(all_rows) - F.sum("weight").over(by_level.rowsBetween(*_UP_TO))).alias("rest"),
        F.sum("source_size").over(all_rows).alias("total"),
    )
    full = 100 * (F.col("weight") * F.col("caps") + F.col("cap") * F.col("rest")) <= SHARE_PERCENT * F.col("total") * F.col("weight")
    rows = rows.withColumn("full", full)
    used = F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(all_rows)
    open_weight = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(all_rows)
    level = (F.lit(SHARE_PERCENT / 100) * F.col("total") - used) / F.nullif(open_weight, F.lit(0))
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(level * F.col("weight"))
    return rows.select("source", "nth", "source_size", target.alias("target"))


def quotas(goals: DataFrame, block_words: int = BLOCK_WORDS, shards: int = SHARDS) -> DataFrame:
    """(source, nth, source_size, target, block_words, quotas): blocks awarded in the first 1, 2, ... shards.

    With S sources and H blocks the border quotient lies within a part S / 2H of the total over H, so
    only the awards that this leaves open are ranked, some five a source; those above are certain.
    """
    every = Window.partitionBy(F.lit(0))
    least = F.floor(F.min(F.when(F.col("target") > 0, F.col("target"))).over(every))
    block = F.greatest(F.lit(1), F.least(F.lit(block_words), F.coalesce(least, F.lit(1)))).cast("int")
    rows = goals.withColumns({"n": F.count(F.lit(1)).over(every), "total": F.sum("target").over(every), "block_words": block})
    rows = rows.withColumn("shard", F.explode(F.sequence(F.lit(1), F.lit(shards))))
    house = F.floor(F.round(F.col("total") / F.col("block_words")) * F.col("shard") / shards).cast("bigint")
    rows = rows.withColumn("house", house)
    ideal = F.coalesce(F.col("target") * F.col("house") / F.nullif(F.col("total"), F.lit(0.0)), F.lit(0.0))
    margin = F.coalesce(ideal * F.col("n") / F.nullif(2.0 * F.col("house"), F.lit(0.0)), F.lit(0.0)) + 1e-9 * ideal + 2
    rows = rows.withColumn("base", F.greatest(F.lit(0).cast("bigint"), F.floor(ideal - margin).cast("bigint")))
    rows = rows.withColumn("last", F.ceil(ideal + margin).cast("bigint"))
    rows = rows.withColumn("open", F.col("house") - F.sum("base").over(Window.partitionBy("shard")))
    awards = rows.withColumn("i", F.explode(F.sequence(F.col("base"), F.col("last"))))
    quotient = F.col("target") / (2 * F.col("i") + 1)
    rank = F.row_number().over(Window.partitionBy("shard").orderBy(quotient.desc(), "nth", "i"))
    won = F.when((rank <= F.col("open")) & (F.col("target") > 0), 1).otherwise(0)
    names = ["source", "nth", "source_size", "target", "block_words"]
    per_shard = awards.withColumn("won", won).groupBy(*names, "shard").agg((F.max("base") + F.sum("won")).alias("quota"))
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("shard", "quota"))), lambda x: x["quota"])
    return per_shard.groupBy(*names).agg(in_order.alias("quotas"))


def line(sizes: DataFrame, key: str = "doc_id") -> DataFrame:
    """``sizes`` with ``start``, each row's first word on its source's line in seeded order.

    Sums run inside (source, first digits of the seeded key); between those only one row per pair
    moves, so a source may hold any share of the rows.
    """
    seeded = F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    keyed = sizes.withColumns({"place": seeded}).withColumn("bucket", F.substring("place", 1, 3))
    inside = Window.partitionBy("source", "bucket").orderBy("place", "size").rowsBetween(*_UP_TO)
    per_bucket = keyed.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    before = F.sum("words").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(*_UP_TO)) - F.col("words")
    offsets = per_bucket.select(F.col("source").alias("o_source"), F.col("bucket").alias("o_bucket"), before.alias("before"))
    run = keyed.withColumn("start", F.sum("size").over(inside) - F.col("size"))
    met = F.col("source").eqNullSafe(F.col("o_source")) & (F.col("bucket") == F.col("o_bucket"))
    return run.join(offsets, met).withColumn("start", F.col("start") + F.col("before")).select(*sizes.columns, "start")


def _taken(limit: Column, start: Column, size: Column) -> Column:
    return F.greatest(F.lit(0).cast("bigint"), F.least(limit - start, size))


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per row of ``docs``: its words, its source's figures, and the words taken of it.

    ``first`` and ``second`` are the words taken on the first and second way round; words are taken
    from a document's beginning. ``parts`` says where they go: (shard from 0, first and last block of the
    source's awards, words) for each shard and way round that takes any.
    """
    sizes = docs.select(F.col(key), F.col(source).alias("source"), word_count(F.col(text)).alias("size"))
    return _mixed(stage(sizes, "sizes"), key)


def _mixed(sizes: DataFrame, key: str) -> DataFrame:
    shares = quotas(targets(sizes)).withColumnRenamed("source", "q_source")
    rows = line(sizes, key).join(shares, F.col("source").eqNullSafe(F.col("q_source")))
    limit = F.element_at("quotas", -1) * F.col("block_words")
    first = _taken(limit, F.col("start"), F.col("size"))
    second = _taken(limit - F.col("source_size"), F.col("start"), F.col("size"))
    rows = rows.withColumns({"first": first, "second": second})
    return rows.select(
        key, "source", "size", "source_size", "target", "first", "second", (F.col("first") + F.col("second")).alias("taken"),
        "start", "quotas", "block_words", _parts().alias("parts"),
    )


def _parts() -> Column:
    """The shards that a document's words go to, from the quotas that bound each shard's run of the line."""
    width = F.col("block_words").cast("bigint")

    def part(shard: Column, way: int) -> Column:
        begin = F.col("start") + way * F.col("source_size")
        before = F.when(shard > 0, F.get("quotas", shard - 1)).otherwise(0) * width
        low = F.greatest(begin, before)
        high = F.least(begin + F.col("size"), F.get("quotas", shard) * width)
        return F.struct(
            shard.cast("int").alias("shard"), F.floor(low / width).alias("first_block"),
            F.floor((high - 1) / width).alias("last_block"), (high - low).alias("words"),
        )

    shards = F.sequence(F.lit(0), F.size("quotas") - 1)

    def round_(way: int) -> Column:
        return F.transform(shards, lambda shard: part(shard, way))

    return F.filter(F.concat(*[round_(way) for way in range(LIMIT)]), lambda p: p["words"] > 0)


def _first_words(text: Column, n: Column) -> Column:
    """A text up to the end of its ``n``-th word, white space as it was."""

    def cut(words: Column) -> Column:
        gaps = F.split(text, WORD, -1)
        return F.array_join(F.zip_with(F.slice(gaps, F.lit(1), n), F.slice(words, F.lit(1), n), lambda g, w: F.concat(g, w)), "")

    return let(words_of(text), cut)


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix as rows of ``docs``: a document once for each way round that takes words of it, cut
    after those words in the one document per source and round where the quota ends.

    Rows that agree in key, source and size are given the same set of ways round once each, dealt by
    their rank, so repeated rows are not multiplied.
    """
    columns = docs.columns
    size = word_count(F.col(text))
    named = docs.select(
        F.struct(*columns).alias("__row"),
        F.xxhash64(F.col(key), F.col(source), size).alias("__id"),
        size.alias("__size"),
    )
    sizes = stage(docs.select(F.col(key).alias("key"), F.col(source).alias("source"), size.alias("size")), "sizes")
    plan = _mixed(sizes, "key").filter("taken > 0")
    plan = plan.withColumn("__id", F.xxhash64("key", "source", "size"))
    plan = plan.withColumn("__nth", F.row_number().over(Window.partitionBy("__id").orderBy("key", "source", "size", "start")))
    body = F.col("__row")[text]
    ids = sizes.groupBy(F.xxhash64("key", "source", "size").alias("id")).count()
    if ids.filter("count > 1").limit(1).count():
        nth = F.row_number().over(Window.partitionBy("__id").orderBy(F.col("__row")[key], F.col("__row")[source], F.xxhash64(body)))
    else:  # the usual case: the rows need not be ranked, hence are shuffled once
        nth = F.lit(1)
    rows = named.withColumn("__nth", nth)
    plan = plan.select("__id", "__nth", F.filter(F.array("first", "second"), lambda n: n > 0).alias("ways"))
    ways = rows.join(plan, ["__id", "__nth"]).withColumn("__take", F.explode("ways"))
    cut = F.when(F.col("__take") == F.col("__size"), body).otherwise(_first_words(body, F.col("__take").cast("int")))
    return ways.select(*[cut.alias(c) if c == text else F.col("__row")[c].alias(c) for c in columns])


ORACLE = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
    md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place
  FROM documents
), s AS (
  SELECT *, 2 * source_size AS cap, CAST([{", ".join(map(str, WEIGHTS))}][nth % {len(WEIGHTS)} + 1] AS BIGINT) AS weight
  FROM (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth
    FROM d GROUP BY source
  )
), f AS (
  SELECT *, 100 * (weight * sum(cap) OVER w + cap * (sum(weight) OVER () - sum(weight) OVER w))
      <= {SHARE_PERCENT} * sum(source_size) OVER () * weight AS at_cap, sum(source_size) OVER () AS total
  FROM s WINDOW w AS (ORDER BY cap / weight, nth ROWS UNBOUNDED PRECEDING)
), t AS (
  SELECT source, nth, source_size, CASE WHEN at_cap THEN CAST(cap AS DOUBLE) ELSE weight *
      (({SHARE_PERCENT / 100}::DOUBLE * total - sum(CASE WHEN at_cap THEN cap ELSE 0 END) OVER ())
        / nullif(sum(CASE WHEN at_cap THEN 0 ELSE weight END) OVER (), 0)) END AS target
  FROM f
), house AS (
  SELECT CAST(round(sum(target) / any_value(block)) AS BIGINT) AS seats, any_value(block) AS block, sum(target) AS total
  FROM t, (SELECT greatest(1, least({BLOCK_WORDS}, CAST(floor(coalesce(min(target) FILTER (target > 0), 1)) AS BIGINT))) AS block FROM t)
), awards AS (
  SELECT source, row_number() OVER (ORDER BY target / (2 * i + 1) DESC, nth, i) AS rank
  FROM (SELECT source, nth, target, unnest(range(0, CAST(target * seats / total AS BIGINT) + (SELECT count(*) FROM t) + 3)) AS i
        FROM t, house WHERE target > 0)
), quota AS (
  SELECT source, count(*) * any_value(block) AS words FROM awards, house WHERE rank <= seats GROUP BY source
), laid AS (
  SELECT doc_id, source, size,
    CAST(sum(size) OVER (PARTITION BY source ORDER BY place, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS start
  FROM d
)
SELECT doc_id, size, source_size, target, CAST(
    greatest(0, least(coalesce(words, 0) - start, size)) + greatest(0, least(coalesce(words, 0) - source_size - start, size))
  AS BIGINT) AS taken
FROM laid JOIN t ON laid.source IS NOT DISTINCT FROM t.source LEFT JOIN quota ON laid.source IS NOT DISTINCT FROM quota.source
"""
