"""DataFrame operators: hard cases, plans, and groups split over tasks."""

import datetime as dt
import os
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from tierline.functions import money
from tierline.operators import clean, incremental, joins, layout, numbering, quality, slices, upsert, windows
from tierline.registry import queries
from tierline.session import scratch_path, stage
from tierline.sources import files, tables
from tierline.streaming.load import stream_upsert


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# --- clean ---


def test_dedup_keeps_the_latest_whatever_the_partitioning(spark):
    data = [(1, 5, "b"), (1, 5, "a"), (1, 4, "c"), (2, None, "d"), (None, 1, "e"), (None, 2, "f")]
    for parts in (1, 3):
        df = spark.createDataFrame(data, "k int, v int, t string").repartition(parts)
        assert rows(clean.dedup_latest(df, ["k"], ["v"])) == [(1, 5, "a"), (2, None, "d"), (None, 2, "f")]


def test_dedup_limits_groups_before_the_shuffle(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    text = plan(clean.dedup_latest(lines, ["l_orderkey"], ["l_shipdate"]))
    assert text.count("WindowGroupLimit") >= 2


def test_top_k_limits_before_the_shuffle(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    assert "TakeOrderedAndProject" in plan(windows.top_k(lines, [F.desc("l_extendedprice")], 3))
    per_group = windows.top_k(lines, [F.desc("l_extendedprice")], 3, ["l_returnflag"])
    assert "WindowGroupLimit" in plan(per_group)
    assert per_group.count() == 9


def test_require_drops_null_and_nan(spark):
    df = spark.createDataFrame([(1, 1.0), (None, 1.0), (2, None), (3, float("nan"))], "k int, v double")
    assert rows(clean.require(df, ["k", "v"])) == [(1, 1.0)]


def test_lookup_does_not_multiply_rows(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "c int")
    mapping = spark.createDataFrame([(1, "x"), (1, "w"), (None, "n")], "k int, label string")
    found = joins.lookup(df, mapping, "c", "k", "label", "name", "Other")
    assert rows(found) == [(1, "w"), (2, "Other"), (None, "Other")]


# --- windows: the sliced results equal the plain ones ---


@pytest.fixture(scope="module")
def skewed(spark):
    """One group with most rows, many ties and copies, null keys and null values."""
    df = spark.range(6000).select(
        F.when(F.col("id") % 10 < 7, F.lit("hot")).when(F.col("id") % 10 < 9, F.lit("b")).alias("k"),
        F.when(F.col("id") % 13 != 0, F.col("id") % 41).cast("int").alias("v"),
        (F.col("id") % 600).cast("int").alias("u"),
    )
    return stage(df.repartition(5))


def test_sliced_numbers_equal_plain_numbers(spark, skewed):
    order = [F.desc("v"), F.asc("u")]
    plain = windows.number_within(skewed, ["k"], order, "n", None)
    sliced = windows.number_within(skewed, ["k"], order, "n", 200)
    assert rows(sliced) == rows(plain)


def test_tied_rows_get_equal_numbers_sliced_or_not(spark, skewed):
    tied = skewed.withColumn("m", F.create_map(F.lit("a"), F.col("v")))
    plain, sliced = (windows.number_within(tied.repartition(n), ["k"], [F.lit(1)], "n", per) for n, per in ((3, None), (5, 200)))
    assert rows(sliced.drop("m")) == rows(plain.drop("m"))


def test_slices_are_not_shuffled_for_their_offsets(spark, skewed):
    bound = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(windows.number_within(stage(skewed), ["k"], [F.asc("u")], "n", 200))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text


def test_sliced_ranks_equal_plain_ranks(spark, skewed):
    for by in ("v", "u"):
        for descending in (True, False):
            plain = windows.dense_rank_within(skewed, ["k"], by, "r", descending, None)
            for bound in (10, 1000, 1_000_000):
                assert rows(windows.dense_rank_within(skewed, ["k"], by, "r", descending, bound)) == rows(plain)


def test_sliced_previous_equals_plain_previous(spark, skewed):
    """The order has ties only between equal rows."""
    plain = windows.previous_within(skewed, ["k"], ["u", "v"], "v", "p", None)
    sliced = windows.previous_within(skewed, ["k"], ["u", "v"], "v", "p", 200)
    assert rows(sliced) == rows(plain)


def test_no_task_gets_a_whole_hot_group(spark, skewed):
    """Even equal rows spread: all keys and orders the same."""
    copies = spark.range(4000).select(F.lit("hot").alias("k"), F.lit(1).alias("v"))
    assert slices.split_hot(copies, ["k"], 500)[2] == 4000
    sizes = slices.slice_groups(copies, ["k"], [F.asc("v")], 4000, 500).groupBy(slices.SLICE).count()
    assert sizes.agg(F.max("count")).first()[0] < 1000
    numbered = windows.number_within(copies, ["k"], [F.asc("v")], "n", 500)
    assert numbered.agg(F.countDistinct("n"), F.max("n")).first()[:] == (4000, 4000)
    everywhere = windows.number_within(copies, [], [F.asc("v")], "n", 500)
    assert everywhere.agg(F.countDistinct("n"), F.max("n")).first()[:] == (4000, 4000)


def test_few_values_are_ranked_without_sorting_rows(spark):
    lines = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet").select("l_returnflag", "l_quantity")
    text = plan(windows.dense_rank_within(lines, ["l_returnflag"], "l_quantity", "r"))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


# --- upsert and incremental ---

OLD = [(1, "a", 1), (2, "b", 1), (None, "n", 1)]


def test_merge_updates_inserts_and_keeps(spark):
    old = spark.createDataFrame(OLD, "k int, v string, d int")
    new = spark.createDataFrame([(2, "B", 3), (2, "x", 2), (3, "c", 2), (None, "m", 2), (None, "m", 2)], old.schema)
    expected = [(1, "a", 1), (2, "B", 3), (3, "c", 2), (None, "m", 2), (None, "m", 2), (None, "n", 1)]
    merged = upsert.merge_frames(old, new, "k", ["d"])
    assert rows(merged) == sorted(expected, key=repr)
    again = upsert.merge_frames(stage(merged.filter("k is not null")), new.filter("k is not null"), "k", ["d"])
    assert rows(again) == rows(merged.filter("k is not null"))


def test_merge_with_added_and_absent_columns(spark):
    old = spark.createDataFrame(OLD, "k int, v string, d int")
    new = spark.createDataFrame([(2, 5, True), (4, 6, False)], "k int, d int, extra boolean")
    merged = upsert.merge_frames(old, new, "k", ["d"])
    assert merged.columns == ["k", "v", "d", "extra"]
    assert rows(merged.filter("k is not null")) == [(1, "a", 1, None), (2, "b", 5, True), (4, None, 6, False)]


def test_small_delta_does_not_shuffle_the_table(spark):
    orders = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    delta = orders.filter("o_orderkey < 10")
    text = plan(upsert.merge_frames(orders, delta, "o_orderkey", unique=True))
    assert "BroadcastHashJoin LeftAnti" in text and "Exchange hashpartitioning" not in text


def test_partition_merge_leaves_other_folders_alone(spark):
    path = scratch_path(spark, "parts")
    base = spark.createDataFrame([(i, i % 3, "old") for i in range(30)], "k int, p int, v string")
    layout.write_partitioned(base, path, ["p"])
    local = path.removeprefix("file:")
    before = {p: sorted(os.listdir(f"{local}/p={p}")) for p in range(3)}
    delta = spark.createDataFrame([(1, 1, "new"), (100, 1, "new"), (100, 1, "newer")], base.schema)
    upsert.merge_into_partitions(spark, path, delta, "k", ["p"], ["v"])
    after = {p: sorted(os.listdir(f"{local}/p={p}")) for p in range(3)}
    assert before[0] == after[0] and before[2] == after[2] and before[1] != after[1]
    found = spark.read.parquet(path)
    assert found.count() == 31
    assert rows(found.filter("v != 'old'").select("k", "p", "v")) == [(1, 1, "new"), (100, 1, "newer")]
    moved = spark.createDataFrame([(1, 2, "moved")], base.schema)
    upsert.merge_into_partitions(spark, path, moved, "k", ["p"])
    found = spark.read.parquet(path)
    assert found.count() == 31
    assert rows(found.filter("k = 1").select("k", "p", "v")) == [(1, 2, "moved")]


def test_partition_merge_drops_emptied_folders(spark):
    path = scratch_path(spark, "emptied")
    base = spark.createDataFrame([(1, "a b"), (2, None), (3, "c")], "k int, p string")
    layout.write_partitioned(base.withColumn("v", F.lit(0)), path, ["p"])
    delta = spark.createDataFrame([(1, "c", 1), (2, "d", 1)], "k int, p string, v int")
    for _ in range(2):
        upsert.merge_into_partitions(spark, path, delta, "k", ["p"])
        found = rows(spark.read.parquet(path).select("k", "p", "v"))
        assert found == [(1, "c", 1), (2, "d", 1), (3, "c", 0)]


DAY = dt.datetime(2024, 1, 1)


def frame(spark, data):
    return spark.createDataFrame([(k, DAY + dt.timedelta(days=d), v) for k, d, v in data], "k int, t timestamp, v string")


def test_incremental_runs(spark):
    root = scratch_path(spark, "inc")
    load = lambda df, **more: incremental.load(df, root, "t", "incremental", "t", "k", **more)
    assert incremental.read_mark(spark, root, "t") is None
    assert incremental.current(spark, root, "t") is None
    first = load(frame(spark, [(1, 1, "a"), (2, 2, "b")]))
    assert first.mark == "2024-01-03 00:00:00" and first.seq == 1
    nothing = load(frame(spark, [(1, 1, "ignored")]))
    assert nothing == first
    late_tie = frame(spark, [(1, 1, "a"), (3, 2, "tie"), (2, 4, "B")])
    second = load(late_tie)
    assert second.seq == 2
    assert [r[0] for r in rows(incremental.current(spark, root, "t"))] == [1, 2]
    load(frame(spark, [(3, 4, "tie")]), inclusive=True)
    assert [r[0] for r in rows(incremental.current(spark, root, "t"))] == [1, 2, 3]


def test_unfinished_run_is_repeated(spark):
    root = scratch_path(spark, "dead")
    incremental.load(frame(spark, [(1, 1, "a")]), root, "t", "incremental", "t", "k")
    frame(spark, [(9, 9, "half written")]).write.parquet(f"{root}/t/snapshot-000002")
    assert incremental.current(spark, root, "t").count() == 1
    incremental.load(frame(spark, [(1, 1, "a"), (2, 2, "b")]), root, "t", "incremental", "t", "k")
    assert [r[0] for r in rows(incremental.current(spark, root, "t"))] == [1, 2]


def test_full_load_replaces_and_modes_are_checked(spark):
    root = scratch_path(spark, "full")
    products = spark.createDataFrame([(1, "a")], "product_id int, v string")
    incremental.load_configured(products, root, "products")
    incremental.load_configured(products.withColumn("v", F.lit("z")), root, "products")
    assert rows(incremental.current(spark, root, "products")) == [(1, "z")]
    with pytest.raises(ValueError):
        incremental.load(products, root, "products", "sometimes")


def test_slice_filter_reaches_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    text = plan(incremental.rows_after(orders, "o_orderdate", "1999-06-30"))
    assert "GreaterThan(o_orderdate" in text.split("PushedFilters")[1]


def test_stream_reads_each_file_once(spark):
    base = scratch_path(spark, "stream")
    run = lambda: stream_upsert(
        spark, f"{base}/in", "k int, t timestamp, v string", f"{base}/check", base, "t", "k", ["t"]
    )
    frame(spark, [(1, 1, "a"), (2, 1, "b")]).write.parquet(f"{base}/in")
    assert run() == 1
    assert run() == 0
    frame(spark, [(2, 3, "B"), (2, 2, "older"), (3, 1, "c")]).write.mode("append").parquet(f"{base}/in")
    assert run() == 1
    assert [(r[0], r[2]) for r in rows(incremental.current(spark, base, "t"))] == [(1, "a"), (2, "B"), (3, "c")]


# --- quality and layout ---


def test_profile_counts(spark):
    df = spark.createDataFrame([(1, "x"), (1, None), (None, "y")], "k int, s string")
    found = {(r[0], r[1]): r[2] for r in quality.profile(df, {"small": F.col("k") < 5}, ["s"], "k").collect()}
    assert found == {
        ("rows", "*"): 3, ("columns", "*"): 2, ("nulls", "k"): 1, ("nulls", "s"): 1,
        ("violations", "small"): 1, ("distinct_estimate", "s"): 2, ("distinct", "k"): 1,
    }
    empty = {(r[0], r[1]): r[2] for r in quality.profile(df.limit(0)).collect()}
    assert empty[("rows", "*")] == 0 and empty[("columns", "*")] == 2


def test_value_profile_counts_every_kind(spark):
    df = spark.createDataFrame(
        [("a", 1.0, [1], b"x", None), ("a", -0.5, [1, 2], b"x", None), (None, 1.0, None, None, None), ("b", None, [1], b"y", None)],
        "s string, d double, l array<int>, b binary, n int",
    )
    found = quality.value_profile(df, df.columns, top=1)
    got = {r[0]: tuple(r[1:]) for r in found.collect()}
    assert got == {
        "s": (4, 1, 2, 1, "a", 2), "d": (4, 1, 2, 1, "1.0", 2), "l": (4, 1, 2, 1, '{"l":[1]}', 2),
        "b": (4, 1, 2, 1, "78", 2), "n": (4, 4, 0, None, None, None),
    }
    assert quality.value_profile(df.limit(0), df.columns).count() == 0
    assert "WindowGroupLimit" in plan(found)
    same = quality.value_profile(df.repartition(3), ["d", "s"], top=5).filter("column = 's'").orderBy("place")
    assert [(r.value, r.value_rows) for r in same.collect()] == [("a", 2), ("b", 1)]


def test_quantiles_of_values_and_of_none(spark):
    df = spark.range(101).selectExpr("id", "IF(id < 0, id, NULL) AS none")
    got = {(r[0], r[1]): r[2] for r in quality.quantile_profile(df, ["id", "none"], [0.0, 0.5, 1.0]).collect()}
    assert got == {("id", 0.0): 0.0, ("id", 0.5): 50.0, ("id", 1.0): 100.0} | {("none", s): None for s in (0.0, 0.5, 1.0)}


# --- numbering ---


def test_numbers_are_dense_and_stay(spark):
    path = scratch_path(spark, "numbers")
    first = spark.createDataFrame([("b", 2), ("a", 1), (None, 1), ("b", 2), ("a", None)], "k string, j int")
    one = {(r.k, r.j): r.sk for r in numbering.number_keys(first, path, ["k", "j"]).collect()}
    assert one == {(None, 1): 1, ("a", None): 2, ("a", 1): 3, ("b", 2): 4}
    second = spark.createDataFrame([("aa", 0), ("a", 1), ("A", 9), ("b", 2), ("aa", 0)], "k string, j int")
    two = numbering.number_keys(second.repartition(3), path, ["k", "j"])
    assert rows(two) == rows(spark.createDataFrame([("aa", 0, 6), ("a", 1, 3), ("A", 9, 5), ("b", 2, 4), ("aa", 0, 6)]))
    again = numbering.number_keys(first, path, ["k", "j"])
    assert {(r.k, r.j): r.sk for r in again.collect()} == one
    assert numbering.key_map(spark, path, ["k", "j"], "sk").count() == 6


def test_numbers_of_many_partitions_have_no_gap(spark):
    path = scratch_path(spark, "numbers")
    for low, high in ((0, 5000), (3000, 9000)):
        got = numbering.number_keys(spark.range(low, high, numPartitions=7), path, ["id"])
    assert rows(numbering.key_map(spark, path, ["id"], "sk")) == sorted(((i, i + 1) for i in range(9000)), key=repr)
    assert got.count() == 6000


def test_numbers_of_no_rows_and_of_a_taken_name(spark):
    path = scratch_path(spark, "numbers")
    none = numbering.number_keys(spark.range(0), path, ["id"])
    assert none.count() == 0 and none.columns == ["id", "sk"]
    assert numbering.number_keys(spark.range(2), path, ["id"]).agg(F.max("sk")).first()[0] == 2
    with pytest.raises(ValueError, match="column of the rows"):
        numbering.number_keys(spark.range(2).withColumn("sk", F.lit(1)), path, ["id"])


def test_orphans_count_rows_and_null_keys(spark):
    fact = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(1,)], "k int")
    assert rows(quality.orphans(fact, dim, "k")) == [(2, 2), (None, 1)]
    assert rows(quality.key_collisions(fact, "k")) == [(2, 2)]


def test_table_stats_reads_no_column(spark):
    path = scratch_path(spark, "stats")
    spark.range(100).repartition(4).write.parquet(path)
    found = quality.table_stats(spark, path)
    row = found.first()
    assert (row["rows"], row["columns"], row["files"]) == (100, 1, 4) and row["bytes"] > 0
    assert "ReadSchema: struct<>" in plan(found)


def test_compaction_does_not_shuffle(spark):
    small, big = scratch_path(spark, "small"), scratch_path(spark, "big")
    spark.range(1000).repartition(20).write.parquet(small)
    layout.compact(spark, small, big)
    assert quality.table_stats(spark, big).first()["files"] == 1
    assert spark.read.parquet(big).agg(F.sum("id")).first()[0] == 499500


def fragments(spark, path):
    """A table of two folders, each with one large file and six small ones, one of them with a column more."""
    spark.range(40000).selectExpr("id", "uuid() AS u", "concat('0', id % 2) AS p").repartition(1).write.partitionBy("p").parquet(path)
    for i in range(6):
        few = spark.range(i * 10, i * 10 + 10).selectExpr("-id AS id", "'x' AS u", "concat('0', id % 2) AS p")
        few = few.withColumn("extra", F.lit(i)) if i == 5 else few
        few.repartition(1).write.mode("append").partitionBy("p").parquet(path)


def files_of(spark, path):
    """Files by folder."""
    found = {}
    for folder, _, names in os.walk(path.removeprefix("file:")):
        for name in names:
            if name.endswith(".parquet"):
                found.setdefault(os.path.relpath(folder, path.removeprefix("file:")), set()).add(name)
    return found


def test_small_files_are_packed_and_large_ones_stay(spark):
    path = scratch_path(spark, "fragments")
    fragments(spark, path)
    before, sizes = files_of(spark, path), {}
    for folder, names in before.items():
        for name in names:
            sizes[name] = os.path.getsize(os.path.join(path.removeprefix("file:"), folder, name))
    read = spark.read.option("mergeSchema", True).parquet
    whole = rows(read(path).select("id", "u", "p", "extra"))
    large = {folder: max(names, key=sizes.get) for folder, names in before.items()}
    assert layout.compact_small(spark, path, 100_000) == 12
    after = files_of(spark, path)
    assert set(after) == set(before) == {"p=00", "p=01"}
    assert all(len(after[folder]) == 2 and large[folder] in after[folder] for folder in after)
    assert rows(read(path).select("id", "u", "p", "extra")) == whole
    assert layout.compact_small(spark, path, 100_000) == 0 and files_of(spark, path) == after


def test_packing_that_died_is_completed_or_dropped(spark, monkeypatch):
    path = scratch_path(spark, "fragments")
    fragments(spark, path)
    read = spark.read.option("mergeSchema", True).parquet
    whole, before = rows(read(path)), files_of(spark, path)

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:  # before the plan stands: nothing has changed
        patch.setattr(layout.session, "rename", die)
        with pytest.raises(RuntimeError):
            layout.compact_small(spark, path, 100_000)
    assert rows(read(path)) == whole
    with monkeypatch.context() as patch:  # while files change places
        patch.setattr(layout.session, "move_files", die)
        with pytest.raises(RuntimeError):
            layout.compact_small(spark, path, 100_000)
    assert layout.compact_small(spark, path, 100_000) == 0
    assert rows(read(path)) == whole and sum(map(len, files_of(spark, path).values())) == 4 < sum(map(len, before.values()))


def test_packing_of_an_empty_folder(spark):
    path = scratch_path(spark, "none")
    spark.range(0).write.parquet(path)
    assert layout.compact_small(spark, path) == 0 and spark.read.parquet(path).count() == 0


def test_types_widen_and_columns_come(spark):
    path = scratch_path(spark, "evolving")
    one = spark.sql("SELECT 1 AS a, CAST(1.5 AS FLOAT) AS f, CAST(1.25 AS DECIMAL(5,2)) AS d, named_struct('x', 1) AS s, array(2) AS l, 7 AS i")
    two = spark.sql("SELECT 1L << 40 AS a, 2.5D AS f, CAST(1.125 AS DECIMAL(9,3)) AS d, named_struct('x', 2L, 'y', 'n') AS s, array(3L) AS l, 0.5D AS i, 'new' AS t")
    for rows_ in (one, two, one):
        layout.append_evolving(rows_, path)
    found = layout.read_evolving(spark, path)
    assert found.schema.simpleString() == "struct<a:bigint,f:double,d:decimal(9,3),s:struct<x:bigint,y:string>,l:array<bigint>,i:double,t:string>"
    old = (1, 1.5, Decimal("1.250"), (1, None), [2], 7.0, None)
    assert rows(found) == sorted([old, old, (1 << 40, 2.5, Decimal("1.125"), (2, "n"), [3], 0.5, "new")], key=repr)
    with pytest.raises(ValueError, match="a: files of bigint and string"):
        layout.append_evolving(spark.sql("SELECT 'x' AS a"), path)
    assert found.count() == 3


def test_evolving_read_opens_no_footer(spark):
    path = scratch_path(spark, "evolving")
    layout.append_evolving(spark.range(3), path)
    with open(f"{path.removeprefix('file:')}/torn.parquet", "w") as torn:
        torn.write("no footer")
    assert layout.read_evolving(spark, path).columns == ["id"]


def test_partition_filter_prunes(spark):
    path = scratch_path(spark, "pruned")
    layout.write_partitioned(spark.range(10).withColumn("p", F.col("id") % 2), path, ["p"])
    text = plan(spark.read.parquet(path).filter("p = 1"))
    assert "PartitionFilters: [isnotnull(p" in text


def test_zorder_narrows_files_on_every_column(spark):
    source, target = scratch_path(spark, "flat"), scratch_path(spark, "z")
    df = spark.range(20000).select(
        F.expr("pmod(hash(id), 1000)").alias("a"), F.expr("pmod(hash(id, 1), 1000)").alias("b")
    )
    df.repartition(4).write.parquet(source)
    size = quality.table_stats(spark, source).first()["bytes"]
    layout.zorder(spark, source, target, ["a", "b"], file_bytes=size // 16)
    spans = spark.read.parquet(target).groupBy("_metadata.file_path").agg(
        (F.max("a") - F.min("a")).alias("a"), (F.max("b") - F.min("b")).alias("b")
    )
    found = spans.agg(F.count("a"), F.avg("a"), F.avg("b")).first()
    assert found[0] >= 12 and found[1] < 600 and found[2] < 600
    assert rows(spark.read.parquet(target)) == rows(df)


def test_zorder_spreads_equal_rows_and_keeps_nulls(spark):
    source, target = scratch_path(spark, "copies"), scratch_path(spark, "zc")
    df = spark.range(8000).select(
        F.lit("same").alias("s"), F.when(F.col("id") < 0, 1.0).alias("n"), F.rand(1).alias("x")
    )
    df.write.parquet(source)
    size = quality.table_stats(spark, source).first()["bytes"]
    layout.zorder(spark, source, target, ["s", "n"], file_bytes=size // 8)
    counts = spark.read.parquet(target).groupBy("_metadata.file_path").count()
    assert counts.agg(F.max("count")).first()[0] < 2500
    assert rows(spark.read.parquet(target)) == rows(spark.read.parquet(source))


def test_hot_partition_value_is_written_by_several_tasks(spark):
    path = scratch_path(spark, "hot")
    df = spark.range(400_000).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 7).otherwise(0).alias("p"), F.uuid().alias("text")
    )
    threshold = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(threshold, "1m")
    try:
        layout.write_partitioned(stage(df.repartition(8)), path, ["p"])
    finally:
        spark.conf.unset(threshold)
    assert len([f for f in os.listdir(f"{path.removeprefix('file:')}/p=0") if f.endswith(".parquet")]) > 3
    assert spark.read.parquet(path).count() == 400_000


def test_rows_without_a_mark_enter(spark):
    root = scratch_path(spark, "nulls")
    rows = lambda data: spark.createDataFrame(data, "k int, t int")
    run = lambda data: incremental.load(rows(data), root, "t", "incremental", "t", "k")
    assert run([(1, None)]).mark is None
    assert run([(1, None), (2, None)]).mark is None
    assert run([(1, None), (2, None), (3, 5)]).mark == "5"
    assert run([(4, None), (5, 2)]).mark == "5"
    assert {r.k for r in incremental.current(spark, root, "t").collect()} == {1, 2, 3, 4}


def test_marks_do_not_follow_the_session_zone(spark):
    moments = spark.sql("SELECT timestamp_micros(1710000000123456) AS t")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        marks = set()
        for name in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", name)
            marks.add(incremental.high_mark(moments, "t"))
            assert incremental.rows_after(moments, "t", next(iter(marks)), inclusive=True).count() == 1
            assert incremental.rows_after(moments, "t", next(iter(marks))).count() == 0
        assert marks == {"2024-03-09 16:00:00.123456"}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_partition_merge_lists_touched_folders_only(spark):
    path = scratch_path(spark, "pruned")
    layout.write_partitioned(spark.range(1000).selectExpr("id AS k", "id % 10 AS p", "0 AS v"), path, ["p"])
    touched = spark.createDataFrame([(3,), (None,)], "p bigint")
    old = upsert.folders_in(spark.read.parquet(path), touched, ["p"])
    assert old.count() == 100 and len(old.select("_metadata.file_path").distinct().collect()) == 1
    plan = old._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_dedup_of_nested_columns(spark):
    rows = spark.sql("SELECT 1 AS k, struct(map('a', v) AS m) AS s, array(map(1, v)) AS a, v FROM VALUES (2), (1) AS t(v)")
    assert clean.dedup_latest(rows, ["k"], ["v"]).collect()[0].v == 2
    assert clean.dedup_latest(rows.drop("v"), ["k"]).count() == 1


def test_top_k_beyond_the_group_limit(spark):
    rows = spark.range(5000).selectExpr("id", "id % 2 AS g")
    for per_task in (None, 600):
        got = windows.top_k(rows, [F.desc("id")], 1500, ["g"], per_task)
        assert sorted(r.id for r in got.collect()) == list(range(2000, 5000))
    assert sorted(r.id for r in windows.top_k(rows, [F.desc("id")], 1200, None, 600).collect()) == list(range(3800, 5000))


def test_upsert_with_absent_columns_and_repeated_keys(spark):
    old = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (None, "n", 0)], "k int, x string, y int")
    new = spark.createDataFrame([(1, "c")] * 3 + [(3, "d"), (None, "m")], "k int, x string")
    got = sorted(map(tuple, upsert.merge_frames(old, new, "k").collect()), key=str)
    assert got == sorted([(1, "c", 10), (2, "b", 20), (None, "n", 0), (3, "d", None), (None, "m", None)], key=str)


def test_zorder_tells_prefixed_strings_apart(spark):
    source, target = scratch_path(spark, "prefixed"), scratch_path(spark, "zp")
    df = spark.range(8000).selectExpr("format_string('Customer#%09d', pmod(hash(id), 1000)) AS s", "pmod(hash(id, 1), 1000) AS n")
    df.repartition(4).write.parquet(source)
    size = quality.table_stats(spark, source).first()["bytes"]
    layout.zorder(spark, source, target, ["s", "n"], file_bytes=size // 16)
    spans = spark.read.parquet(target).groupBy("_metadata.file_path").agg(
        (F.substring(F.max("s"), 10, 9).cast("int") - F.substring(F.min("s"), 10, 9).cast("int")).alias("s"),
        (F.max("n") - F.min("n")).alias("n"),
    )
    found = spans.agg(F.count("s"), F.avg("s"), F.avg("n")).first()
    assert found[0] >= 12 and found[1] < 600 and found[2] < 600
    assert rows(spark.read.parquet(target)) == rows(df)


def test_text_bounds_follow_the_rows(spark):
    df = spark.range(1000).selectExpr("CASE WHEN id < 500 THEN 'hot' WHEN id < 990 THEN format_string('k%04d', id) END AS s")
    bounds = layout._text_bounds(df, "s", 10)
    values = sorted(row.s for row in df.collect() if row.s is not None)
    ends = {values[-(-len(values) * i // 10) - 1] for i in range(1, 10)}
    assert bounds == sorted(ends) and bounds[0] == "hot"
    assert layout._text_bounds(df.filter("s IS NULL"), "s", 10) == []


def test_one_odd_key_leaves_string_order_intact(spark):
    source, target = scratch_path(spark, "odd"), scratch_path(spark, "zo")
    one = "format_string('%s#%09d', if(id % 2 = 0, 'Customer', 'Supplier'), pmod(hash(id), 1000))"
    df = spark.range(8000).selectExpr(f"if(id = 0, 'X1', {one}) AS s", "if(id = 0, 'Y1', format_string('Part#%09d', pmod(hash(id, 1), 1000))) AS t")
    df.repartition(4).write.parquet(source)
    size = quality.table_stats(spark, source).first()["bytes"]
    layout.zorder(spark, source, target, ["s", "t"], file_bytes=size // 16)
    written = spark.read.parquet(target)
    for column in ("s", "t"):
        ranges = written.groupBy("_metadata.file_path").agg(F.min(column), F.max(column)).collect()
        values = [row[0] for row in df.select(column).collect()]
        opened = sum(low <= value <= high for value in values for _, low, high in ranges)
        assert len(ranges) >= 12 and opened / len(values) / len(ranges) < 0.45
    assert rows(written) == rows(df)


def test_zorder_of_too_many_columns_says_so(spark):
    many = spark.range(3).select(*[F.col("id").alias(f"c{i}") for i in range(20)])
    assert layout.with_z_value(many, many.columns, "z", 3).select("z").distinct().count() > 1
    with pytest.raises(ValueError, match="do not fit"):
        layout.with_z_value(many, many.columns, "z", 5)


def test_rewrites_keep_folders(spark):
    source = scratch_path(spark, "folders")
    df = spark.range(2000).selectExpr("id", "id % 50 AS b", "id % 4 AS p")
    layout.write_partitioned(df, source, ["p"])
    for name, rewrite in (("c", layout.compact), ("z", lambda *a, **k: layout.zorder(*a, ["id", "b"], **k))):
        target = scratch_path(spark, name)
        rewrite(spark, source, target, partition_by=["p"])
        back = spark.read.parquet(target)
        assert sorted(map(tuple, back.select("id", "b", "p").collect())) == sorted(map(tuple, df.collect()))
        assert "PartitionFilters: [isnotnull(p" in plan(back.filter("p = 1"))


# --- merges that survive a lost driver, named and optimised tables ---


def test_half_merged_folders_lose_nothing(spark, monkeypatch):
    root = scratch_path(spark, "crash")
    schema = "k int, t timestamp, p string"
    at = lambda day: DAY + dt.timedelta(days=day)
    run = lambda data: incremental.load(
        spark.createDataFrame(data, schema), root, "t", "incremental", "t", "k", partition_by=["p"]
    )
    run([(1, at(1), "a"), (2, at(1), "a"), (3, at(1), "b"), (4, at(1), "c")])

    def dies(spark, path, prepared):
        local = path.removeprefix("file:")
        for name in os.listdir(f"{local}/p=a"):  # an overwrite deletes a folder before its rows come
            os.remove(f"{local}/p=a/{name}")
        raise RuntimeError("the driver is lost")

    delta = [(1, at(2), "b"), (4, at(2), "d"), (5, at(2), "a")]
    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(incremental, "apply_merge", dies)
        run(delta)
    want = [(1, "b"), (2, "a"), (3, "b"), (4, "d"), (5, "a")]
    seen = lambda: rows(incremental.current(spark, root, "t").select("k", "p"))
    assert seen() == want
    state = run([(1, at(1), "old")])
    assert state.pending is None and state.seq == 2 and seen() == want
    run([(6, at(3), "b")])
    assert seen() == [*want, (6, "b")]
    local = f"{root}/t".removeprefix("file:")
    assert not [name for name in os.listdir(local) if name.startswith("pending")]
    assert not os.path.exists(f"{local}/snapshot-000001/p=c")


def test_configured_folders_are_left_out_again(spark):
    root = scratch_path(spark, "configured")
    schema = "order_id int, order_date timestamp, v string"
    first = spark.createDataFrame([(1, DAY, "a"), (2, None, "b")], schema)
    incremental.load_configured(first.limit(0), root, "orders")
    assert incremental.loaded(spark, root, "orders").columns == first.columns
    incremental.load_configured(first, root, "orders")
    incremental.load_configured(spark.createDataFrame([(2, DAY + dt.timedelta(days=40), "B")], schema), root, "orders")
    assert [(r[0], r[2]) for r in rows(incremental.loaded(spark, root, "orders"))] == [(1, "a"), (2, "B")]


def test_named_table_takes_new_columns(spark):
    root = scratch_path(spark, "named")
    incremental.upsert_table(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), root, "named_unit.t", "k")
    incremental.upsert_table(spark.createDataFrame([(2, 7)], "k int, extra int"), root, "named_unit.t", "k")
    assert rows(spark.read.table("named_unit.t").select("k", "v", "extra")) == [(1, "a", None), (2, "b", 7)]


def test_optimised_table_keeps_folders_and_pruning(spark):
    root = scratch_path(spark, "optimised")
    data = spark.range(4000).selectExpr("id", "id % 97 AS other", "concat('0', id % 4) AS p")
    tables.save_table(data, "optimised_unit", ["p"])
    for _ in range(2):
        layout.optimise_table(spark, "optimised_unit", ["id", "other", "p"], root, file_bytes=4096)
    table = spark.read.table("optimised_unit")
    assert table.exceptAll(data).count() == 0 and table.count() == 4000
    assert dict(table.dtypes)["p"] == "string" and tables.folders_of(spark, "optimised_unit") == ["p"]
    one = table.filter("p = '02'")
    assert "PartitionFilters: [isnotnull(p" in plan(one) and one.count() == 1000
    assert len(spark.sql("SHOW PARTITIONS optimised_unit").collect()) == 4
    spark.sql("ALTER TABLE optimised_unit RENAME TO optimised_unit__next")  # where a lost driver may leave it
    layout.optimise_table(spark, "optimised_unit", [], root)
    assert spark.read.table("optimised_unit").count() == 4000
    tables.save_table(data.limit(5), "optimised_unit", ["p"])
    assert spark.read.table("optimised_unit").count() == 5


def test_ties_do_not_depend_on_layout(spark):
    rows = [(i % 3, i % 4, f"v{i:04}") for i in range(600)]
    one = spark.createDataFrame(rows, "g int, o int, v string").repartition(1)
    other = spark.createDataFrame(rows[::-1], "g int, o int, v string").repartition(7)
    for k in (5, windows.GROUP_LIMIT + 1):
        for keys in (None, ["g"]):
            found = [sorted(tuple(r) for r in windows.top_k(d, [F.desc("o")], k, keys).collect()) for d in (one, other)]
            assert found[0] == found[1]
    first = [sorted(tuple(r) for r in windows.top_k(one, [F.desc("o")], 40, ["g"]).collect())]
    last = windows.top_k(one, [F.desc("o")], windows.GROUP_LIMIT + 1, ["g"], rows_per_task=50)
    assert set(first[0]) <= {tuple(r) for r in last.collect()}
    found = []
    for df in (one, other):
        for bound in (None, 40):  # plain, and in slices
            made = windows.previous_within(df, ["g"], ["o"], "v", "p", rows_per_task=bound)
            found.append(sorted((tuple(r) for r in made.collect()), key=repr))
    assert all(f == found[0] for f in found)


def test_fine_totals_whatever_the_order(spark):
    def sums(df):
        return tuple(df.agg(money.total(F.col("v")), money.mean(F.col("v"))).first())

    many = spark.range(1_000_000)
    assert sums(many.select(F.lit(4e-7).alias("v"))) == (0.4, 0.0)
    assert sums(many.select(F.lit(2000000.0000004).alias("v")))[0] == 2000000000000.4
    assert sums(spark.range(10).select(F.lit(-0.00049999).alias("v")))[0] == 0.0
    mixed = [0.005, -0.0049999, 1e-9, 1e6 + 4e-7, 1e15, -1e15, 12.345, -7.1, None, float("nan"), float("inf")]
    df = spark.createDataFrame([(x,) for x in mixed * 50], "v double")
    exact = sum(Decimal(repr(x)) for x in mixed * 50 if x is not None and abs(x) < float("inf"))
    want = float(exact.quantize(Decimal("0.01"), ROUND_HALF_UP))
    for parts in (1, 3, 8):
        assert sums(df.repartition(parts))[0] == want


def test_malformed_lines_are_set_apart(spark, tmp_path):
    schema = spark.createDataFrame([], "a long, b double, c string").schema
    (tmp_path / "json").mkdir()
    (tmp_path / "json" / "x.json").write_text('{"a": 1, "b": 2.5, "c": "x"}\n{"a": 2}\n{"a": "no"}\n{"a": 3, \n[1\n{"a": 4, "c": null}\n')
    good, bad = files.split_malformed(spark, str(tmp_path / "json"), schema, "json")
    assert good.columns == ["a", "b", "c"] and sorted(r.a for r in good.collect()) == [1, 2, 4]
    assert sorted((r.record, r.reason) for r in bad.collect()) == [
        ("[1", "not JSON"), ('{"a": "no"}', "a value of the wrong type"), ('{"a": 3, ', "not JSON"),
    ]
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "x.csv").write_text("1|2.5|x\n2|dear|y\n3|1.0\n4|1|z|more\n5||\n")
    good, bad = files.split_malformed(spark, str(tmp_path / "csv"), schema, "csv", "|")
    assert sorted(r.a for r in good.collect()) == [1, 5]
    assert sorted((r.record, r.reason) for r in bad.collect()) == [
        ("2|dear|y", "a value of the wrong type"), ("3|1.0", "another number of fields"), ("4|1|z|more", "another number of fields"),
    ]
    assert all(r.file.endswith("x.csv") for r in bad.collect())


def test_top_k_deals_too_large_groups_out(spark, monkeypatch):
    monkeypatch.setattr(windows, "slice_groups", None)  # whole groups are not sliced for their first rows
    numbers = [(i // 4, int(i % 10 == 0)) for i in range(20000)]  # equal rows, and one group beyond the bound
    df = spark.range(20000).selectExpr("id div 4 AS v", "int(id % 10 = 0) AS g")
    got = sorted((r.g, r.v) for r in windows.top_k(df, [F.desc("v")], 1001, ["g"], 8000).collect())
    assert got == sorted((g, v) for g in (0, 1) for v in sorted(v for v, of in numbers if of == g)[-1001:])
    nulls = df.selectExpr("if(v % 7 = 0, null, v) AS v", "if(g = 0, null, g) AS g")
    found = windows.top_k(nulls, [F.asc("v")], 1001, ["g"], 8000)
    assert found.count() == 2002
    assert found.filter("v is null and g = 1").count() == sum(v % 7 == 0 and g == 1 for v, g in numbers)
    assert found.filter("v is null and g is null").count() == 1001


@pytest.mark.parametrize("name", ["rank_by_price", "rank_in_category"])
def test_ranked_lines_are_joined_once(spark, monkeypatch, tmp_path, name):
    parts = [(1, "p", "ECONOMY", 10), (None, "q", "PROMO", 20)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_type string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    lines = "l_orderkey long, l_partkey long, l_extendedprice double, l_quantity double, l_shipdate timestamp_ntz"
    spark.createDataFrame([(1, 1, 2.0, 1.0, None), (2, None, 3.0, 1.0, None)], lines).write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(windows, "dense_rank_within", lambda df, *_, **__: df)  # what it measures, it reads again
    made = queries.QUERIES[name](spark, str(tmp_path))
    assert "Join" not in plan(made) and [r.order_id for r in made.collect()] == [1]


def test_large_files_of_more_orders_are_more():
    for size in (1, 10_000, 1_300_000, 77_000_000, 500_000_000):
        large, larges, smalls = queries._fragments(size)
        assert large <= queries.LARGE_FILE and size * 4 // 25 // larges <= 2 * queries.LARGE_FILE
        assert size * 4 / 25 / larges >= 0.75 * large and size / 25 / smalls <= max(1, large / 6)


def test_ranked_values_that_repeat_are_hashed(spark, monkeypatch):
    monkeypatch.setattr(windows.settings, "BROADCAST_BYTES", 0)
    df = spark.range(4000).selectExpr("if(id % 40 = 0, null, id % 40) AS v", "if(id % 3 = 0, null, id % 3) AS g")
    ranked = windows.dense_rank_within(df, ["g"], "v", "r")
    assert "ShuffledHashJoin" in plan(ranked) and "SortMergeJoin" not in plan(ranked)
    assert rows(ranked) == rows(windows.dense_rank_within(df, ["g"], "v", "r", rows_per_task=None))


def test_a_merge_computes_the_new_rows_once(spark, tmp_path):
    table, prepared = f"{tmp_path}/table", f"{tmp_path}/prepared"
    spark.range(5).selectExpr("id AS k", "'a' AS folder").write.partitionBy("folder").parquet(table)
    drawn = F.udf(lambda: os.urandom(8).hex()).asNondeterministic()
    new = spark.range(3, 8).select(F.col("id").alias("k"), drawn().alias("folder"))
    upsert.prepare_merge(spark, table, new, "k", ["folder"], None, prepared)
    touched, held = ({row.folder for row in spark.read.parquet(f"{prepared}/{part}").collect()} for part in ("touched", "rows"))
    assert touched == held and len(held) == 6


def test_a_later_load_computes_its_source_once(spark, tmp_path):
    drawn = F.udf(lambda: int.from_bytes(os.urandom(6)), "long").asNondeterministic()
    marked = lambda mark: spark.range(4).select(F.col("id").alias("k"), mark.alias("t"))
    for mark in (F.lit(-1).cast("long"), drawn()):
        incremental.load(marked(mark), str(tmp_path), "t", "incremental", "t", "k")
    most = incremental.current(spark, str(tmp_path), "t").agg(F.max("t")).first()[0]
    assert incremental.read_mark(spark, str(tmp_path), "t") == str(most)
