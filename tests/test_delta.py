"""Following a delivery against a full rebuild, and what it leaves alone."""

import datetime as dt
import os

from pyspark.sql import functions as F

from tierline.operators import incremental
from tierline.plans import delta, gold, silver
from tierline.registry.inputs import RUN

SCHEMA = (
    "order_id long, product_id long, product_name string, category string, price double, rating_rate double, "
    "rating_count int, order_date timestamp, source string"
)


def raw(spark, rows):
    return spark.createDataFrame(
        [(i, p, " n", c, price, rate, 1, day and dt.datetime(2024, *day), "web") for i, p, c, price, rate, day in rows], SCHEMA
    )


def business(df):
    names = [c for c in df.columns if not c.startswith("_")]
    return sorted((tuple(r) for r in df.select(*sorted(names)).collect()), key=repr)


def files(root):
    folder = f"{root}/{delta.ORDERS}"
    return {
        os.path.join(at, f).split("snapshot-000001/")[1]: os.stat(os.path.join(at, f)).st_mtime_ns
        for at, _, found in os.walk(folder) if "snapshot-000001/" in at + "/" for f in found if f.startswith("part")
    }


FIRST = [(i, i % 5, "ab"[i % 2], 10.0 + i, float(i % 4), (1 + i % 6, 1 + i % 20)) for i in range(60)] + [
    (100, None, None, 5.0, None, (2, 2)), (101, 9, "c", 5.0, 4.0, None), (102, 8, "c", 7.0, 2.0, (6, 9)),
]
SECOND = [
    (3, 3, "b", 99.0, 3.0, (4, 4)),  # re-priced in its folder, its product's next row changes too
    (12, 7, "a", 8.0, 0.0, (1, 13)),  # to another product
    (17, 2, "b", -1.0, 1.0, (6, 18)),  # no longer valid
    (200, 2, "a", 3.0, 1.5, (4, 9)),  # new, with a rating that moves others' ranks
    (102, 8, "c", 7.0, 2.0, (6, 9)),  # as it was
    (None, 1, "a", 3.0, 1.0, (4, 9)), (101, 9, "c", 6.0, 4.0, None),
]


def test_equals_a_full_rebuild(spark, tmp_path):
    root = str(tmp_path)
    delta.follow_orders(spark, root, raw(spark, FIRST), RUN)
    merged = {r[0]: r for r in FIRST} | {r[0]: r for r in SECOND if r[0] is not None}
    for _ in range(2):  # the second time nothing is new
        delta.follow_orders(spark, root, raw(spark, SECOND), RUN)
        whole = silver.transform_orders(silver.clean_orders(raw(spark, list(merged.values())), RUN), RUN)
        assert business(delta.orders(spark, root)) == business(whole)
        fact = gold.fact_orders(whole, RUN)
        assert business(delta.mart(spark, root, "agg_sales_by_category")) == business(gold.sales_by_category(fact, RUN))
        assert business(delta.mart(spark, root, "agg_sales_by_date")) == business(gold.sales_by_date(fact, RUN))


def test_other_folders_stay(spark, tmp_path):
    root = str(tmp_path)
    delta.follow_orders(spark, root, raw(spark, FIRST), RUN)
    before = files(root)
    # the product's last order, with a rating that exists: no other row changes
    delta.follow_orders(spark, root, raw(spark, [(300, 8, "c", 9.0, 2.0, (6, 20))]), RUN)
    after = files(root)
    touched = {name.rsplit("/", 1)[0] for name in set(before.items()) ^ set(after.items()) for name in [name[0]]}
    assert touched == {"order_year=2024/order_month=6"}
    seen = incremental.read_state(spark, root, delta.ORDERS)
    delta.follow_orders(spark, root, raw(spark, [(300, 8, "c", 9.0, 2.0, (6, 20))]), RUN)
    assert business(delta.orders(spark, root).filter(F.col("order_id") == 300))[0] and seen.seq == 2


def test_a_run_that_dies_before_the_table_is_repeated(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    delta.follow_orders(spark, root, raw(spark, FIRST), RUN)
    with monkeypatch.context() as patch:
        patch.setattr(delta.incremental, "upsert_rows", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        try:
            delta.follow_orders(spark, root, raw(spark, SECOND), RUN)
        except RuntimeError:
            pass
    delta.follow_orders(spark, root, raw(spark, SECOND), RUN)
    merged = {r[0]: r for r in FIRST} | {r[0]: r for r in SECOND if r[0] is not None}
    whole = silver.transform_orders(silver.clean_orders(raw(spark, list(merged.values())), RUN), RUN)
    assert business(delta.orders(spark, root)) == business(whole)
    assert business(delta.mart(spark, root, "agg_sales_by_category")) == business(gold.sales_by_category(gold.fact_orders(whole, RUN), RUN))
