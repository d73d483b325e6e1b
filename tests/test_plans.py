"""Layers on the small input tables the model is described with."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tierline.operators import layout
from tierline.plans import bronze, gold, layers, silver
from tierline.session import scratch_path, stage
from tierline.settings import Run
from tierline.sources import files, jdbc, tables

RUN = Run(as_of=dt.date(2024, 6, 1), ts=dt.datetime(2024, 6, 1, tzinfo=dt.timezone.utc))

# The sample products and customers.
PRODUCTS = [
    (1, "Wireless Mouse", "Electronics", 29.99, 150, "SUP001", "IN", "2024-01-15"),
    (2, "USB-C Hub", "Electronics", 49.99, 80, "SUP001", "IN", "2024-01-16"),
    (3, "Running Shoes", "Footwear", 89.99, 200, "SUP002", "CN", "2024-01-17"),
    (4, "Yoga Mat", "Sports", 25.00, 300, "SUP003", "US", "2024-01-18"),
    (5, "Coffee Maker", "Kitchen", 75.50, 60, "SUP004", "DE", "2024-01-19"),
]
CUSTOMERS = [
    (1, "Ilka", "Tavor", "ilka@post.example", "5550100001", "Nordhafen", "IN", "2024-01-01", "2024-01-10", 1),
    (2, "Benno", "Quist", "benno@post.example", "5550100002", "Südstadt", "IN", "2024-01-02", "2024-01-11", 1),
    (3, "Mara", "Lund", "mara@post.example", "5550100003", "Eastbay", "US", "2024-01-03", "2024-01-12", 1),
]
CUSTOMER_SCHEMA = (
    "customer_id bigint, first_name string, last_name string, email string, phone string, city string, "
    "country string, signup_date string, updated_at string, is_active bigint"
)
ORDERS = [
    (1, 1, "Mouse ", " Electronics", 29.99, 4.5, 10, dt.datetime(2024, 1, 6), " Web"),
    (2, 1, "Mouse", "electronics", 19.99, 4.0, 12, dt.datetime(2024, 2, 1), "web"),
    (3, 2, "Hub", "electronics", 50.0, 3.9, 5, dt.datetime(2024, 2, 1), "web"),
    (4, 3, "Shoes", "footwear", 0.0, 5.0, 1, dt.datetime(2024, 2, 1), "web"),
    (5, None, "Nothing", "footwear", 10.0, 5.0, 1, dt.datetime(2024, 2, 1), "web"),
    (6, 9, "Unlisted", "toys", 20.0, None, 1, dt.datetime(2024, 2, 4), "web"),
]
ORDER_SCHEMA = (
    "order_id int, product_id int, product_name string, category string, price double, rating_rate double, "
    "rating_count int, order_date timestamp, source string"
)


@pytest.fixture(scope="module")
def raw(spark):
    return {
        "orders": files.literal_rows(spark, ORDERS, ORDER_SCHEMA),
        "products": files.literal_rows(spark, PRODUCTS, bronze.PRODUCT_SCHEMA),
        "customers": bronze.customers_from_table(files.literal_rows(spark, CUSTOMERS, CUSTOMER_SCHEMA), RUN),
    }


@pytest.fixture(scope="module")
def made(spark, raw):
    dates = gold.dim_date(spark, run=RUN)
    return layers.build(**raw, dates=dates, run=RUN, keep=lambda name, df: stage(df, name))


def test_products(made):
    columns = [
        "product_id", "category", "stock_status", "price_with_tax", "category_group", "inventory_value",
        "price_tier", "is_domestic_supplier", "inventory_rank",
    ]
    found = made["silver_products_transformed"].select(*columns).orderBy("product_id").collect()
    assert [tuple(r) for r in found] == [
        (1, "electronics", "in_stock", 35.3882, "Electronics", 4498.50, "Mid-Range", True, 1),
        (2, "electronics", "in_stock", 58.9882, "Electronics", 3999.20, "Mid-Range", True, 2),
        (3, "footwear", "in_stock", 106.1882, "Footwear", 17998.00, "Premium", False, 1),
        (4, "sports", "in_stock", 29.50, "Sports & Fitness", 7500.00, "Mid-Range", False, 1),
        (5, "kitchen", "in_stock", 89.09, "Kitchen", 4530.00, "Premium", False, 1),
    ]


def test_customers(made):
    columns = ["customer_id", "region", "seniority_rank", "tenure_days", "tenure_bucket", "full_name", "is_active"]
    found = made["silver_customers_transformed"].select(*columns).orderBy("customer_id").collect()
    assert [tuple(r) for r in found] == [
        (1, "Asia", 1, 152, "Regular", "Ilka Tavor", True),
        (2, "Asia", 2, 151, "Regular", "Benno Quist", True),
        (3, "North America", 1, 150, "Regular", "Mara Lund", True),
    ]


def test_orders(made):
    columns = [
        "order_id", "product_name", "category", "source", "price_bucket", "is_highly_rated", "revenue_with_tax",
        "rank_in_category", "prev_price", "price_change", "order_weekday", "is_weekend",
    ]
    found = made["silver_orders_transformed"].select(*columns).orderBy("order_id").collect()
    assert [tuple(r) for r in found] == [
        (1, "Mouse", "electronics", "web", "medium", True, 35.39, 1, None, 0.0, 7, True),
        (2, "Mouse", "electronics", "web", "low", True, 23.59, 2, 29.99, -10.0, 5, False),
        (3, "Hub", "electronics", "web", "high", False, 59.0, 3, None, 0.0, 5, False),
        (6, "Unlisted", "toys", "web", "medium", False, 23.6, 1, None, 0.0, 1, True),
    ]


def test_column_counts(made):
    counts = {name: len(df.columns) for name, df in made.items()}
    # inputs here carry no bronze audit columns, apart from the customers' two
    assert counts == {
        "silver_orders": 16, "silver_products": 15, "silver_customers": 19, "silver_orders_transformed": 28,
        "silver_products_transformed": 21, "silver_customers_transformed": 25, "dim_product": 18,
        "dim_customer": 20, "dim_date": 12, "fact_orders": 25, "agg_sales_by_category": 16,
        "agg_sales_by_date": 13, "agg_top_products": 13,
    }


def test_date_dimension(made):
    seasons = {r[0]: r[1] for r in made["dim_date"].groupBy("season").count().collect()}
    assert seasons == {"Winter": 271, "Spring": 276, "Summer": 276, "Autumn": 273}
    assert made["dim_date"].filter("is_weekend").count() == 312


def test_marts(made):
    top = made["agg_top_products"].orderBy(F.desc("total_revenue")).collect()
    assert [(r["product_id"], r["total_revenue"], r["total_orders"], r["price_tier"]) for r in top] == [
        (2, 50.0, 1, "Mid-Range"), (1, 49.98, 2, "Mid-Range"), (9, 20.0, 1, None),
    ]
    february = made["agg_sales_by_category"].filter("order_month = 2 and category = 'electronics'").first()
    assert (february["total_revenue"], february["avg_price"], february["unique_products"]) == (69.99, 35.0, 2)
    assert (february["max_price"], february["min_price"], february["avg_rating"]) == (50.0, 19.99, 3.95)
    day = made["agg_sales_by_date"].filter("order_day = 4").first()
    assert (day["is_weekend"], day["daily_revenue"], day["avg_order_value"]) == (True, 20.0, 20.0)


def test_mart_keeps_null_groups(spark, made):
    fact = made["fact_orders"].withColumn("category", F.lit(None).cast("string"))
    found = gold.sales_by_category(fact, RUN).orderBy("order_month").collect()
    assert [(r["category"], r["total_orders"], r["unique_products"]) for r in found] == [(None, 1, 1), (None, 3, 3)]
    estimated = gold.sales_by_category(fact, RUN, estimate_distinct=True)
    assert estimated.select(*gold.sales_by_category(fact, RUN).columns).exceptAll(
        gold.sales_by_category(fact, RUN)
    ).isEmpty()


def test_surrogate_modes(made):
    fact = made["fact_orders"]
    assert fact.agg(F.countDistinct("order_sk")).first()[0] == fact.count()
    numbered = gold.fact_orders(made["silver_orders_transformed"], RUN, key_mode="monotonic")
    assert dict(numbered.dtypes)["order_sk"] == "bigint"


def test_validation_order(spark):
    """A later invalid row displaces a valid one unless rows are validated first."""
    good = (1, 1, "x", "c", 10.0, 4.0, 1, dt.datetime(2024, 1, 1), "web")
    bad = (1, 1, "x", "c", -1.0, 4.0, 1, dt.datetime(2024, 1, 2), "web")
    df = files.literal_rows(spark, [good, bad], ORDER_SCHEMA)
    assert silver.clean_orders(df, RUN).count() == 0
    assert silver.clean_orders(df, Run(validate_first=True)).count() == 1


def test_validate_first_reaches_the_scan(spark):
    path = scratch_path(spark, "bronze")
    files.literal_rows(spark, ORDERS, ORDER_SCHEMA).write.parquet(path)
    cleaned = silver.clean_orders(spark.read.parquet(path), Run(validate_first=True))
    pushed = cleaned._jdf.queryExecution().toString().split("PushedFilters: [")[1]
    assert "GreaterThan(price,0.0)" in pushed


def test_rerun_gives_the_same_rows(spark, raw, made):
    again = layers.build(**raw, dates=made["dim_date"], run=RUN)
    for name in ("silver_orders_transformed", "dim_product", "fact_orders", "agg_top_products"):
        assert again[name].exceptAll(made[name]).count() == 0


def test_empty_inputs(spark, raw):
    empty = {name: df.limit(0) for name, df in raw.items()}
    built = layers.build(**empty, dates=gold.dim_date(spark, run=RUN), run=RUN)
    assert built["agg_sales_by_category"].count() == 0 and built["dim_customer"].count() == 0


def test_tables_are_written_and_counted(spark, raw):
    run = Run(as_of=RUN.as_of, ts=RUN.ts, env="unit")
    for _ in range(2):
        counts = layers.build_tables(spark, **raw, dates=gold.dim_date(spark, run=run), run=run)
    assert counts["ecommerce_bronze_unit.bronze_orders"] == 6
    assert counts["ecommerce_silver_unit.silver_orders_transformed"] == 4
    assert counts["ecommerce_gold_unit.dim_date"] == 1096
    assert tables.exists(spark, "ecommerce_gold_unit.fact_orders")
    assert not tables.exists(spark, "ecommerce_gold_unit.nothing")
    partitions = spark.sql("SHOW PARTITIONS ecommerce_silver_unit.silver_orders_transformed").collect()
    assert sorted(r[0] for r in partitions) == [
        "order_year=2024/order_month=1",
        "order_year=2024/order_month=2",
    ]


def test_star_joins_three_dimensions(spark, made):
    fact = made["fact_orders"].withColumn("customer_id", F.lit(3).cast("bigint"))
    joined = gold.star(fact, made["dim_date"], made["dim_customer"], made["dim_product"])
    row = joined.filter("order_id = 1").first()
    assert (row["season"], row["region"], row["product_category"], row["price_tier"]) == (
        "Winter", "North America", "electronics", "Mid-Range",
    )
    assert joined.count() == fact.count()


def scans(plan):
    """The file scans of an executed plan."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return scans(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return scans(plan.plan())
    found = [plan] if kind == "FileSourceScanExec" else []
    children = plan.children()
    return found + [scan for i in range(children.size()) for scan in scans(children.apply(i))]


def quarter_star(spark, folders):
    """Sales of 24 months in folders, and the winter days of 2024 over them."""
    path, days = scratch_path(spark, "fact"), scratch_path(spark, "days")
    fact = spark.range(731).select(
        F.col("id").alias("order_id"), F.when(F.col("id") < 730, F.expr("timestamp_ntz '2023-01-01' + make_dt_interval(id)")).alias("order_date")
    )
    fact = fact.withColumns({"order_year": F.year("order_date"), "order_month": F.month("order_date")})
    layout.write_partitioned(fact, path, ["order_year", "order_month"])
    gold.dim_date(spark, dt.date(2023, 1, 1), dt.date(2025, 12, 31), RUN).write.parquet(days)
    stored = spark.read.parquet(path)
    joined = gold.star(stored, spark.read.parquet(days), folders=folders)
    assert joined.count() == 731 and joined.filter("season IS NULL").count() == 1
    winter = joined.filter("season = 'Winter' AND year = 2024")
    want = [i for i in range(730) if (d := dt.date(2023, 1, 1) + dt.timedelta(i)).year == 2024 and d.month in (12, 1, 2)]
    assert sorted(r.order_id for r in winter.collect()) == want
    facts = [s for s in scans(winter._jdf.queryExecution().executedPlan()) if "order_month" in s.toString()]
    assert len(facts) == 1
    return facts[0]


def test_star_reads_only_the_folders_of_a_quarter(spark):
    scan = quarter_star(spark, gold.DATE_FOLDERS)
    assert "dynamicpruning" in scan.toString()
    assert scan.metrics().apply("numPartitions").value() == 3  # January, February and December
    everything = quarter_star(spark, None)
    assert "dynamicpruning" not in everything.toString()
    assert everything.metrics().apply("numPartitions").value() == 25


def test_star_filters_reach_a_large_fact(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold")
    fact, dim = scratch_path(spark, "fact"), scratch_path(spark, "products")
    spark.range(5000).selectExpr("id AS order_id", "id % 100 AS product_id", "date'2024-01-01' AS order_date").write.parquet(fact)
    spark.range(100).selectExpr("id AS product_id", "concat('g', id % 10) AS category_group").write.parquet(dim)
    try:
        for key, value in zip(keys, ("-1", "-1", "0")):
            spark.conf.set(key, value)
        joined = gold.star(spark.read.parquet(fact), product_dim=spark.read.parquet(dim)).filter("category_group = 'g3'")
        assert "might_contain" in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 500
    finally:
        for key in keys:
            spark.conf.unset(key)


def test_json_orders_take_defaults(spark):
    path = scratch_path(spark, "json")
    lines = [
        '{"id": 1, "title": "A", "category": "c", "price": 9.5, "rating": {"rate": 4.1, "count": 7}}',
        '{"id": 2}',
        '{"id": 3, "title": null, "price": null, "rating": null}',
        '{"id": "x", "price": 1.0}',
    ]
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    found = bronze.orders_from_json(spark, path, RUN).orderBy("order_id").collect()
    assert [tuple(r)[:7] for r in found] == [
        (None, None, "", "", 1.0, 0.0, 0),
        (1, 1, "A", "c", 9.5, 4.1, 7),
        (2, 2, "", "", 0.0, 0.0, 0),
        (3, 3, "", "", 0.0, 0.0, 0),
    ]
    assert len(found[0]) == 11


def test_csv_encoding_and_malformed_numbers(spark):
    path = scratch_path(spark, "csv")
    lines = ["product_id|product_name|category|price|stock_qty|supplier_id|country|updated_at"]
    lines += ["1|Café|Kitchen|5.5|3|S1|IN|2024-01-01", "2|Tea|Kitchen|dear|3|S1|IN|2024-01-01"]
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.option(
        "encoding", "iso-8859-1"
    ).csv(path, sep="\x01", quote="")
    found = bronze.products_from_csv(spark, path, RUN, sep="|", encoding="iso-8859-1").orderBy("product_id")
    assert [(r["product_name"], r["price"]) for r in found.collect()] == [("Café", 5.5), ("Tea", None)]
    assert found.columns[-2:] == ["_ingest_ts", "_source"]


def test_jdbc_options():
    options = jdbc.partition_options("jdbc:x:y", "customers", "customer_id", 1, 1000, 8)
    assert options["partitionColumn"] == "customer_id" and options["numPartitions"] == "8"
    assert (options["lowerBound"], options["upperBound"]) == ("1", "1000")


def test_raw_tables_load_by_mode_and_silver_is_optimised(spark, raw):
    run = Run(as_of=RUN.as_of, ts=RUN.ts, env="modes")
    root = scratch_path(spark, "layers")
    build = lambda **changed: layers.build_tables(
        spark, **{**raw, **changed}, dates=gold.dim_date(spark, run=run), run=run, root=root
    )
    build()
    later = raw["orders"].filter("order_id = 6").withColumns(
        {"order_id": F.lit(7), "order_date": F.lit(dt.datetime(2024, 3, 1))}
    )
    counts = build(orders=later, products=raw["products"].limit(2))
    assert counts["ecommerce_bronze_modes.bronze_orders"] == 7
    assert counts["ecommerce_bronze_modes.bronze_products"] == 2
    assert counts["ecommerce_silver_modes.silver_orders_transformed"] == 5
    assert spark.read.table("ecommerce_bronze_modes.bronze_customers").columns == raw["customers"].columns
    before = spark.read.table("ecommerce_silver_modes.silver_orders_transformed").collect()
    stats = layers.optimise_tables(spark, f"{root}/optimised", run)
    assert stats["ecommerce_silver_modes.silver_orders_transformed"]["rows"] == 5
    assert len(stats) == 3
    after = spark.read.table("ecommerce_silver_modes.silver_orders_transformed").collect()
    assert sorted(map(str, before)) == sorted(map(str, after))
