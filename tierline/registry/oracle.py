"""The registered queries as plain SQL, for checking against another engine."""

from __future__ import annotations

from tierline import settings
from tierline.registry import inputs

ORACLES: dict[str, str] = {}


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def _case(column: str, groups: dict[str, list], otherwise: str) -> str:
    branches = " ".join(f"WHEN {column} IN ({_quoted(v)}) THEN '{k}'" for k, v in groups.items())
    return f"CASE {branches} ELSE '{otherwise}' END"


def _bucket(column: str, rule: tuple) -> str:
    bounds, otherwise = rule
    branches = " ".join(f"WHEN {column} < {bound} THEN '{label}'" for bound, label in bounds)
    return f"CASE {branches} ELSE '{otherwise}' END"


def _map(column: str, mapping: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


def _exact(x: str) -> str:
    return f"CAST({x} AS DECIMAL(26,6))"


def _cents(x: str) -> str:
    return f"CAST(round({x}, 2) AS DOUBLE)"


def _total(x: str) -> str:
    return _cents(f"sum({_exact(x)})")


def _mean(x: str) -> str:
    micros = f"sum(CAST(round({x} * 1000000) AS HUGEINT))"
    return f"CAST((200 * {micros} + count({x}) * 1000000) // (2000000 * count({x})) AS DOUBLE) / 100"


WEEKEND = "dayofweek({0}) IN (0, 6)"


def _date_parts(column: str, prefix: str = "") -> str:
    return f"""CAST(year({column}) AS INTEGER) AS {prefix}year, CAST(month({column}) AS INTEGER) AS {prefix}month,
    CAST(day({column}) AS INTEGER) AS {prefix}day, CAST(dayofweek({column}) + 1 AS INTEGER) AS {prefix}weekday,
    {WEEKEND.format(column)} AS is_weekend"""


def _tier_price(extra: int) -> str:
    return f"CAST(CAST(p_retailprice AS DECIMAL(18,2)) - {895 - extra} AS DOUBLE)"


def _delivery(day: str, extra: int) -> str:
    return f"""SELECT p_partkey AS product_id, ' ' || p_name AS product_name,
    {_map("p_type", inputs.RAW_CATEGORIES)} AS category, {_tier_price(extra)} AS price,
    CAST(p_size - 10 + {extra} AS BIGINT) AS stock_qty, lower(p_brand) AS supplier_id,
    {_map("p_type", inputs.SUPPLIER_COUNTRIES)} AS country, '{day}' AS updated_at FROM part"""


AS_OF = "DATE '2001-08-02'"
TAXED = f"{_exact('{0}')} * 1.18"

RAW_ORDERS = f"""raw_orders AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id, p_name AS product_name,
    {_map("p_type", inputs.RAW_CATEGORIES)} AS category, l_extendedprice AS price,
    CAST(p_size AS DOUBLE) / 10 AS rating_rate, CAST(l_quantity AS INTEGER) AS rating_count,
    l_shipdate AS order_date, ' Web ' AS source
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

SALE_LINES = f"""{RAW_ORDERS}, sale_lines AS (
  SELECT order_id, product_id, lower(trim(category)) AS category, price AS unit_price, rating_rate, order_date,
    {_date_parts("order_date", "order_")}, {_cents(_exact("price"))} AS revenue,
    {_cents(TAXED.format("price"))} AS revenue_with_tax
  FROM raw_orders)"""

RAW_PRODUCTS = f"""raw_products AS ({_delivery("2024-01-15", 0)} UNION ALL {_delivery("2024-01-10", 3)})"""

SILVER_PRODUCTS = f"""{RAW_PRODUCTS}, silver_products AS (
  SELECT product_id, trim(product_name) AS product_name, lower(trim(category)) AS category, price,
    greatest(stock_qty, 0) AS stock_qty, upper(trim(supplier_id)) AS supplier_id,
    upper(trim(country)) AS country, updated_at,
    CASE WHEN stock_qty <= 0 THEN 'out_of_stock' WHEN stock_qty < 20 THEN 'low_stock' ELSE 'in_stock' END
      AS stock_status,
    CAST({TAXED.format("price")} AS DOUBLE) AS price_with_tax
  FROM raw_products WHERE price > 0
  QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY updated_at DESC) = 1),
products_transformed AS (
  SELECT *, {_case("category", settings.CATEGORY_GROUPS, "Other")} AS category_group,
    {_cents(_exact("price") + " * stock_qty")} AS inventory_value, {_bucket("price", settings.PRICE_TIERS)} AS price_tier,
    country = 'IN' AS is_domestic_supplier
  FROM silver_products),
products_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY category ORDER BY inventory_value DESC, product_id) AS inventory_rank
  FROM products_transformed)"""

DIM_PRODUCT = f"""{SILVER_PRODUCTS}, dim_product AS (
  SELECT product_id, product_name, category, category_group, price, price_with_tax, price_tier, stock_qty,
    stock_status, inventory_value, supplier_id, country AS supplier_country, is_domestic_supplier
  FROM products_ranked)"""

NATION_CODE = "[" + _quoted(inputs.NATION_CODES) + "][n_nationkey + 1]"

RAW_CUSTOMERS = f"""raw_customers AS (
  SELECT c_custkey AS customer_id, ' ' || split_part(c_name, '#', 1) AS first_name,
    split_part(c_name, '#', 2) AS last_name,
    ' ' || upper(replace(c_name, '#', '@')) || CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE '.COM' END AS email,
    CAST(c_custkey AS VARCHAR) AS phone, n_name || ' ' AS city, {NATION_CODE} AS country,
    signup AS signup_date, signup AS updated_at, CAST(CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS BIGINT) AS is_active
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS signup FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey)"""

SILVER_CUSTOMERS = f"""{RAW_CUSTOMERS}, silver_customers AS (
  SELECT customer_id, trim(first_name) AS first_name, trim(last_name) AS last_name, lower(trim(email)) AS email,
    phone, trim(city) AS city, upper(trim(country)) AS country, signup_date, updated_at,
    coalesce(is_active = 1, false) AS is_active,
    regexp_matches(lower(trim(email)), '{settings.EMAIL_PATTERN}') AS is_valid_email,
    trim(first_name) || ' ' || trim(last_name) AS full_name
  FROM raw_customers),
customers_tenure AS (
  SELECT *, CAST(date_diff('day', CAST(signup_date AS DATE), {AS_OF}) AS INTEGER) AS tenure_days,
    {_case("country", settings.REGIONS, "Other")} AS region, concat_ws(' ', first_name, last_name) AS display_name
  FROM silver_customers),
customers_transformed AS (
  SELECT *, {_bucket("tenure_days", settings.TENURE_BUCKETS)} AS tenure_bucket,
    dense_rank() OVER (PARTITION BY region ORDER BY tenure_days DESC NULLS LAST) AS seniority_rank
  FROM customers_tenure)"""

SILVER_ORDERS = f"""{RAW_ORDERS}, silver_orders AS (
  SELECT order_id, product_id, trim(product_name) AS product_name, lower(trim(category)) AS category, price,
    rating_rate, rating_count, order_date, lower(trim(source)) AS source,
    {_bucket("price", settings.PRICE_BUCKETS)} AS price_bucket, rating_rate >= 4.0 AS is_highly_rated
  FROM (SELECT * FROM raw_orders QUALIFY row_number() OVER (PARTITION BY order_id
    ORDER BY order_date DESC, product_id, product_name, category, price, rating_rate, rating_count, source) = 1)
  WHERE price > 0),
orders_lagged AS (
  SELECT *, {_date_parts("order_date", "order_")}, {_cents(_exact("price"))} AS revenue,
    {_cents(TAXED.format("price"))} AS revenue_with_tax, {_cents(_exact("price"))} AS net_revenue,
    dense_rank() OVER (PARTITION BY category ORDER BY rating_rate DESC) AS rank_in_category,
    lag(price) OVER (PARTITION BY product_id ORDER BY order_date, order_id) AS prev_price
  FROM silver_orders),
orders_transformed AS (
  SELECT *, {_cents(f"{_exact('price')} - {_exact('coalesce(prev_price, price)')}")} AS price_change
  FROM orders_lagged)"""

CALENDAR = f"""days AS (
  SELECT CAST(unnest(generate_series(min(l_shipdate), max(l_shipdate), INTERVAL 1 DAY)) AS DATE) AS full_date
  FROM lineitem),
calendar AS (
  SELECT full_date, {_date_parts("full_date")},
    {_case("CAST(month(full_date) AS INTEGER)", settings.SEASONS, settings.LAST_SEASON)} AS season FROM days)"""

LATER = """later AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
    CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
    CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 400 DAY ELSE o_orderdate END AS o_orderdate,
    o_orderpriority FROM orders)"""
BASE = "base AS (SELECT * FROM orders WHERE o_orderdate <= TIMESTAMP '1998-12-31')"
MERGED = f"""WITH {BASE}, {LATER},
fresh AS (SELECT * FROM later WHERE o_orderdate > TIMESTAMP '1998-12-31')
SELECT * FROM fresh UNION ALL SELECT * FROM base WHERE o_orderkey NOT IN (SELECT o_orderkey FROM fresh)"""

_CATEGORY_METRICS = f"""{_total("revenue")} AS total_revenue, {_total("revenue_with_tax")} AS total_revenue_with_tax,
  {_mean("unit_price")} AS avg_price, count(order_id) AS total_orders,
  count(DISTINCT product_id) AS unique_products, max(unit_price) AS max_price, min(unit_price) AS min_price,
  {_mean("rating_rate")} AS avg_rating"""
_TOP = f"""WITH {SALE_LINES}, {DIM_PRODUCT}, best AS (
  SELECT product_id, {_total("revenue")} AS total_revenue, count(order_id) AS total_orders,
    {_mean("rating_rate")} AS avg_rating FROM sale_lines GROUP BY product_id)
SELECT best.*, product_name, category, category_group, price_tier
FROM best LEFT JOIN dim_product USING (product_id)"""

# --- Marts, star ------------------------------------------------------------------------------
ORACLES["sales_by_category"] = f"""WITH {SALE_LINES}
SELECT category, order_year, order_month, {_CATEGORY_METRICS} FROM sale_lines GROUP BY ALL"""
ORACLES["sales_by_category_estimate"] = f"""SELECT * EXCLUDE (unique_products), true AS estimate_close
FROM ({ORACLES["sales_by_category"]})"""
ORACLES["sales_by_date"] = f"""WITH {SALE_LINES}
SELECT order_year, order_month, order_day, is_weekend, {_total("revenue")} AS daily_revenue,
  count(order_id) AS daily_orders, {_mean("unit_price")} AS avg_order_value,
  count(DISTINCT product_id) AS unique_products_sold FROM sale_lines GROUP BY ALL"""
ORACLES["sales_by_year_rollup"] = f"""WITH {SALE_LINES}
SELECT category, order_year, {_total("revenue")} AS total_revenue, count(order_id) AS total_orders,
  true AS estimate_is_near FROM sale_lines GROUP BY ALL"""
ORACLES["top_products"] = _TOP
ORACLES["top_ten_products"] = f"{_TOP} ORDER BY total_revenue DESC, product_id LIMIT 10"
ORACLES["top_k_per_category"] = f"""WITH {SALE_LINES}
SELECT category, product_id, {_total("revenue")} AS total_revenue FROM sale_lines GROUP BY category, product_id
QUALIFY row_number() OVER (PARTITION BY category ORDER BY {_total("revenue")} DESC, product_id) <= 5"""
ORACLES["dim_product"] = f"WITH {DIM_PRODUCT} SELECT * FROM dim_product"
ORACLES["dim_customer"] = f"""WITH {SILVER_CUSTOMERS}
SELECT customer_id, first_name, last_name, display_name AS full_name, email, phone, city, country, region,
  signup_date, tenure_days, tenure_bucket, seniority_rank, is_active, is_valid_email FROM customers_transformed"""
ORACLES["dim_date"] = f"WITH {CALENDAR} SELECT * FROM calendar"
ORACLES["fact_orders"] = f"""WITH {SILVER_ORDERS}
SELECT order_id, product_id, order_date, order_year, order_month, order_day, order_weekday, is_weekend,
  price AS unit_price, revenue, revenue_with_tax, net_revenue, price_bucket, rating_rate, rating_count,
  is_highly_rated, rank_in_category, price_change, category,
  md5(length(CAST(order_id AS VARCHAR)) || ':' || order_id) AS order_sk FROM orders_transformed"""
ORACLES["star_by_season_region"] = f"""WITH {SALE_LINES}, {CALENDAR}, {RAW_CUSTOMERS}, {RAW_PRODUCTS},
people AS (SELECT customer_id, {_case("upper(trim(country))", settings.REGIONS, "Other")} AS region FROM raw_customers),
goods AS (SELECT product_id, {_case("lower(trim(category))", settings.CATEGORY_GROUPS, "Other")} AS category_group
  FROM raw_products WHERE updated_at = '2024-01-15')
SELECT season, region, category_group, {_total("revenue")} AS total_revenue, count(order_id) AS total_orders
FROM sale_lines LEFT JOIN orders ON order_id = o_orderkey LEFT JOIN people ON o_custkey = customer_id
LEFT JOIN goods ON sale_lines.product_id = goods.product_id
LEFT JOIN calendar ON CAST(order_date AS DATE) = full_date GROUP BY ALL"""
ORACLES["star_one_quarter"] = f"""WITH {SALE_LINES}, {CALENDAR}, {SILVER_CUSTOMERS}, {DIM_PRODUCT}
SELECT year, month, region, category_group, supplier_country, {_total("revenue")} AS total_revenue,
  count(order_id) AS total_orders
FROM sale_lines JOIN calendar ON CAST(order_date AS DATE) = full_date
LEFT JOIN orders ON order_id = o_orderkey LEFT JOIN customers_transformed ON o_custkey = customer_id
LEFT JOIN dim_product ON sale_lines.product_id = dim_product.product_id
WHERE year = 1997 AND season = 'Summer' GROUP BY ALL"""
ORACLES["orphans"] = """SELECT l_partkey, count(*) AS fact_rows FROM lineitem
WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_type <> 'PROMO') GROUP BY l_partkey"""

# --- Silver tables ----------------------------------------------------------------------------
ORACLES["silver_orders"] = f"WITH {SILVER_ORDERS} SELECT * FROM silver_orders"
ORACLES["silver_products"] = f"WITH {SILVER_PRODUCTS} SELECT * FROM silver_products"
ORACLES["silver_customers"] = f"WITH {SILVER_CUSTOMERS} SELECT * FROM silver_customers"
ORACLES["silver_orders_transformed"] = f"WITH {SILVER_ORDERS} SELECT * FROM orders_transformed"
ORACLES["silver_products_transformed"] = f"WITH {SILVER_PRODUCTS} SELECT * FROM products_ranked"
ORACLES["silver_customers_transformed"] = f"WITH {SILVER_CUSTOMERS} SELECT * FROM customers_transformed"

# --- Cleaning ---------------------------------------------------------------------------------
ORACLES["dedup_latest"] = """SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey
ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
  l_returnflag, l_linestatus) = 1"""
ORACLES["dedup_latest_event"] = """SELECT * FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) = 1"""
ORACLES["require_not_null"] = f"""WITH {RAW_CUSTOMERS}
SELECT * FROM raw_customers WHERE customer_id IS NOT NULL AND email IS NOT NULL AND signup_date IS NOT NULL"""
ORACLES["valid_price"] = "SELECT event_id, value - 20 AS value FROM events WHERE value - 20 > 0"
ORACLES["text_normalise"] = f"""WITH {RAW_PRODUCTS}
SELECT product_id, updated_at, trim(product_name) AS product_name, lower(trim(category)) AS category,
  upper(trim(country)) AS country, upper(trim(supplier_id)) AS supplier_id FROM raw_products"""
ORACLES["email_flag"] = f"""WITH {SILVER_CUSTOMERS} SELECT customer_id, email, is_valid_email FROM silver_customers"""
ORACLES["names_concat"] = f"""WITH {RAW_CUSTOMERS}, named AS (
  SELECT customer_id, trim(first_name) AS f, CASE WHEN is_active = 1 THEN last_name END AS l FROM raw_customers)
SELECT customer_id, f || ' ' || l AS full_name, concat_ws(' ', f, l) AS display_name FROM named"""
ORACLES["stock_clamp"] = f"""WITH {RAW_PRODUCTS}
SELECT product_id, updated_at, CASE WHEN stock_qty < 0 THEN 0 ELSE stock_qty END AS stock_qty FROM raw_products"""

# --- Derived columns --------------------------------------------------------------------------
ORACLES["price_bucket"] = f"""SELECT event_id, {_bucket("value", settings.PRICE_BUCKETS)} AS price_bucket FROM events"""
ORACLES["stock_status"] = f"""WITH {RAW_PRODUCTS}
SELECT product_id, updated_at, CASE WHEN stock_qty <= 0 THEN 'out_of_stock' WHEN stock_qty < 20 THEN 'low_stock'
  ELSE 'in_stock' END AS stock_status FROM raw_products"""
ORACLES["price_tier"] = f"""WITH {RAW_PRODUCTS}
SELECT product_id, updated_at, {_bucket("price", settings.PRICE_TIERS)} AS price_tier FROM raw_products"""
ORACLES["tenure_bucket"] = f"""WITH {SILVER_CUSTOMERS}
SELECT customer_id, tenure_days, tenure_bucket FROM customers_transformed"""
ORACLES["category_group"] = f"""WITH {RAW_ORDERS}
SELECT {_case("lower(trim(category))", settings.CATEGORY_GROUPS, "Other")} AS category_group, count(*) AS count
FROM raw_orders GROUP BY 1"""
ORACLES["region_map"] = f"""WITH {SILVER_CUSTOMERS} SELECT customer_id, country, region FROM customers_transformed"""
ORACLES["region_lookup"] = """SELECT c_custkey, c_nationkey, coalesce(r_name, 'OTHER') AS region FROM customer
LEFT JOIN (SELECT n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'AFRICA')
  ON c_nationkey = n_nationkey"""
ORACLES["flags"] = f"""WITH {RAW_ORDERS}
SELECT order_id, product_id, rating_rate >= 4.0 AS is_highly_rated, upper(category) = 'IN' AS is_domestic,
  rating_count = 1 AS is_active FROM raw_orders"""
ORACLES["date_parts"] = f"""SELECT o_orderkey, {_date_parts("o_orderdate", "order_")} FROM orders"""
ORACLES["is_weekend"] = f"SELECT event_id, {WEEKEND.format('ts')} AS is_weekend FROM events"
ORACLES["season_of_month"] = f"""SELECT o_orderkey,
  {_case("CAST(month(o_orderdate) AS INTEGER)", settings.SEASONS, settings.LAST_SEASON)} AS season FROM orders"""
ORACLES["parsed_timestamps"] = """SELECT o_orderkey,
  CASE WHEN o_orderstatus <> 'P' THEN date_trunc('day', o_orderdate) END AS order_date FROM orders"""
ORACLES["revenue_tax"] = f"""SELECT o_orderkey, {_cents(_exact("o_totalprice"))} AS revenue,
  {_cents(TAXED.format("o_totalprice"))} AS revenue_with_tax, {_cents(_exact("o_totalprice"))} AS net_revenue,
  CAST({TAXED.format("o_totalprice")} AS DOUBLE) AS price_with_tax FROM orders"""
ORACLES["net_of_discount"] = f"""SELECT l_orderkey, l_partkey,
  {_cents(f"{_exact('l_extendedprice')} * CAST(1 - l_discount AS DECIMAL(9,6))")} AS net_revenue FROM lineitem"""
ORACLES["inventory_value"] = f"""WITH {RAW_PRODUCTS}
SELECT product_id, updated_at, {_cents(_exact("price") + " * stock_qty")} AS inventory_value FROM raw_products"""
ORACLES["surrogate_keys"] = """SELECT l_orderkey, l_partkey,
  md5(length(CAST(l_orderkey AS VARCHAR)) || ':' || l_orderkey || length(CAST(l_partkey AS VARCHAR)) || ':' || l_partkey
    || length(l_returnflag) || ':' || l_returnflag) AS line_sk FROM lineitem"""
ORACLES["surrogate_unique"] = """SELECT count(o_orderkey) AS rows, count(DISTINCT o_orderkey) AS keys FROM orders"""
ORACLES["surrogate_monotonic_unique"] = "SELECT count(*) AS rows, count(*) AS keys FROM lineitem"
ORACLES["surrogate_dense_two_runs"] = """WITH buyers AS (
  SELECT o_custkey, bool_or(o_orderdate <= TIMESTAMP '1998-12-31') AS early FROM orders GROUP BY o_custkey)
SELECT o_orderkey, o_custkey, customer_sk FROM orders JOIN (
  SELECT o_custkey, row_number() OVER (ORDER BY early DESC, o_custkey) AS customer_sk FROM buyers) USING (o_custkey)"""
ORACLES["audit_columns"] = """SELECT *, TIMESTAMP '2024-01-01' AS _gold_ingest_ts, 'gold' AS _layer,
  'orders' AS _source_table, 'tierline' AS _pipeline, 'dev' AS _env, TIMESTAMP '2024-01-01' AS _ingest_ts,
  'api' AS _source FROM orders"""

# --- Windows ----------------------------------------------------------------------------------
ORACLES["rank_in_category"] = f"""WITH {RAW_ORDERS}
SELECT order_id, product_id, category, rating_rate,
  dense_rank() OVER (PARTITION BY category ORDER BY rating_rate DESC) AS rank_in_category FROM raw_orders"""
ORACLES["rank_by_price"] = f"""WITH {RAW_ORDERS}
SELECT order_id, category, price, dense_rank() OVER (PARTITION BY category ORDER BY price) AS price_rank
FROM raw_orders"""
ORACLES["inventory_rank"] = f"""WITH {RAW_PRODUCTS}, valued AS (
  SELECT product_id, updated_at, category, {_cents(_exact("price") + " * stock_qty")} AS inventory_value
  FROM raw_products)
SELECT *, row_number() OVER (PARTITION BY category ORDER BY inventory_value DESC, product_id, updated_at)
  AS inventory_rank FROM valued"""
ORACLES["seniority_rank"] = f"""WITH {SILVER_CUSTOMERS}
SELECT customer_id, region, tenure_days, seniority_rank FROM customers_transformed"""
ORACLES["price_change"] = f"""WITH lagged AS (
  SELECT l_partkey, l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice,
    lag(l_extendedprice) OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey,
      l_quantity, l_extendedprice) AS prev_price FROM lineitem)
SELECT *, {_cents(f"{_exact('l_extendedprice')} - {_exact('coalesce(prev_price, l_extendedprice)')}")} AS price_change
FROM lagged"""

_LINES = """l_returnflag, l_shipdate, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
  l_discount, l_tax"""
_LINE_ORDER = _LINES.removeprefix("l_returnflag, l_shipdate, ")
ORACLES["number_in_hot_groups"] = f"""SELECT {_LINES}, row_number() OVER (PARTITION BY l_returnflag
  ORDER BY l_shipdate DESC, {_LINE_ORDER}) AS line_rank FROM lineitem"""
ORACLES["rank_in_hot_groups"] = """SELECT l_returnflag, l_orderkey, l_extendedprice,
  dense_rank() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC) AS price_rank FROM lineitem"""
ORACLES["price_change_in_hot_groups"] = f"""WITH lagged AS (
  SELECT {_LINES}, lag(l_extendedprice) OVER (PARTITION BY l_returnflag ORDER BY l_shipdate, {_LINE_ORDER}) AS prev_price
  FROM lineitem)
SELECT *, {_cents(f"{_exact('l_extendedprice')} - {_exact('coalesce(prev_price, l_extendedprice)')}")} AS price_change
FROM lagged"""

# --- Incremental ------------------------------------------------------------------------------
ORACLES["upsert_orders"] = MERGED
ORACLES["incremental_two_runs"] = MERGED
ORACLES["incremental_partitions"] = MERGED
ORACLES["stream_upsert_orders"] = MERGED
ORACLES["full_load_two_runs"] = f"WITH {LATER} SELECT * FROM later"
ORACLES["upsert_new_columns"] = f"""WITH {BASE}, {LATER}
SELECT l.o_orderkey, l.o_custkey, l.o_orderstatus, l.o_totalprice, l.o_orderdate, b.o_orderpriority, 'web' AS o_channel
FROM later l LEFT JOIN base b ON l.o_orderkey = b.o_orderkey WHERE l.o_orderstatus = 'F'
UNION ALL SELECT *, NULL FROM base WHERE o_orderstatus <> 'F'"""
ORACLES["upsert_partitions"] = """SELECT * REPLACE (
  CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice) FROM orders"""
ORACLES["incremental_slice"] = "SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1999-06-30'"
ORACLES["incremental_slice_inclusive"] = "SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1999-06-30'"
ORACLES["high_mark_state"] = """SELECT 'orders' AS table_name,
  strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS last_watermark FROM orders"""

# --- Sources and layout -----------------------------------------------------------------------
ORACLES["json_fields_default"] = """SELECT event_id, CASE WHEN event_type IN ('purchase', 'error') THEN 0
  ELSE coalesce(CAST(json_extract_string(props, '$.k') AS INTEGER), 0) END AS k FROM events"""
ORACLES["json_scan"] = """SELECT CAST(p_partkey AS INTEGER) AS order_id, CAST(p_partkey AS INTEGER) AS product_id,
  CASE WHEN p_type = 'SMALL' THEN '' ELSE p_name END AS product_name, p_type AS category,
  CASE WHEN p_type = 'PROMO' THEN 0.0::DOUBLE ELSE p_retailprice END AS price,
  CASE WHEN p_type = 'LARGE' THEN 0.0::DOUBLE ELSE CAST(p_size AS DOUBLE) / 10 END AS rating_rate,
  CASE WHEN p_type = 'LARGE' THEN 0 ELSE p_size END AS rating_count,
  TIMESTAMP '2024-01-01' AS order_date, 'rest_api' AS source FROM part"""
ORACLES["csv_scan"] = f"WITH {RAW_PRODUCTS} SELECT * FROM raw_products"
ORACLES["catalog_database"] = """SELECT count(*) AS rows_read, count(*) AS rows_written, false AS before,
  true AS after FROM orders"""
ORACLES["incremental_null_marks"] = """WITH s AS (SELECT * REPLACE (
    CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END AS o_orderdate) FROM orders)
SELECT * FROM s WHERE o_orderstatus = 'F' OR o_orderdate IS NULL
  OR o_orderdate > (SELECT max(o_orderdate) FROM s WHERE o_orderstatus = 'F')"""
ORACLES["top_2000_per_flag"] = """SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_returnflag
  ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey) <= 2000"""
_BIG = "round(o_totalprice) * 1e9::DOUBLE"
ORACLES["money_large_amounts"] = f"""SELECT o_orderkey, {_BIG} AS revenue, {_BIG} * 1e5::DOUBLE AS huge_revenue,
  {_BIG} * 1.18::DOUBLE AS with_tax, (o_orderkey + 0.123456789::DOUBLE) * 1.18::DOUBLE AS fine_with_tax, {_BIG} AS full,
  0.0::DOUBLE AS free, 0.0::DOUBLE AS no_stock FROM orders"""
ORACLES["money_large_totals"] = f"""SELECT o_orderpriority,
  CAST(sum(CASE WHEN o_orderkey <> 1 THEN CAST({_BIG} AS BIGINT) END) AS DOUBLE) AS total FROM orders GROUP BY ALL"""
_FINE = """CAST(CASE o_orderkey % 6 WHEN 0 THEN 0.0000004 WHEN 1 THEN 0.000000001 WHEN 2 THEN 1000000.0000004
  WHEN 3 THEN 1000000000000000 WHEN 4 THEN -3.0000004 ELSE CAST(round(o_totalprice, 2) AS DECIMAL(38,10)) END AS DECIMAL(38,10))"""
ORACLES["money_fine_totals"] = f"""SELECT o_orderpriority, o_orderkey % 6 < 3 AS fine, CAST(round(sum({_FINE}), 2) AS DOUBLE) AS total,
  CAST(sign(sum({_FINE})) * CAST((2 * CAST(abs(sum({_FINE})) * 10000000000::BIGINT AS HUGEINT) + count(*) * 100000000)
    // (2 * count(*) * 100000000) AS BIGINT) AS DOUBLE) / 100::DOUBLE AS mean FROM orders GROUP BY ALL"""
ORACLES["upsert_named_table"] = MERGED
ORACLES["pipeline_two_runs"] = f"""SELECT o_orderkey AS order_id, lower(trim(o_orderpriority)) AS category,
  o_totalprice AS price, o_orderdate AS order_date, CAST(year(o_orderdate) AS INTEGER) AS order_year,
  CAST(month(o_orderdate) AS INTEGER) AS order_month FROM ({MERGED}) WHERE o_totalprice > 0"""
_DELTA = f"""WITH rows AS (
  SELECT o_orderkey AS order_id, o_custkey AS product_id, lower(trim(o_orderpriority)) AS category, o_totalprice AS price,
    o_orderdate AS order_date, (o_orderkey % 9) / 2 AS rating
  FROM ({MERGED}) WHERE o_totalprice > 0 AND NOT (o_orderdate > TIMESTAMP '1998-12-31' AND o_orderkey % 11 = 0)
)"""
ORACLES["layers_delta_run"] = f"""{_DELTA} SELECT order_id, product_id, category, price, order_date,
  dense_rank() OVER (PARTITION BY category ORDER BY rating DESC) AS rank_in_category,
  round(price - coalesce(lag(price) OVER (PARTITION BY product_id ORDER BY order_date, order_id), price), 2) AS price_change
FROM rows"""
ORACLES["layers_delta_marts"] = f"""{_DELTA} SELECT category, CAST(year(order_date) AS INTEGER) AS order_year,
  CAST(month(order_date) AS INTEGER) AS order_month, {_total("price")} AS total_revenue, {_mean("price")} AS avg_price,
  count(*) AS total_orders, count(DISTINCT product_id) AS unique_products FROM rows GROUP BY ALL"""
_FAULTS = """SELECT CASE o_orderkey % 7 WHEN 0 THEN '{}' WHEN 1 THEN 'a value of the wrong type' ELSE 'taken' END AS reason,
  count(*) AS lines FROM orders GROUP BY ALL"""
ORACLES["json_quarantine"] = _FAULTS.format("not JSON")
ORACLES["csv_quarantine"] = _FAULTS.format("another number of fields")
ORACLES["domestic_suppliers"] = "SELECT p_partkey AS product_id, coalesce(p_type IN ('ECONOMY', 'LARGE'), false) AS is_domestic FROM part"
ORACLES["optimised_table"] = "SELECT * FROM orders"
ORACLES["zorder_spans"] = "SELECT unnest(['name', 'o_orderdate']) AS column, true AS skips_half"
ORACLES["zorder_spans_prefixes"] = "SELECT unnest(['buyer', 'code']) AS column, true AS skips_most"
ORACLES["stream_late_files"] = "SELECT *, (SELECT max(o_orderdate) FROM orders WHERE o_orderpriority <> '5-LOW' OR o_orderdate > TIMESTAMP '1998-12-31') AS mark FROM orders"
ORACLES["catalog_table"] = "SELECT * FROM orders"
ORACLES["partitioned_read"] = """SELECT *, CAST(year(o_orderdate) AS INTEGER) AS order_year,
  CAST(month(o_orderdate) AS INTEGER) AS order_month FROM orders"""
ORACLES["partition_overwrite"] = """SELECT o_orderkey, o_custkey, o_orderstatus,
  CASE WHEN o_orderstatus = 'F' THEN 1.0::DOUBLE ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority
FROM orders"""
ORACLES["evolved_read"] = """SELECT * REPLACE (CASE WHEN o_orderdate > TIMESTAMP '1998-12-31' THEN o_orderpriority END
  AS o_orderpriority) FROM orders"""
ORACLES["evolved_types"] = """SELECT * REPLACE (CASE WHEN o_orderdate > TIMESTAMP '1998-12-31' THEN o_orderpriority END
  AS o_orderpriority, CASE WHEN o_orderdate > TIMESTAMP '1998-12-31' THEN o_totalprice
  ELSE CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) END AS o_totalprice) FROM orders"""
ORACLES["bronze_rejects"] = f"""WITH {RAW_PRODUCTS} SELECT CASE product_id % 7 WHEN 0 THEN 'another number of fields'
  WHEN 1 THEN 'a value of the wrong type' ELSE 'taken' END AS reason, count(*) AS lines FROM raw_products GROUP BY ALL"""
ORACLES["zorder_rows"] = "SELECT * FROM lineitem"
ORACLES["compact_rows"] = "SELECT * FROM orders"
ORACLES["compact_small_files"] = "SELECT * FROM orders"
ORACLES["table_stats"] = """SELECT count(*) AS rows, CAST(11 AS BIGINT) AS columns, CAST(1 AS BIGINT) AS files,
  true AS has_bytes FROM lineitem"""


def _null_counts() -> str:
    columns = (
        "customer_id first_name last_name email phone city country signup_date updated_at is_active".split()
    )
    return " UNION ALL ".join(
        f"SELECT 'nulls' AS metric, '{c}' AS subject, count(*) FILTER ({c} IS NULL) AS value FROM raw_customers"
        for c in columns
    )


ORACLES["profile"] = f"""WITH {RAW_CUSTOMERS} {_null_counts()}
UNION ALL SELECT 'rows', '*', count(*) FROM raw_customers
UNION ALL SELECT 'columns', '*', 10
UNION ALL SELECT 'distinct', 'country', count(DISTINCT country) FROM raw_customers
UNION ALL SELECT 'violations', 'valid_email', count(*) FILTER (NOT regexp_matches(lower(trim(email)),
  '{settings.EMAIL_PATTERN}')) FROM raw_customers
UNION ALL SELECT 'violations', 'recent_signup',
  count(*) FILTER (NOT coalesce(signup_date >= TIMESTAMP '2001-01-01', false)) FROM raw_customers"""

_PROFILED = ["o_orderpriority", "o_custkey", "o_orderkey"]
ORACLES["profile_values"] = " UNION ALL ".join(f"""(SELECT '{c}' AS "column", (SELECT count(*) FROM orders) AS rows,
  (SELECT count(*) FILTER ({c} IS NULL) FROM orders) AS nulls, (SELECT count(DISTINCT {c}) FROM orders) AS "distinct",
  row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR)) AS place, CAST({c} AS VARCHAR) AS value,
  count(*) AS value_rows FROM orders WHERE {c} IS NOT NULL GROUP BY {c} QUALIFY place <= 3)""" for c in _PROFILED)
ORACLES["profile_quantiles"] = """SELECT "column", CAST(share AS DOUBLE) AS share, true AS is_near
FROM unnest(['o_totalprice', 'o_custkey']) AS a("column"), unnest([0.1, 0.5, 0.9]) AS b(share)"""
