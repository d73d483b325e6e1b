"""Column functions on boundaries and nulls."""

import datetime as dt
import decimal
import random

import pytest
from pyspark.sql import functions as F

from tierline.functions import dates, keys, labels, money, records, text


def values(spark, inputs, schema, make):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, x {schema}")
    return [r[0] for r in rows.orderBy("i").select(make(F.col("x"))).collect()]


def test_price_bucket_bounds(spark):
    found = values(spark, [19.99, 20.0, 49.99, 50.0, None], "double", labels.price_bucket)
    assert found == ["low", "medium", "medium", "high", "high"]


def test_price_tier_bounds(spark):
    prices = [9.99, 10.0, 49.99, 50.0, 99.99, 100.0, None]
    expected = ["Budget", "Mid-Range", "Mid-Range", "Premium", "Premium", "Luxury", "Luxury"]
    assert values(spark, prices, "double", labels.price_tier) == expected


def test_tenure_bucket_bounds(spark):
    days = [29, 30, 179, 180, 364, 365, None]
    expected = ["New", "Regular", "Regular", "Loyal", "Loyal", "Champion", "Champion"]
    assert values(spark, days, "int", labels.tenure_bucket) == expected


def test_stock_is_clamped_then_labelled(spark):
    stock = [-5, 0, 19, 20, None]
    assert values(spark, stock, "bigint", labels.clamp_low) == [0, 0, 19, 20, None]
    found = values(spark, stock, "bigint", lambda x: labels.stock_status(labels.clamp_low(x)))
    assert found == ["out_of_stock", "out_of_stock", "low_stock", "in_stock", "in_stock"]


def test_maps_fall_back(spark):
    found = values(spark, ["gadgets", "shoes", "outdoor", "cookware", "books", None], "string", labels.category_group)
    assert found == ["Electronics", "Footwear", "Sports & Fitness", "Kitchen", "Other", "Other"]
    found = values(spark, ["CN", "CA", "IT", "NZ", "BR", None], "string", labels.region)
    assert found == ["Asia", "North America", "Europe", "Oceania", "Other", "Other"]
    assert values(spark, [12, 2, 5, 8, 9, None], "int", labels.season) == [
        "Winter", "Winter", "Spring", "Summer", "Autumn", "Autumn",
    ]


def test_flags_treat_null_as_false(spark):
    assert values(spark, [3.9, 4.0, None], "double", labels.is_highly_rated) == [False, True, False]
    assert values(spark, ["IN", "US", None], "string", labels.is_domestic) == [True, False, False]
    assert values(spark, [1, 0, None], "bigint", labels.is_active) == [True, False, False]


def test_email_pattern(spark):
    emails = ["a@b.c", "a@b", "@b.c", "a@b.c@d", "a b@c d.e", "a@b.c\n", None]
    assert values(spark, emails, "string", text.is_valid_email) == [True, False, False, False, True, True, False]


def test_text_and_names(spark):
    assert values(spark, ["  Ab ", "\tAb", None], "string", text.lowered) == ["ab", "\tab", None]
    assert values(spark, [" ab"], "string", text.raised) == ["AB"]
    assert values(spark, ["Doe", None], "string", lambda x: text.full_name(F.lit("Jo"), x)) == ["Jo Doe", None]
    assert values(spark, ["Doe", None], "string", lambda x: text.display_name(F.lit("Jo"), x)) == ["Jo Doe", "Jo"]


def test_timestamps_and_dates(spark):
    found = values(spark, ["2024-01-15", "not-a-date", None], "string", dates.parse_timestamp)
    assert found == [dt.datetime(2024, 1, 15), None, None]
    found = values(spark, ["15/01/2024"], "string", lambda x: dates.parse_timestamp(x, "dd/MM/yyyy"))
    assert found == [dt.datetime(2024, 1, 15)]
    days = [dt.date(2024, 1, 6), dt.date(2024, 1, 7), dt.date(2024, 1, 8), None]
    assert values(spark, days, "date", lambda x: dates.is_weekend(F.dayofweek(x))) == [True, True, False, False]
    assert values(spark, days, "date", lambda x: dates.tenure_days(x, dt.date(2024, 1, 10))) == [4, 3, 2, None]


AMOUNTS = [1.005, 2.675, 29.99, 75.5, -1.005, 0.0, 123456789012.34, 5e13, None, float("nan"), float("inf")]


def rounded(value, factor="1"):
    if value is None or value != value or value == float("inf"):
        return None
    exact = decimal.Decimal(repr(value)) * decimal.Decimal(factor)
    return float(exact.quantize(decimal.Decimal("0.01"), rounding=decimal.ROUND_HALF_UP))


def test_rounding_is_exact_for_small_and_large_amounts(spark):
    noise = [round(random.Random(7).uniform(0, 1e6), 3) for _ in range(500)]
    amounts = AMOUNTS + noise
    assert values(spark, amounts, "double", money.revenue) == [rounded(x) for x in amounts]
    assert values(spark, amounts, "double", money.revenue_with_tax) == [rounded(x, "1.18") for x in amounts]


def test_tax_discount_and_inventory(spark):
    assert values(spark, [75.5, 29.99], "double", money.price_with_tax) == [89.09, 35.3882]
    net = values(spark, [100.0, 105000.0, 9e8], "double", lambda x: money.net_revenue(x, F.lit(0.05)))
    assert net == [95.0, 99750.0, 855000000.0]
    stock = values(spark, [29.99, 9e9, None], "double", lambda x: money.inventory_value(x, F.lit(150)))
    assert stock == [4498.5, 1.35e12, None]
    change = values(spark, [10.1, None], "double", lambda x: money.price_change(x, F.lit(10.0)))
    assert change == [0.1, None]
    first = values(spark, [10.1], "double", lambda x: money.price_change(x, F.lit(None).cast("double")))
    assert first == [0.0]


def test_sums_and_means_do_not_depend_on_order(spark):
    amounts = [0.1] * 10 + [1e15, -1e15, -0.7, None, float("nan")]
    for ordered in (amounts, amounts[::-1]):
        rows = spark.createDataFrame([(x,) for x in ordered], "x double").repartition(3)
        found = rows.agg(money.total(F.col("x")), money.mean(F.col("x"))).first()
        assert tuple(found) == (0.3, 0.02)


@pytest.mark.parametrize("amounts, expected", [([1.0, 1.01], 1.01), ([-1.0, -1.01], -1.01), ([2.0], 2.0), ([], None)])
def test_mean_rounds_half_away_from_zero(spark, amounts, expected):
    rows = spark.createDataFrame([(x,) for x in amounts], "x double")
    assert rows.agg(money.mean(F.col("x"))).first()[0] == expected


def test_surrogates_keep_parts_apart(spark):
    rows = [("a", None), (None, "a"), ("a", ""), ("", "a"), ("1:a", None), (None, None)]
    df = spark.createDataFrame(rows, "x string, y string")
    made = [r[0] for r in df.select(keys.surrogate("x", "y")).collect()]
    assert len(set(made)) == len(rows)
    assert made == [r[0] for r in df.select(keys.surrogate("x", "y")).collect()]
    with pytest.raises(ValueError):
        keys.surrogate("x", mode="other")


def test_json_field_defaults(spark):
    found = values(
        spark, ['{"k": 5}', "{}", '{"k": null}', "nonsense", None], "string",
        lambda x: records.json_field(x, "k int", "k", 0),
    )
    assert found == [5, 0, 0, 0, 0]


def test_money_keeps_large_and_fine_amounts(spark):
    one = spark.range(1)

    def value(column):
        return one.select(column).first()[0]

    x = lambda v: F.lit(v).cast("double")
    assert value(money.revenue(x(1e21))) == 1e21
    assert value(money.net_revenue(x(1e13), x(1.0))) == 0 and value(money.inventory_value(x(1e13), F.lit(0))) == 0
    assert value(money.net_revenue(x(1e13), x(0.9999999))) == 1000000.0
    assert value(money.net_revenue(x(6000006.005006), x(0.000001))) == 6000000.0
    assert abs(value(money.price_with_tax(x(1.23456789))) - 1.4567901102) < 1e-12
    assert abs(value(money.price_with_tax(x(4e-7))) - 4.72e-7) < 1e-18
    assert value(money.revenue(x(float("inf")))) is None and value(money.price_change(x(float("nan")), x(1.0))) is None


def test_sums_of_large_amounts(spark):
    same = spark.range(10_000).select(F.lit(1234567890123.12).alias("x"))
    assert same.agg(money.total(F.col("x")), money.mean(F.col("x"))).first()[:] == (12345678901231200.0, 1234567890123.12)
    mixed = spark.createDataFrame([(9e18,), (9e18,), (0.01,), (float("inf"),), (None,), (float("nan"),)], "x double")
    assert mixed.agg(money.total(F.col("x")), money.mean(F.col("x"))).first()[:] == (1.8e19, 6e18)
    none = spark.createDataFrame([(None,), (float("inf"),)], "x double")
    assert none.agg(money.total(F.col("x")), money.mean(F.col("x"))).first()[:] == (None, None)
