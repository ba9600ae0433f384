"""Distinct counts as bit sets."""

import random

import pytest
from pyspark.sql import functions as F

from mart_paths import SF_SMALL
from ordermart.operators.bitsets import codes_of, set_of, size_of, union_of, with_code
from ordermart.pipeline import test_sources
from ordermart.plans.users import user_monthly_orders


def _rows(spark, values, n=4000):
    rnd = random.Random(5)
    return spark.createDataFrame([(rnd.randrange(20), rnd.randrange(30), rnd.choice([*values, None])) for _ in range(n)] + [(99, 1, None)],
                                 "user int, day int, what string")


@pytest.mark.parametrize("n", [1, 63, 64, 65, 200])  # within a word, a whole one, several
def test_sets_count_as_distinct_values_do(spark, n):
    df = _rows(spark, [f"v{i}" for i in range(n)])
    codes = codes_of(df, "what", 200)
    assert codes.size == n
    got = with_code(df, codes).groupBy("user").agg(*set_of(codes)).select("user", size_of(codes).alias("x"))
    want = df.groupBy("user").agg(F.countDistinct("what").alias("x"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_days_merge_into_months(spark):
    df = _rows(spark, [f"v{i}" for i in range(100)])
    codes = codes_of(df, "what", 128)
    days = with_code(df, codes).groupBy("user", "day").agg(*set_of(codes))
    months = days.groupBy("user", F.floor(F.col("day") / 10).alias("month")).agg(*union_of(codes)).select("user", "month", size_of(codes).alias("x"))
    want = df.groupBy("user", F.floor(F.col("day") / 10).alias("month")).agg(F.countDistinct("what").alias("x"))
    assert sorted(map(tuple, months.collect())) == sorted(map(tuple, want.collect()))


def test_a_larger_domain_gets_no_codes(spark):
    df = _rows(spark, ["a", "b", "c"])
    assert codes_of(df, "what", 2) is None and codes_of(df, "what", 3).size == 3
    nothing = codes_of(df.where("what is null"), "what", 3)
    assert nothing.size == 0 and with_code(df, nothing).agg(*set_of(nothing), F.count("*").alias("n")).select(size_of(nothing)).first()[0] == 0


def test_user_months_without_an_expand(spark):
    lines = test_sources(spark, SF_SMALL, roles=["customer_orders_sku_level"])["customer_orders_sku_level"]
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    coded, plain = user_monthly_orders(lines, 1024), user_monthly_orders(lines)
    beyond = user_monthly_orders(lines, 1)  # more categories than codes
    assert "Expand" not in plan(coded) and "Expand" in plan(plain) and "Expand" in plan(beyond)
    assert coded.schema.names == plain.schema.names and [f.dataType for f in coded.schema] == [f.dataType for f in plain.schema]
    whole = lambda df: sorted(map(str, df.withColumns({c: F.round(c, 6) for c in ("basket_size", "afv")}).collect()))
    assert whole(coded) == whole(plain) == whole(beyond)
    nobody = user_monthly_orders(lines.where("1 = 0"), 1024)
    assert nobody.isEmpty()
