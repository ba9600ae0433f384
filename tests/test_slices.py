"""Groups split by their order: slices, scans over them, numbering, spines as intervals."""

import datetime as dt
import random
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from mart_paths import SF_SMALL
from ordermart.operators.slices import SLICE, scan, sliced
from ordermart.operators.spine import fill_idle, month_intervals, month_spine
from ordermart.pipeline import TEST_CONFIG, test_sources
from ordermart.plans import mart as M
from ordermart.plans import orders as O
from ordermart.plans import users as U
from test_skew import by_order, naive_mart, skewed_sources

D = dt.date


def history(spark, rows=6_000):
    """No user has a third of the rows; months, ties and nulls in the order."""
    rng = random.Random(1)
    out = []
    for i in range(rows):
        user = None if i % 3 == 0 else f"u{rng.randrange(40)}"
        out.append((user, rng.choice([None, D(2000 + rng.randrange(20), 1 + rng.randrange(12), 1)]), rng.choice(["a", "b", None]), i, rng.choice([0, 0, 1])))
    return spark.createDataFrame(out, "u string, m date, c string, id int, n int")


def test_slices_are_ranges_of_the_order_and_bounded(spark):
    df = history(spark)
    out = sliced(df, ["u"], ["m", "c", "id"], 100).collect()
    size = Counter((r.u, r[SLICE]) for r in out)
    assert max(size.values()) < 400 and len([1 for u, _ in size if u is None]) > 8  # 2,000 rows of no user
    key = lambda r: ((r.m is not None, r.m or D.min), (r.c is not None, r.c or ""), r.id)
    for user in {r.u for r in out}:
        mine = sorted((r for r in out if r.u == user), key=key)
        assert [r[SLICE] for r in mine] == sorted(r[SLICE] for r in mine)
    assert sliced(df, ["u"], ["m"], 0).where(f"{SLICE} <> 0").isEmpty()
    assert sliced(df, ["u"], ["m"], 10_000).where(f"{SLICE} <> 0").isEmpty()


@pytest.mark.parametrize("limit", [0, 20, 100, 10_000])
def test_scan_equals_windows(spark, limit):
    df = history(spark)
    order = ["m", "c", "id"]
    w = Window.partitionBy("u").orderBy(*order)
    expected = df.withColumns({"was": F.lag("c").over(w), "was_id": F.lag("id").over(w),
                               "top": F.max(F.when(F.col("n") > 0, F.col("m"))).over(w.rowsBetween(Window.unboundedPreceding, -1))})
    got = scan(df, ["u"], order, {"was": "c", "was_id": "id"}, {"top": ("m", F.col("n") > 0)}, limit)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, expected.select(*got.columns).collect()))


def test_prior_values_of_no_user(spark):
    df = history(spark).select(F.col("u").alias("join_user_id"), F.col("m").alias("join_month"), F.concat("c", F.col("id").cast("string")).alias("category"))
    a, b = O.prep_purchase_missions(df), O.prep_purchase_missions(df, 50)
    assert Counter(map(tuple, a.collect())) == Counter(map(tuple, b.select(*a.columns).collect()))


def test_numbering_of_one_minute_is_split(spark):
    """Orders without a timestamp: the numbers are those of plain windows, and no group is large."""
    src, cfg = skewed_sources(spark, "null"), replace(TEST_CONFIG, slice_rows=16)
    tables = {}

    def cut(df, name="rows", **options):
        tables[name] = M.cut_lineage(df, name, **options)
        return tables[name]
    fast, plain = M.order_mart(src, cfg, cut=cut), naive_mart(src, cfg)
    assert by_order(fast) == by_order(plain)
    place = tables["fine"].groupBy("k_cust", "_seg", SLICE).agg(F.sum("_n").alias("n"))
    assert tables["fine"].agg(F.max(SLICE)).first()[0] > 3 and place.agg(F.max("n")).first()[0] < 100


def test_users_with_many_rows_are_split(spark):
    src = test_sources(spark, SF_SMALL)
    names = ["first_dmart_order_date_users", "customer_orders_sku_level", "monthly_user_info"]
    plain = U.user_months({n: src[n] for n in names}, replace(TEST_CONFIG, slice_rows=0))
    assert U.large_users(src, TEST_CONFIG) == set()
    small = replace(TEST_CONFIG, slice_rows=25)
    assert U.large_users(src, small) >= U.SPINE_SOURCES
    split = U.user_months({n: src[n] for n in names}, small)
    assert Counter(map(tuple, plain.collect())) == Counter(map(tuple, split.select(*plain.columns).collect()))


def test_idle_months_are_filled(spark):
    spans = spark.createDataFrame([("a", D(2024, 1, 20)), ("a", D(2024, 3, 1)), ("b", D(2024, 6, 1)), ("c", D(2025, 1, 1)), (None, D(2024, 5, 1)), ("d", None)],
                                  "u string, s date")
    intervals = month_intervals(spans, "u", "s", D(2024, 7, 1))
    assert sorted(map(tuple, intervals.collect()), key=str) == sorted(
        [("a", D(2024, 1, 1), D(2024, 7, 1)), ("b", D(2024, 6, 1), D(2024, 7, 1)), (None, D(2024, 5, 1), D(2024, 7, 1))], key=str)
    active = spark.createDataFrame([("a", D(2024, 3, 1), 1), ("a", D(2024, 3, 1), 2), ("a", D(2024, 4, 1), 3), ("a", D(2023, 4, 1), 9), ("b", D(2024, 8, 1), 9),
                                    ("x", D(2024, 4, 1), 9)], "u string, join_month date, v int")
    got = Counter(map(tuple, fill_idle(intervals, active, "u").collect()))
    grid = [tuple(r) for r in month_spine(spans, "u", "s", D(2024, 7, 1)).collect()]
    assert len(grid) == len(set(grid)) == 7 + 2 + 3
    assert got == Counter([("a", D(2024, 3, 1), 1), ("a", D(2024, 3, 1), 2), ("a", D(2024, 4, 1), 3)]
                          + [(u, m, None) for u, m in grid if (u, m) not in {("a", D(2024, 3, 1)), ("a", D(2024, 4, 1))}])


def test_no_idle_month_is_shuffled(spark):
    """Months of the spine appear above all exchanges of their rows."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        node = U.user_months(test_sources(spark, SF_SMALL), replace(TEST_CONFIG, slice_rows=0))._jdf.queryExecution().executedPlan()
        names = []
        while node.children().size() > 0:  # the rows' way, from the result to the spine's generator
            names.append(node.nodeName())
            if node.nodeName() == "Generate":
                break
            node = node.children().apply(0)
        assert names[-1] == "Generate" and "Exchange" not in names and names.count("Sort") <= 2, names
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
