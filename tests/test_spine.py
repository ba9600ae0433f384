"""G1: the month spine is dense, unique, guarded and floored."""

import datetime as dt
import random

from ordermart.config import RunConfig
from ordermart.operators.spine import month_spine
from ordermart.plans import users as U

D = dt.date


def test_spine_dense_unique(spark):
    df = spark.createDataFrame([("a", D(2024, 1, 15)), ("a", D(2024, 1, 15)), ("b", D(2024, 3, 2)),
                                ("c", D(2024, 6, 1)), ("d", None)], "u string, s date")
    got = sorted(map(tuple, month_spine(df, "u", "s", D(2024, 4, 1)).collect()))
    assert got == [("a", D(2024, m, 1)) for m in (1, 2, 3, 4)] + [("b", D(2024, 3, 1)), ("b", D(2024, 4, 1))]


def test_spine_floor(spark):
    df = spark.createDataFrame([("a", D(2023, 11, 3)), ("b", None)], "u string, s date")
    got = sorted(map(tuple, month_spine(df, "u", "s", D(2024, 2, 1), floor=D(2024, 1, 1)).collect()))
    assert got == [("a", D(2024, 1, 1)), ("a", D(2024, 2, 1))]


def test_spine_on_test_data_is_dense_and_unique(spark):
    from pyspark.sql import functions as F

    import __spark_entry__ as E
    from mart_paths import SF_SMALL

    grid = E.queries()["month_spine"](spark, SF_SMALL)
    assert grid.count() == grid.distinct().count()
    per_user = grid.groupBy("join_user_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("join_month").alias("lo"), F.max("join_month").alias("hi"))
    gaps = per_user.where(F.col("n") != F.months_between("hi", "lo").cast("int") + 1).count()
    assert gaps == 0
    assert per_user.where(F.col("hi") != F.lit(D(2001, 8, 1))).count() == 0


def _user_months(spark, runs):
    """Rows of C10 over users with gaps of every length, users without a row, repeated date rows and repeated months."""
    rng = random.Random(7)
    ugd, active = [], []
    for u in range(60):
        start = D(2024, rng.randrange(1, 5), 3)
        ugd += [(f"u{u}", start, start, D(2024, 9, k + 1), start) for k in range(1 + u % 3)]
        for m in rng.sample(range(1, 13), u % 8):
            for i in range(rng.choice([1, 1, 2])):
                active.append((f"u{u}", D(2024, m, 1), rng.choice(["Adoption", "M1 Return", "Recurring Return", None]), m + i,
                               rng.choice([None, 0, 3]), 1.0, 2, float(m), *[rng.choice([None, "Active", "Churned"])] * 2, *[rng.choice([None, i, 4])] * 7))
    ugd.append((None, D(2024, 3, 1), None, None, None))
    dates = spark.createDataFrame(ugd, "join_user_id string, adoption_since date, acquisition_since date, adoption_until date, acquisition_until date")
    info = ", ".join(f"m_{c} {'string' if c.endswith('user') else 'bigint'}" for c in U.MONTHLY_INFO)
    rows = spark.createDataFrame(active, f"join_user_id string, join_month date, type string, mes_en_curso int, dm_current_frequency bigint, basket_size double, categories bigint, afv double, {info}")
    cfg = RunConfig(as_of=D(2024, 12, 5))
    return U.dmart_data(U.user_intervals(dates, cfg), dates, rows, runs)


def test_windows_over_runs_of_idle_months_give_every_months_values(spark):
    got, plain = (U.user_data(_user_months(spark, runs)) for runs in (True, False))
    assert got.columns == plain.columns and got.dtypes == plain.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))


def test_idle_months_are_not_sorted(spark):
    """What the windows sort holds a row for a run of idle months, not one for each of them."""
    kept, every = (_user_months(spark, runs) for runs in (True, False))
    idle = lambda df: df.where("type IS NULL AND basket_size IS NULL").count()
    assert idle(kept) * 2 < idle(every)
    plan = U.user_data(kept)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("posexplode") < plan.index("Window")  # printed from the top: months are made after the windows
