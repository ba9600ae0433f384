"""N-rows: Spark date helpers against Python's calendar, over every day of several years."""

import datetime as dt

from pyspark.sql import functions as F

from ordermart.config import period_start_date
from ordermart.functions import dates as D


def test_week_iso_month_functions(spark):
    start, days = dt.date(1994, 12, 25), 13156
    df = spark.range(days).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("d"))
    out = df.select("d", D.week_of_year_sunday(D.week_monday("d")).alias("u"), D.iso_weekday("d").alias("w"),
                    D.week_monday("d").alias("m"), D.month_diff(F.lit(dt.date(2030, 12, 31)), "d").alias("md"),
                    D.period_start("d").alias("p"), D.year_start("d").alias("y")).collect()
    assert len(out) == days
    for r in out:
        d = r["d"]
        monday = d - dt.timedelta(days=d.weekday())
        assert r["m"] == monday
        assert r["u"] == monday.strftime("%U")
        assert r["w"] == d.isoweekday()
        assert r["md"] == (2030 * 12 + 12) - (d.year * 12 + d.month)
        assert r["p"] == period_start_date(d)
        assert r["y"] == dt.date(d.year, 1, 1)


def test_period_start_truth_table():
    d = dt.date
    assert period_start_date(d(2024, 3, 1)) == d(2024, 2, 1)
    assert period_start_date(d(2024, 3, 2)) == d(2024, 3, 1)
    assert period_start_date(d(2024, 3, 3)) == d(2024, 3, 1)
    assert period_start_date(d(2024, 3, 31)) == d(2024, 3, 1)
    assert period_start_date(d(2024, 1, 1)) == d(2023, 12, 1)


def test_month_sequence_guard(spark):
    d = dt.date
    df = spark.createDataFrame([(d(2024, 1, 1), d(2024, 3, 1)), (d(2024, 3, 1), d(2024, 1, 1)),
                                (None, d(2024, 1, 1)), (d(2024, 1, 1), d(2024, 1, 1))], "a date, b date")
    got = [r[0] for r in df.select(D.month_sequence("a", "b")).collect()]
    assert got == [[d(2024, 1, 1), d(2024, 2, 1), d(2024, 3, 1)], [], None, [d(2024, 1, 1)]]


def test_month_key_from_timestamp(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 2, 29, 23, 59),)], "t timestamp_ntz")
    assert df.select(D.month_key("t")).first()[0] == dt.date(2024, 2, 1)
