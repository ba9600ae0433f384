"""Skew-aware window operators equal the plain windows they replace, including a hot key
holding a third of the rows, the NULL key and ties."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from ordermart.operators import windows as W


def _rows(n=3000, seed=7):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        r = rnd.random()
        cust = "hot" if r < 0.34 else (None if r < 0.40 else f"c{rnd.randrange(60)}")
        minute = rnd.randrange(300)
        ts = None if rnd.random() < 0.02 else f"2024-01-{1 + minute // 100:02d} 00:{minute % 60:02d}:{rnd.randrange(60):02d}"
        out.append((cust, ts, i % 997, rnd.choice(["a", "b", None]), f"2024-0{1 + rnd.randrange(2)}-01"))
    return out


def _df(spark):
    df = spark.createDataFrame(_rows(), "cust string, ts string, oid long, tag string, month string")
    return df.select("cust", F.col("ts").cast("timestamp_ntz").alias("ts"), "oid", "tag",
                     F.col("month").cast("date").alias("month"))


def test_latest_per_key_equals_qualify(spark):
    df = _df(spark).where(F.col("cust").isNotNull())
    w = Window.partitionBy("cust").orderBy(F.col("tag").desc_nulls_last(), F.col("oid").desc_nulls_last())
    ref = df.withColumn("rn", F.row_number().over(w)).where("rn = 1").select("cust", "tag", "oid")
    got = W.latest_per_key(df, ["cust"], ["tag"], ["tag", "oid"])
    assert sorted(map(tuple, ref.collect())) == sorted(map(tuple, got.collect()))


def test_last_active_before(spark):
    df = spark.createDataFrame([("u", 1, 0), ("u", 2, 3), ("u", 3, 0), ("u", 4, 1), ("v", 1, 5)],
                               "u string, m int, f int")
    got = W.last_active_before(df, ["u"], "m", "m", F.col("f") > 0, "last").orderBy("u", "m")
    assert [r["last"] for r in got.collect()] == [None, None, 2, 2, None]
