"""Plan checks (pushdown, pruning) and properties (input order, total bands)."""

import random

from pyspark.sql import functions as F

from mart_paths import SF_SMALL
from ordermart.functions import rules as R
from ordermart.pipeline import TEST_CONFIG, test_sources
from ordermart.plans import mart as M
from ordermart.sources.adapters import build_roles, read_tables
from ordermart.sources.spec import load_all


def _scans(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "FileScan parquet" in line]


def test_period_filter_and_columns_reach_the_scan(spark):
    src = test_sources(spark, SF_SMALL)
    orders_scans = [s for s in _scans(src["fact_orders"]) if "o_orderdate" in s]
    assert orders_scans and all("GreaterThanOrEqual(o_orderdate," in s for s in orders_scans)
    # a 2-column projection of the order fact reads 2 + filter columns, not the table
    narrow = src["fact_orders"].select("join_order_id", "user_id")
    (scan,) = _scans(narrow)
    schema = scan.split("ReadSchema: ")[1]
    assert "o_totalprice" not in schema and "o_orderpriority" not in schema


def test_input_order_does_not_change_the_mart(spark):
    """Also where S1, S3, S8 and S14 repeat a key with other values."""
    raw = build_roles(read_tables(spark, SF_SMALL))
    for role, change in {"first_dmart_order_date_users": {"type": F.lit("M1 Return")}, "monthly_user_info": {"f_present_month_orders": F.lit(9)},
                         "fact_orders": {"customer_id": F.col("customer_id") + 1}, "dps_order_info": {"scheme_id": F.col("scheme_id") + 1}}.items():
        again = raw[role].where(F.xxhash64(*[c for c, t in raw[role].dtypes if not t.startswith(("struct", "array"))]) % 3 == 0)
        raw[role] = raw[role].unionByName(again.withColumns({c: e.cast(again.schema[c].dataType) for c, e in change.items()}))
    shuffled = {k: v.repartition(7, F.rand(seed=3)) for k, v in raw.items()}
    a = M.order_mart(load_all(raw, TEST_CONFIG), TEST_CONFIG)
    b = M.order_mart(load_all(shuffled, TEST_CONFIG), TEST_CONFIG)
    cols = sorted(a.columns)
    key = lambda r: str(r)
    assert sorted(map(tuple, a.select(*cols).collect()), key=key) == \
        sorted(map(tuple, b.select(*cols).collect()), key=key)


def test_bands_are_total(spark):
    rnd = random.Random(1)
    vals = [(rnd.uniform(-50, 200),) for _ in range(2000)] + [(float(i) / 2,) for i in range(-4, 60)] + [(None,)]
    df = spark.createDataFrame(vals, "x double")
    out = df.select(R.basket_segment("x").alias("b"), R.value_band("x").alias("v")).collect()
    assert all(r["b"] is not None and r["v"] is not None for r in out)
