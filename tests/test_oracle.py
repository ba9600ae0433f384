"""Every registered query against its DuckDB oracle on sf0.001 (the driver does sf0.01)."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from mart_paths import SF_SMALL

TABLES = ["customer", "part", "orders", "lineitem"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.10g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.10g}")
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


FAST = ["period_start", "src_scan_normalise", "struct_fields", "scalar_dates", "scalar_values", "ild_amount",
        "sku_catalogue", "latest_per_key", "lag_prior_month", "complaint_rollup", "month_spine", "churn_type",
        "user_performance", "last_active_month", "order_rollup", "order_flags", "enrich_by_order",
        "enrich_user_month", "customer_max", "order_sequence", "order_mart", "value_band", "business_stage", "publish_append"]


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    sql = E.oracle_sql()[name]
    cols = sorted(df.columns)
    rel = duck.sql(sql)
    assert cols == sorted(rel.columns)
    a = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=str)
    b = sorted((tuple(_norm(x) for x in r) for r in rel.select(*[f'"{c}"' for c in cols]).fetchall()), key=str)
    assert len(a) == len(b) and a == b


def test_every_query_of_the_mart_has_an_oracle():
    from ordermart.queries import SPARK

    assert set(SPARK) <= set(E.oracle_sql())


def test_bands_and_stages_are_all_reached(spark):
    bands = {r.scaled_segment for r in E.queries()["value_band"](spark, "/root/testdata/sf0.01").select("scaled_segment").distinct().collect()}
    stages = {r.shifted_stage for r in E.queries()["business_stage"](spark, SF_SMALL).select("shifted_stage").distinct().collect()}
    assert len(bands) == 11 and len(stages) == 3
