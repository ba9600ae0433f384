"""The run's dates as session variables."""

import datetime as dt

import pytest

from mart_paths import SF_SMALL
from ordermart.config import RunConfig, period_start_date
from ordermart.sources.adapters import build_roles, read_tables
from ordermart.sources.spec import SPECS, load_all, load_source
from ordermart.sources.variables import DATED, PERIOD, declare_run, load_views, source_views


@pytest.fixture(scope="module")
def raw(spark):
    return build_roles(read_tables(spark, SF_SMALL), list(DATED) + ["fact_talon_coupons"])


@pytest.mark.parametrize("as_of", [dt.date(1998, 6, 15), dt.date(1998, 7, 3), dt.date(1998, 3, 1), dt.date(1997, 1, 2), dt.date(1998, 7, 4)])
def test_period_start_of_the_variable(spark, as_of):
    declare_run(spark, as_of)
    assert spark.sql(f"SELECT {PERIOD}").first()[0] == period_start_date(as_of)


def test_the_run_of_today(spark):
    declare_run(spark)
    assert spark.sql(f"SELECT {PERIOD} = trunc(if(day(current_date()) <= 3, date_sub(current_date(), 1), current_date()), 'MM')").first()[0]


def _same(a, b):
    assert a.schema.names == b.schema.names
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_views_equal_the_sources_and_follow_the_variable(spark, raw):
    source_views(spark, raw)
    for as_of in (dt.date(1998, 6, 15), dt.date(2000, 2, 2)):  # the views are made once
        declare_run(spark, as_of)
        cfg = RunConfig(as_of=as_of, spine_end=dt.date(2001, 8, 1))
        views, sources = load_views(spark, raw), load_all(raw, cfg)
        for role in raw:
            assert _same(views[role], sources[role]), role


def test_every_dated_source_is_named(spark, raw):
    """A source that the period filters has its date in DATED."""
    everything = build_roles(read_tables(spark, SF_SMALL))
    period = RunConfig(as_of=dt.date(1998, 6, 15))
    dated = {r for r, spec in SPECS.items() if spec.predicate is not None
             and "1998-06-01" in load_source(everything[r], spec, period)._jdf.queryExecution().analyzed().toString()}
    assert dated == set(DATED)


def test_the_filter_reaches_the_scan(spark, raw):
    source_views(spark, raw)
    declare_run(spark, dt.date(1998, 6, 15))
    plan = load_views(spark, ["fact_orders"])["fact_orders"]._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate,1998-06-01" in plan
    spark.sql(f"SET VARIABLE {PERIOD} = NULL")
    assert load_views(spark, ["fact_orders"])["fact_orders"].isEmpty()
