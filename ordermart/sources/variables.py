"""P1 and P2 in SQL form: the run's dates as session variables, the sources as temporary views that read them.

``declare_run`` declares ``mart_as_of`` and sets ``mart_period_start`` from it.  ``source_views`` makes a view
``period_<role>`` of every input: its rows of the period, for inputs that have a date, else all.  A view is kept as SQL
text, so a later ``SET VARIABLE`` moves the period of every view at once; the variable is folded to a literal
when a query is planned, so the filter reaches the scan as one with a literal does.  A period that is NULL selects no row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from ordermart.config import RunConfig
from ordermart.sources.spec import SPECS, load_source

AS_OF, PERIOD = "mart_as_of", "mart_period_start"

#: The date column of each input that the period filters (F2).
DATED = {
    "customer_orders_sku_level": "order_date", "fact_payments_transaction": "date_created", "fact_orders": "registered_date",
    "dps_order_info": "registered_date", "dmarts_customer_compliant": "order_date", "orders_pe": "created_date",
    "fact_groceries_shopping_missions": "registered_date",
}

# the view has picked the period's rows; the source's own date filter passes them all (years from 1000 on)
_EVERY_DAY = RunConfig(as_of=dt.date(1000, 1, 15))


def declare_run(spark: SparkSession, as_of: dt.date | None = None) -> None:
    """The variables of a run; without ``as_of``, of today."""
    day = "current_date()" if as_of is None else f"DATE '{as_of.isoformat()}'"
    spark.sql(f"DECLARE OR REPLACE VARIABLE {AS_OF} DATE DEFAULT {day}")
    spark.sql(f"DECLARE OR REPLACE VARIABLE {PERIOD} DATE")
    spark.sql(f"SET VARIABLE {PERIOD} = trunc(if(day({AS_OF}) <= 3, date_sub({AS_OF}, 1), {AS_OF}), 'MM')")


def source_views(spark: SparkSession, raw: dict[str, DataFrame]) -> None:
    """``raw_<role>`` and ``period_<role>`` for the given inputs."""
    for role, df in raw.items():
        df.createOrReplaceTempView(f"raw_{role}")
        where = f" WHERE to_date({DATED[role]}) >= session.{PERIOD}" if role in DATED else ""
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW period_{role} AS SELECT * FROM raw_{role}{where}")


def load_views(spark: SparkSession, roles) -> dict[str, DataFrame]:
    """The normalised sources, read from their views."""
    return {role: load_source(spark.table(f"period_{role}"), SPECS[role], _EVERY_DAY) for role in roles}
