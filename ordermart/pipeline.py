"""End-to-end wiring: raw role tables -> normalised sources -> mart."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from ordermart.config import RunConfig
from ordermart.session import cut_lineage, hash_small_partitions
from ordermart.sources.adapters import build_roles, read_tables, shared_tables
from ordermart.sources.spec import ROLES, load_all

# Test-data run: period June 1998 (as of 1998-06-15), spine through the data's last month.
TEST_CONFIG = RunConfig(as_of=dt.date(1998, 6, 15), spine_end=dt.date(2001, 8, 1))


_PLANS: dict[tuple, dict[str, DataFrame]] = {}


def test_sources(spark: SparkSession, sf_dir: str, cfg: RunConfig = TEST_CONFIG, roles=ROLES) -> dict[str, DataFrame]:
    """Normalised S1-S21 from the shared test tables (lazy; nothing runs until an action).

    Plans (not data) are cached per session, directory and config: building the 21 role
    plans costs thousands of Py4J calls, and a DataFrame plan is immutable."""
    key = (id(spark), spark.sparkContext.applicationId, sf_dir, cfg)
    cached = _PLANS.setdefault(key, {})
    missing = [r for r in roles if r not in cached]
    if missing:
        cached.update(load_all(build_roles(read_tables(spark, sf_dir), missing), cfg))
    return {r: cached[r] for r in roles}


def shared_sources(spark: SparkSession, sf_dir: str, cfg: RunConfig = TEST_CONFIG, cut=cut_lineage) -> dict[str, DataFrame]:
    """S1-S21 for a run that reads them all: ``test_sources`` over tables that several of them are derived from and that are
    written once.  Nothing of it is kept for another run."""
    hash_small_partitions(spark)
    return load_all(build_roles(shared_tables(read_tables(spark, sf_dir), cfg.period_start, cut)), cfg)


def run_mart(spark: SparkSession, sf_dir: str, cfg: RunConfig = TEST_CONFIG) -> DataFrame:
    from ordermart.plans.mart import order_mart
    return order_mart(shared_sources(spark, sf_dir, cfg), cfg)
test_sources.__test__ = False  # not a pytest test
