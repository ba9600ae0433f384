"""What rides on a run without changing it: the fan-out report, the filter of order keys, runs that start again."""

import tempfile
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from mart_paths import SF_SMALL
from ordermart.operators.joins import fan_out_report
from ordermart.operators.keyfilter import key_filter, prune
from ordermart.pipeline import TEST_CONFIG, test_sources
from ordermart.plans import mart as M
from test_mart import _rows, _static
from test_skew import by_order


def test_repeated_keys_are_counted_and_the_mart_is_the_same(spark):
    src = dict(test_sources(spark, SF_SMALL))
    for name in ("first_dmart_order_date_users", "monthly_user_info", "fact_orders", "dps_order_info"):
        key = {"first_dmart_order_date_users": "join_id", "monthly_user_info": "join_user_id"}.get(name, "join_order_id")
        src[name] = src[name].unionByName(src[name].where(F.col(key).cast("int") % 4 == 0))
    cuts = []

    def cut(df, name="rows", **options):
        cuts.append(name)
        return M.cut_lineage(df, name, **options)
    plain = by_order(M.order_mart(src, TEST_CONFIG, cut=cut))
    before, cuts = list(cuts), []
    with fan_out_report() as report:
        mart = M.order_mart(src, TEST_CONFIG, cut=cut)
    assert by_order(mart) == plain and cuts == before  # the same rows, written as often
    rows = {name: (n, again) for name, n, again in report.rows()}
    assert len(rows) == len(report.rows()) == 22
    s8 = src["fact_orders"]
    assert rows["L8 fact_orders"] == (s8.count(), s8.where("order_id % 4 = 0").count() // 2)
    assert all(rows[n][1] > 0 for n in ("L4 monthly status", "L6 monthly info", "L8 fact_orders", "L15 dps", "L20 complaints (fans out)", "L16 user months"))
    assert all(rows[n][1] == 0 for n in ("L1 level 0", "L3 user dates", "L7 catalogue", "L9 coupons", "L21 orders_pe"))


def test_key_filter_passes_every_key_and_few_others(spark):
    keys = spark.range(0, 70_000, 7).select(F.col("id").cast("string").alias("k"))
    rows = spark.range(70_000).select(F.col("id").cast("string").alias("k")).union(spark.createDataFrame([(None,)], "k string"))
    kept = prune(rows, "k", key_filter(keys, "k", 1 << 17), 1 << 17)
    assert kept.join(keys, "k", "left_semi").count() == keys.count()
    assert kept.count() < 2 * keys.count() and kept.where("k IS NULL").isEmpty()
    full = prune(rows, "k", key_filter(keys, "k", 64), 64)  # a filter that is too small only passes more
    assert full.join(keys, "k", "left_semi").count() == keys.count()
    assert prune(rows, "k", key_filter(keys.limit(0), "k", 64), 64).isEmpty()


def test_undated_sources_are_probed_before_their_exchange(spark):
    src = test_sources(spark, SF_SMALL)
    assert _rows(M.order_mart(src, TEST_CONFIG)) == _rows(M.order_mart(src, replace(TEST_CONFIG, key_filter_bits=0)))
    pruned = M.of_the_period(src, TEST_CONFIG)
    lines = src["customer_orders_sku_level"].select("join_order_id")
    for name in M.UNDATED:
        plan = _static(spark, lambda: lines.join(pruned[name], "join_order_id", "left")).toString()
        right = plan[plan.rindex("Exchange hashpartitioning(join_order_id"):].split("Subquery")[0]
        assert "getbit" in right or "bit_get" in right, plan  # the probe is under the right side's exchange
        assert pruned[name].count() < src[name].count()


def test_a_run_is_appended_once_however_often_it_starts(spark, monkeypatch):
    mart = M.order_mart(test_sources(spark, SF_SMALL), TEST_CONFIG).cache()
    n = mart.count()
    for name, create in (("once_parts", lambda t, p: M.create_target(mart.schema, t, spark, p)),
                         ("once_plain", lambda t, p: spark.createDataFrame([], mart.schema).toDF(*[f"c{i}" for i in range(len(mart.columns))])
                          .write.option("path", p).saveAsTable(t))):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        create(name, tempfile.mkdtemp(prefix="ordermart-once-") + "/t")
        count = lambda: spark.read.table(name).count()
        # killed after the stage: no file has been moved
        real = M._staged_files
        monkeypatch.setattr(M, "_staged_files", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            M.publish_once(mart.repartition(3), name, "june")
        spark.catalog.refreshTable(name)
        assert count() == 0
        # killed while files are moved
        monkeypatch.setattr(M, "_staged_files", lambda *a: [*real(*a)[:1], (None, "")])
        with pytest.raises(Exception):
            M.publish_once(mart, name, "june")
        monkeypatch.setattr(M, "_staged_files", real)
        assert M.publish_once(mart, name, "june") and count() == n
        assert not M.publish_once(mart, name, "june") and count() == n
        assert M.publish_once(mart, name, "june-again") and count() == 2 * n  # another run appends, as the reference does
        M.publish(mart, name)
        assert count() == 3 * n
        got = spark.read.table(name).toDF(*M.positioned(mart.columns, ["month"] if name == "once_parts" else []))
        assert _rows(got.distinct()) == _rows(mart.distinct())
        spark.sql(f"DROP TABLE {name}")
    with pytest.raises(ValueError):
        M.publish_once(mart, "nowhere", "a/b")
    mart.unpersist()
