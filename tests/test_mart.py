"""Contract, exact optimisations, publication, plan shape."""

import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import NullType

from mart_paths import SF_SMALL
from ordermart import config as C
from ordermart.pipeline import TEST_CONFIG, test_sources
from ordermart.plans import mart as M
from ordermart.plans import orders as O
from ordermart.session import cut_lineage


def _rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_contract(spark):
    df = M.order_mart(test_sources(spark, SF_SMALL), TEST_CONFIG)
    assert tuple(df.columns) == C.OUTPUT_COLUMNS
    assert not [f.name for f in df.schema.fields if isinstance(f.dataType, NullType)]
    types = dict(df.dtypes)
    assert types["wine_user"] == "bigint" and types["rmo_high_mov"] == "boolean"
    assert types["order_number"] == "bigint" and types["gfv"].startswith("decimal")


def test_spine_pruning_does_not_change_the_mart(spark):
    """Months before the look-back and users without orders reach no published value."""
    src = test_sources(spark, SF_SMALL)
    pruned = M.order_mart(src, TEST_CONFIG)
    whole = M.final_projection(M.enrich_orders(src, TEST_CONFIG, users=M.U.user_months(src, TEST_CONFIG)))
    assert _rows(pruned) == _rows(whole)


def test_left_joins_keep_every_order(spark):
    src = test_sources(spark, SF_SMALL)
    mart = M.order_mart(src, TEST_CONFIG)
    skus = O.prep_skus_pim(src["skus_pim_dmart"], src["pim_level_0_bis"])
    orders = O.customer_orders(src["customer_orders_sku_level"], skus)
    assert mart.select("order_id").distinct().count() == orders.count()
    # fan-out only from complaints: rows = sum over orders of max(1, complaint groups)
    comp = O.complaint_rollup(src["dmarts_customer_compliant"]).groupBy("join_order_id").count()
    expected = orders.join(comp, "join_order_id", "left").select(
        F.sum(F.coalesce("count", F.lit(1)))).first()[0]
    assert mart.count() == expected


def test_vendor_join_has_no_effect(spark):
    src = test_sources(spark, SF_SMALL)
    a = O.prep_payments(src["fact_payments_transaction"])
    b = O.prep_payments(src["fact_payments_transaction"], src["dmarts_vendor_profiles"])
    assert _rows(a) == _rows(b)


def test_publish_append_and_replace_month(spark):
    df = M.order_mart(test_sources(spark, SF_SMALL), TEST_CONFIG).cache()
    n = df.count()
    path = tempfile.mkdtemp(prefix="ordermart-target-")
    spark.sql("DROP TABLE IF EXISTS mart_target")
    M.create_target(df.schema, "mart_target", spark, path)
    M.publish(df, "mart_target", mode="append")
    assert spark.table("mart_target").count() == n
    M.publish(df, "mart_target", mode="replace_month")
    M.publish(df, "mart_target", mode="replace_month")
    assert spark.table("mart_target").count() == n
    M.publish(df, "mart_target", mode="append")
    assert spark.table("mart_target").count() == 2 * n
    # another month's run leaves this one alone
    later = df.withColumn("month", F.add_months("month", 1200))
    M.publish(later, "mart_target", mode="replace_month")
    assert spark.table("mart_target").count() == 3 * n
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    back = spark.table("mart_target").select(*C.OUTPUT_COLUMNS)
    assert back.dtypes == df.dtypes
    spark.sql("DROP TABLE mart_target")
    df.unpersist()


def test_unfit_targets_are_refused_and_unchanged(spark):
    schema = M.mart_schema(test_sources(spark, SF_SMALL), TEST_CONFIG)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
    row = spark.createDataFrame([tuple([None] * len(schema))], schema)
    names = [f"c{i}" for i in range(len(schema))]
    path = tempfile.mkdtemp(prefix="ordermart-plain-") + "/t"
    row.toDF(*names).write.option("path", path).saveAsTable("plain_target")
    with pytest.raises(ValueError, match="partitioned"):
        M.publish(row, "plain_target", mode="replace_month")
    assert spark.table("plain_target").count() == 1
    M.publish(row, "plain_target")  # by position, whatever the names
    assert spark.table("plain_target").count() == 2
    other = row.withColumn("hour", F.lit("x"))
    other.write.option("path", path + "2").saveAsTable("typed_target")
    with pytest.raises(ValueError, match="hour"):
        M.publish(row, "typed_target")
    row.drop("hour").write.option("path", path + "3").saveAsTable("short_target")
    with pytest.raises(ValueError, match="columns"):
        M.publish(row, "short_target")
    for t in ("plain_target", "typed_target", "short_target"):
        spark.sql(f"DROP TABLE {t}")


def _static(spark, build):
    """The plan without broadcasts and adaptive execution: the shape that large inputs get."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return build()._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_customer_stage_shuffles_order_grain_rows_five_times_at_most(spark):
    """After the cuts: one aggregate of the rows, then fine rows on (customer, month), on the customer and
    on (customer, minute), and the rows once."""
    src = test_sources(spark, SF_SMALL)
    plans = []
    M.enrich_orders(src, TEST_CONFIG, cut=lambda df, name: (plans.append((name, _static(spark, lambda: df))), cut_lineage(df, name))[1])
    fine = dict(plans)["fine"].toString()
    assert fine.count("Exchange hashpartitioning(k_cust") == 1
    last = _static(spark, lambda: M.enrich_orders(src, TEST_CONFIG))
    # grain of a node: it holds the minute segment or the order id
    grain = []

    def walk(node):
        if node.nodeName() == "Exchange":
            names = {node.output().apply(i).name() for i in range(node.output().size())}
            if "_seg" in names or "order_id" in names:
                grain.append(node.simpleString(6))
        for i in range(node.children().size()):
            walk(node.children().apply(i))
    walk(last)
    assert len(grain) + 1 <= 5, grain


def test_plan_has_no_python(spark):
    plan = M.order_mart(test_sources(spark, SF_SMALL), TEST_CONFIG)._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "PythonUDF" not in plan


def test_lines_are_hashed_on_the_order_key_once(spark):
    """From the lines to L16 the wide rows cross one shuffle, and no aggregate falls back to sorting."""
    src = test_sources(spark, SF_SMALL)
    skus = O.prep_skus_pim(src["skus_pim_dmart"], src["pim_level_0_bis"])
    users = M.U.user_months(src, TEST_CONFIG, M.U.spine_floor(TEST_CONFIG))
    node = _static(spark, lambda: M.user_month_values(M.enrich(O.customer_orders(src["customer_orders_sku_level"], skus), M.order_joins(src)), users))
    exchanges, aggregates = [], []
    while node.children().size() > 0:          # follow the rows (first child) down
        if node.nodeName() == "Exchange":
            exchanges.append(node.simpleString(5))
            if "join_order_id" not in exchanges[-1]:
                break                                # the lines' way to the catalogue
        if node.nodeName().endswith("Aggregate"):
            aggregates.append(node.nodeName())
        node = node.children().apply(0)
    assert [("hashpartitioning(join_order_id" in x) for x in exchanges].count(True) == 1
    assert aggregates and "ObjectHashAggregate" not in aggregates


def test_readers_of_few_columns_write_no_others(spark):
    """The rule queries' columns are the mart's own, and the lineage cut holds what they are made of."""
    src = test_sources(spark, SF_SMALL)
    wanted = ["order_id", *M.FANOUT_ORDER, "order_source", "order_source_level_three", "inaccuracy_late", "customer_id", "sku_level_customer_id"]
    written = {}
    few = M.order_mart(src, TEST_CONFIG, cut=lambda df, name: (written.__setitem__(name, df.columns), cut_lineage(df, name))[1], columns=wanted)
    assert few.columns == wanted
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(few) == rows(M.order_mart(src, TEST_CONFIG).select(*wanted))
    assert not {"u_income", "estimated_prep_time", "venta", "coupon_nivel", "cohort_date"} & set(written["orders"])
    assert {"v_type", "d_bin_campaign", "actual_delivery_time"} <= set(written["orders"])
