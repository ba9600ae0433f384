"""Sources laid out in buckets of the order key."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from mart_paths import SF_SMALL
from ordermart.operators.joins import enrich
from ordermart.pipeline import TEST_CONFIG, test_sources
from ordermart.plans import mart as M
from ordermart.plans import orders as O
from ordermart.session import scratch_path
from ordermart.sources.layout import KEY, ORDER_KEYED, drop_layout, laid_out, lay_out

BUCKETS = 6


@pytest.fixture(scope="module")
def both(spark):
    """The sources, some of them with repeated rows and NULL keys, and the same laid out."""
    src = dict(test_sources(spark, SF_SMALL))
    for name in ("fact_orders", "dmarts_customer_compliant", "fact_talon_coupons"):
        some = src[name].where(F.xxhash64(KEY) % 5 == 0)
        src[name] = src[name].unionByName(some).unionByName(some.withColumn(KEY, F.lit(None).cast("string")))
    lay_out(src, "test_laid_", BUCKETS, scratch_path(spark, "layout"))
    yield src, laid_out(spark, src, "test_laid_")
    drop_layout(spark, "test_laid_")


def _rows(src, buckets=0):
    skus = O.prep_skus_pim(src["skus_pim_dmart"], src["pim_level_0_bis"])
    return enrich(O.customer_orders(src["customer_orders_sku_level"], skus, buckets=buckets), M.order_joins(src))


def _nodes(node, found):
    found.append(node)
    for i in range(node.children().size()):
        _nodes(node.children().apply(i), found)
    return found


def _plan(spark, make):
    """The plan's nodes with no broadcast and without runtime changes, as for large right sides."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        return _nodes(make()._jdf.queryExecution().executedPlan(), [])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _right_exchanges(nodes):
    """Exchanges under the right side of each join that the order rows go through, from the last join to their own exchange."""
    node, found = nodes[0], []
    while not ("Exchange" in node.nodeName() and KEY in node.simpleString(3)):
        if "Join" in node.nodeName():
            found.append(sum("Exchange" in n.nodeName() for n in _nodes(node.children().apply(1), [])))
        node = node.children().apply(0)
    return found


def test_no_exchange_under_the_nine_right_sides(spark, both):
    src, laid = both
    assert len(ORDER_KEYED) == 9 == len(M.order_joins(laid))
    assert _right_exchanges(_plan(spark, lambda: _rows(laid, BUCKETS))) == [0] * 9
    assert min(_right_exchanges(_plan(spark, lambda: _rows(src)))) == 1


def test_rows_are_those_of_the_sources(spark, both):
    src, laid = both
    a, b = _rows(src), _rows(laid, BUCKETS)
    assert a.schema.names == b.schema.names
    text = lambda df: sorted(map(str, df.collect()))
    assert text(a) == text(b)
    for name in ORDER_KEYED:
        assert src[name].count() == laid[name].count()


def test_the_mart_over_laid_out_sources(spark, both):
    src, laid = both
    key = lambda df: sorted(map(str, df.select(*sorted(df.columns)).collect()))
    assert key(M.order_mart(src, TEST_CONFIG)) == key(M.order_mart(laid, replace(TEST_CONFIG, order_buckets=BUCKETS)))


def test_a_table_without_a_column_is_refused(spark, both):
    src, _ = both
    wider = {**src, "fact_orders": src["fact_orders"].withColumn("more", F.lit(1))}
    with pytest.raises(ValueError, match="without more"):
        laid_out(spark, wider, "test_laid_")
    with pytest.raises(ValueError, match="at least one"):
        lay_out(src, "test_none_", 0)
