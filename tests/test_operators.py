"""Join helper, the source loader and operators on null keys and finer money."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ordermart.config import RunConfig
from ordermart.operators.joins import JoinSpec, enrich, packed, unpacked
from ordermart.plans.orders import customer_orders, prep_payments
from ordermart.plans.users import user_global_dates, user_monthly_status
from ordermart.sources.spec import SPECS, load_source


def test_spread_nulls_keeps_rows_and_matches(spark):
    left = spark.createDataFrame([("o1", "u1", 1), ("o2", None, 1), ("o3", None, 2), ("o4", "u9", 1)],
                                 "oid string, uid string, m int")
    right = spark.createDataFrame([("u1", 1, "a"), ("u1", 2, "b"), ("u9", 1, "c"), ("u9", 1, "d")],
                                  "uid string, m int, v string")
    plain = enrich(left, [JoinSpec(right, ["uid", "m"], ["uid", "m"], {"v": "v"})])
    spread = enrich(left, [JoinSpec(right, ["uid", "m"], ["uid", "m"], {"v": "v"}, spread_nulls_by="oid")])
    rows = lambda df: sorted(map(tuple, df.select("oid", "uid", "m", "v").collect()), key=str)
    assert rows(plain) == rows(spread)
    assert ("o2", None, 1, None) in rows(spread)          # NULL key kept, no match
    assert len([r for r in rows(spread) if r[0] == "o4"]) == 2  # right-side fan-out kept
    assert "__lk0" not in spread.columns


def test_load_source_keys_filters_and_rules(spark):
    raw = spark.createDataFrame([
        (dt.date(2024, 5, 31), 1, 10, "pe", "CONFIRMED", "SEGMENT_USER", "summer", "growth"),
        (dt.date(2024, 6, 1), 2, 20, "pe", "CONFIRMED", "new_user", "summer", "growth"),
        (dt.date(2024, 6, 2), 3, 30, "ar", "CONFIRMED", "new_user", "summer", "growth"),
        (dt.date(2024, 6, 3), 4, 40, "pe", "PENDING", "new_user", "summer", "growth"),
    ], "order_date date, customer_id long, order_id long, country_code string, state string, "
       "target_audience string, campaign_name string, campaign_purpose string")
    raw = raw.withColumns({
        "fulfilled_quantity": F.lit(1.0), "master_category_parent_english": F.lit("x"),
        "total_amount_net_with_discount_lc": F.lit(9).cast("decimal(18,2)"), "store_name": F.lit("s"),
        "vendor_id": F.lit(1).cast("long"), "order_timestamp": F.col("order_date").cast("timestamp_ntz"),
        "sku_id": F.lit(5).cast("long"), "ordered_quantity": F.lit(1.0),
        "total_amount_sold_net_lc": F.lit(10).cast("decimal(18,2)"),
        "total_cogs_sold_net_lc": F.lit(7).cast("decimal(18,2)"),
        "pcm_discount_amount_net_lc": F.lit(1).cast("decimal(18,2)"), "pcm_discount_subtype": F.lit(None).cast("string")})
    cfg = RunConfig(as_of=dt.date(2024, 6, 15))
    out = load_source(raw, SPECS["customer_orders_sku_level"], cfg)
    rows = out.select("join_order_id", "join_customer_id", "join_order_month", "ild_amount").collect()
    assert [tuple(r) for r in rows] == [("20", "2", dt.date(2024, 6, 1), 1)]
    assert dict(out.dtypes)["order_timestamp"] == "timestamp_ntz"
    assert out.columns.index("join_order_id") == out.columns.index("order_id") + 1


def test_ids_without_exact_strings_are_refused(spark):
    raw = spark.createDataFrame([(1.0, "a", "b")], "level_1 double, x string, y string")
    with pytest.raises(TypeError, match="double"):
        load_source(raw.withColumnRenamed("level_1", "codigo"), SPECS["dmarts_vendor_profiles"], RunConfig(as_of=dt.date(2024, 6, 15)))


def _lines(spark, rows):
    return spark.createDataFrame(rows, """store_name string, vendor_id long, order_date date, join_order_month date, order_timestamp timestamp_ntz,
        customer_id long, join_customer_id string, order_id long, join_order_id string, join_sku_id string, ordered_quantity double,
        fulfilled_quantity double, total_amount_sold_net_lc double, total_amount_net_with_discount_lc double, total_cogs_sold_net_lc double,
        pcm_discount_amount_net_lc double, pcm_discount_subtype string, target_audience string, ild_amount int""")


def test_sums_keep_the_money_of_the_lines(spark):
    """No rounding: a value just below a band's edge and a discount below a cent count as they are; null orders stay."""
    day, ts = dt.date(2024, 6, 1), dt.datetime(2024, 6, 1, 9)
    line = lambda oid, sold, disc: ("s", 1, day, day, ts, 1, "1", oid, oid and str(oid), "k", 1.0, 1.0, sold, sold, 1.0, disc, None, None, 0)
    skus = spark.createDataFrame([("k", "Fresh", "a")], "join_sku string, level_0 string, level_2 string")
    got = {r.order_id: r for r in customer_orders(_lines(spark, [line(1, 50.0, 0.004), line(1, 48.996, 0.0), line(None, 5.0, 0.0)]), skus).collect()}
    assert got[1].afv_segment == "[90,99]" and got[1].venta == pytest.approx(98.996) and got[1].discount_rate > 0 and got[1].discount_order == 1
    assert got[None].venta == 5.0


def test_null_keys_are_kept_by_the_operators(spark):
    s1 = spark.createDataFrame([(None, dt.date(2024, 1, 1))] * 2 + [("u", dt.date(2024, 1, 1))], "join_id string, adoption_since date").withColumns(
        {c: F.col("adoption_since") for c in ("acquisition_since", "adoption_until", "acquisition_until", "join_month")} | {
            "type": F.lit("x"), "mes_en_curso": F.lit(1)})
    assert user_global_dates(s1).count() == 2 and user_monthly_status(s1).count() == 3
    pay = spark.createDataFrame([(None, "a"), (None, "b"), ("1", "c")], "join_order_id string, issuer string").withColumns(
        {"card_operation_type": F.lit("o"), "provider": F.lit("p")})
    assert {(r.join_order_id, r.bank) for r in prep_payments(pay).collect()} == {(None, "b"), ("1", "c")}


def test_packed_joins_give_the_same_rows(spark):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    one = spark.createDataFrame([("a", 1, None), ("a", 2, "y"), (None, 3, "z")], "k string, n int, s string")
    two = spark.createDataFrame([("b", 2.5)], "k string, x double")
    specs = [JoinSpec(one, ["k"], ["k"], {"n": "n", "t": "s"}), JoinSpec(two, ["k"], ["k"], {"x": F.col("x") * 2})]
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(unpacked(enrich(left, packed(specs)), specs)) == rows(enrich(left, specs))
    few = unpacked(enrich(left, packed(specs, {"t"})), specs, {"t"})  # a join without columns still fans out
    assert few.columns == ["k", "t"] and rows(few) == rows(enrich(left, specs).select("k", "t"))
