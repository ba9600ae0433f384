"""Rule tables: every branch, edge and NULL of R1-R33, expected values written by hand."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ordermart.functions import rules as R


def run(spark, rows, schema, expr):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr).collect()]


def test_ild_amount(spark):
    rows = [
        ("SEGMENT_USER", "summer", "growth", Decimal("5.00")),        # qualifies (case-insensitive audience)
        ("new_user", "summer", "Expiring Soon", Decimal("5.00")),     # lower() = 'expiring soon' is not 'expiring Soon'
        ("new_user", "x test ild y", "growth", Decimal("5.00")),      # excluded pattern
        ("new_user", "a_category_b", "growth", Decimal("5.00")),      # '_' wildcards match
        ("new_user", "acategoryb", "growth", Decimal("5.00")),        # one char each side: matches, excluded
        ("new_user", "category", "growth", Decimal("5.00")),          # nothing around 'category': qualifies
        ("new_user", "summer", "overstock", Decimal("5.00")),         # excluded purpose
        ("SUBSCRIBED_USER", "summer", "growth", Decimal("5.00")),     # audience not targeted
        ("new_user", None, "growth", Decimal("5.00")),                # NULL name -> 0
        ("new_user", "summer", None, Decimal("5.00")),                # NULL purpose -> 0
        (None, "summer", "growth", Decimal("5.00")),                  # NULL audience -> 0
    ]
    got = run(spark, rows, "a string, c string, p string, d decimal(18,2)", R.ild_amount("a", "c", "p", "d"))
    assert [float(x) for x in got] == [5, 5, 0, 0, 0, 5, 0, 0, 0, 0, 0]


def test_basket_segment(spark):
    vals = [25.0, 19.5, 19.0, 15.0, 14.0, 7.0, 6.5, 6.0, 5.0, 4.0, 3.0, 2.0, 1.0, 0.5, 0.0, -3.0, None]
    exp = ["Outliers", "Outliers", "Supermarket Family Size", "Supermarket Family Size", "Supermarket Orders",
           "Supermarket Orders", "Invalid Basket Size", "Healthy Convenience", "Healthy Convenience",
           "Convenience Orders", "Convenience Orders", "Impulse Orders", "Impulse Orders", "Invalid Basket Size",
           "Invalid Basket Size", "Invalid Basket Size", "Invalid Basket Size"]
    assert run(spark, [(v,) for v in vals], "x double", R.basket_segment("x")) == exp


def test_value_band(spark):
    vals = [150, 99, 98.99, 90, 80, 70, 60, 50, 40, 30, 20, 10, 9.99, 0, -5, None]
    exp = ["[99,+]", "[99,+]", "[90,99]", "[90,99]", "[80,89]", "[70,79]", "[60,69]", "[50,59]", "[40,49]", "[30,39]",
           "[20,29]", "[10,19]", "[00,09]", "[00,09]", "[00,09]", "[00,09]"]
    rows = [(None if v is None else float(v),) for v in vals]
    assert run(spark, rows, "x double", R.value_band("x")) == exp


def test_lifecycle_rules(spark):
    schema = "s string, f long, pf long, a double, pa double"
    rows = [("Adoption", 1, 0, 1.0, 0.0), ("Churned", 0, 1, None, 1.0), ("Reactivated", 2, None, 3.0, None),
            ("Recurring Return", 3, 2, 5.0, 4.0), ("Recurring Return", 1, 2, 5.0, 4.0),
            ("Recurring Return", 1, 2, 3.0, 4.0), ("Recurring Return", 2, 2, 4.0, 4.0),
            ("M1 Return", 2, None, 4.0, None), ("M1 Return", 3, 2, None, 1.0)]
    assert run(spark, rows, schema, R.afv_performance("s", "f", "pf", "a", "pa")) == [
        "adoption", "churned", "reactivated", "increased_afv_frec", "increased_afv", "decreased_afv",
        "steady performance", "steady performance", "steady performance"]
    assert run(spark, rows, schema, R.frec_performance("s", "f", "pf")) == [
        "adoption", "churned", "reactivated", "increased_frec", "decreased_frec", "decreased_frec",
        "steady performance", "steady performance", "increased_frec"]


def test_churn_rules(spark):
    schema = "s string, p string"
    rows = [("Adoption", None), ("Recurring Return", "Reactivated"), ("Recurring Return", "M1 Return"),
            ("Churned", "Adoption"), ("Churned", "M1 Return"), ("Churned", "Churned"), ("Churned", "Reactivated"),
            ("Churned", "Recurring Return"), ("Churned", None)]
    assert run(spark, rows, schema, R.churn_type("s", "p")) == [
        "Adoption", "Recurring Return", "Recurring Return", "dmart_early_churn", "dmart_early_churn",
        "dmart_recurring_churn", "dmart_strong_churn", "regular churn", "regular churn"]
    assert run(spark, rows, schema, R.growth_status_fixed("s", "p")) == [
        "Adoption", "Reorder", "Recurring Return", "Churned", "Churned", "Churned", "Churned", "Churned", "Churned"]


def test_platform_and_activation(spark):
    schema = "ps string, s string, c long, p long"
    rows = [("Churned", "Reactivated", 5, 1), ("Active", "Reactivated", 5, 1), ("Active", "Adoption", 5, 1),
            ("Active", "Adoption", 1, 5), ("Active", "Adoption", 2, 2), (None, None, None, 1)]
    assert run(spark, rows, schema, R.platform_performance("ps", "s", "c", "p")) == [
        "churned", "reactivated", "increased_frec", "decreased_frec", "steady performance", "steady performance"]
    d = dt.date
    rows = [(d(2024, 3, 1), d(2023, 12, 1)), (d(2024, 3, 1), None), (d(2024, 1, 1), d(2023, 12, 31))]
    assert run(spark, rows, "m date, l date", R.activation_period("m", "l")) == [3, 0, 1]


def test_stage_and_windows(spark):
    d = dt.date
    rows = [(d(2022, 6, 30),), (d(2022, 7, 1),), (d(2022, 12, 31),), (d(2023, 1, 1),), (None,)]
    assert run(spark, rows, "d date", R.business_stage("d")) == [
        "Growth Stage", "Improving the Basics", "Improving the Basics", "Growth & Profitability",
        "Growth & Profitability"]
    rows = [(d(2024, 1, 5), d(2024, 1, 1), d(2024, 1, 5)), (d(2024, 1, 6), d(2024, 1, 1), d(2024, 1, 5)),
            (d(2024, 1, 1), d(2024, 1, 1), None), (d(2024, 1, 1), None, None)]
    schema = "d date, a date, b date"
    assert run(spark, rows, schema, R.date_in_window("d", "a", "b", "adoption", "active")) == [
        "adoption", "active", "active", "active"]
    # R26 first-order origin: NULL bounds -> 'adoption' (opposite default of R14)
    e = R.first_order_expressions("d", "a", "b", F.lit(0), F.lit(None).cast("double"), F.lit(0), F.lit(0),
                                  F.lit("c"), F.lit("f"), F.lit("v"))["adoption_origin"]
    assert run(spark, rows, schema, e) == ["acquisition", "adoption", "adoption", "adoption"]


def test_bin_flags(spark):
    rows = [("Plus en PedidosYa Market",), ("Tarifa Fija Plus",), ("Banco X",), ("plus fija",), (None,)]
    df = spark.createDataFrame(rows, "c string")
    got = [tuple(r) for r in df.select(*[v.alias(k) for k, v in R.bin_campaign_flags("c").items()]).collect()]
    assert got == [(1, 0, 1), (0, 1, 1), (0, 0, 0), (0, 0, 0), (0, 0, 0)]


def test_delivery_and_voucher_rules(spark):
    schema = "amt double, fee double"
    rows = [(0.0, 0.5), (4.0, 1.0), (-1.0, 0.25), (None, None), (None, 2.0)]
    df = spark.createDataFrame(rows, schema)
    out = df.select(*[v.alias(k) for k, v in {**R.voucher_flags("amt"), **R.delivery_fee_flags("fee")}.items()],
                    R.order_sub_nature("amt", "fee").alias("n")).collect()
    assert [tuple(r) for r in out] == [
        (1, "Voucher", "No Inc. DF", 1, "Voucher & Free Delivery"),
        (1, "Voucher", "Inc. Delivery Fee", 0, "Voucher"),
        (0, "No Voucher", "No Inc. DF", 1, "Free Delivery"),
        (0, "No Voucher", "No Inc. DF", 1, "Organic Order"),   # NULL fee: free for R24, not for R25
        (0, "No Voucher", "Inc. Delivery Fee", 0, "Organic Order")]
    rows = [(1, 0, 20.0, 10.0), (0, 1, 5.0, 10.0), (1, 1, None, 10.0)]
    df = spark.createDataFrame(rows, "vl int, pre int, a double, p double")
    out = df.select(R.has_delivery_time("vl", "pre"), R.late_order("a", "p")).collect()
    assert [tuple(r) for r in out] == [(True, 1), (False, 0), (False, 0)]


def test_coupon_and_source_rules(spark):
    schema = "bins int, plus int, vert string, amt double, vtype string"
    rows = [(1, 1, "DMART", 0.0, "RMO"), (0, 1, "DMART", 0.0, "RMO"), (0, 0, "DMART", 0.0, "RMO"),
            (0, 0, "FOOD", 0.0, "RAF"), (0, 0, "FOOD", 4.0, "OTHER"), (0, 0, "FOOD", -1.0, "RMO"),
            (0, 0, None, None, None)]
    assert run(spark, rows, schema, R.order_source("bins", "plus", "vert", "amt", "vtype")) == [
        "Bin", "Plus", "Dmart RMO", "RAF", "Other Vouchers", "Organic", "Organic"]
    assert run(spark, rows, schema, R.order_source_level_one("bins", "plus", "vert", "amt")) == [
        "3-Bin", "2.Plus", "4.Dmart RMO", "5.Other Vouchers", "5.Other Vouchers", "1.Organic", "1.Organic"]
    assert run(spark, rows, schema, R.coupon_type("amt", "vtype", "plus")) == [
        "RMO", "RMO", "RMO", "RAF", "OTHER", "Organic", "Organic"]
    assert run(spark, rows, schema, R.coupon_type("amt", "vtype", "plus", plus_first=True)) == [
        "Plus", "Plus", "RMO", "RAF", "OTHER", "Organic", "Organic"]
    # a used coupon without CRM attributes has a NULL type
    assert run(spark, [(0, 0, None, 0.0, None)], schema, R.coupon_type("amt", "vtype", "plus")) == [None]


def test_plus_and_levels(spark):
    rows = [(1, 1), (1, 0), (0, 1), (None, None)]
    df = spark.createDataFrame(rows, "po int, pil int")
    assert [r[0] for r in df.select(R.flag_plus("po", "pil")).collect()] == [2, 1, 0, 0]
    assert [r[0] for r in df.select(R.peyaplus("po")).collect()] == [
        "PeYa Plus Order", "PeYa Plus Order", "Regular Order", "Regular Order"]
    schema = "fp int, bin string, vert string, vc int, src string, mb int, do int"
    rows = [(2, None, None, 0, "x", 0, 0), (1, None, None, 0, "x", 0, 0), (1, "B", None, 0, "x", 0, 0),
            (0, None, "DMART", 1, "x", 1, 1), (0, None, "FOOD", 1, "RAF", 1, 1), (0, None, None, 0, "x", 1, 1),
            (0, None, None, 0, "x", 0, 1), (0, None, None, 0, "x", 0, 0)]
    args = ("fp", "vert", "vc", "src", "mb", "do")
    assert run(spark, rows, schema, R.order_source_level_two(*args)) == [
        "Plus", "Plus", "Plus", "Dmart RMO", "RAF", "Organic Multibuy", "Organic Discount", "Organic"]
    assert run(spark, rows, schema, R.order_source_level_three("fp", "bin", *args[1:])) == [
        "Plus Item Level", "Plus", "Plus Benefit", "Dmart RMO", "RAF", "Organic Multibuy", "Organic Discount",
        "Organic"]


def test_mission_and_bands(spark):
    rows = [(3.0, 4), (8.0, 2), (8.0, 3), (20.0, 5), (20.0, 4), (0.0, 0), (None, 1), (None, None)]
    assert run(spark, rows, "n double, k long", R.shopping_mission("n", "k")) == [
        "Instant Need", "Instant Need", "Fill In", "Stock Up", "Fill In", None, "Instant Need", None]
    rows = [(-1.0,), (0.0,), (10.0,), (10.5,), (50.0,), (50.5,), (None,)]
    assert run(spark, rows, "x double", R.duration_band("x")) == [
        None, "[0,10]", "[0,10]", "[10,20]", "[40,50]", "[50,+]", None]
    rows = [(1, 1), (0, 1), (0, 0), (None, None)]
    assert run(spark, rows, "a int, b int", R.user_mission("a", "b")) == [
        "Stock Up", "Fill In", "Instant Need", "Instant Need"]


def test_month_activation_and_first_order(spark):
    schema = "amt double, po int, pil int, vert string"
    rows = [(0.0, 1, 1, "DMART"), (-1.0, 1, 0, "FOOD"), (None, 1, 1, None), (None, 0, 0, None)]
    df = spark.createDataFrame(rows, schema)
    ex = R.month_activation_expressions("amt", "po", "pil", "vert")
    got = [tuple(r) for r in df.select(*[v.alias(k) for k, v in ex.items()]).collect()]
    assert got == [("CRM", "DMART"), ("Plus", "Plus"), ("Plus Item Level", "Plus"), ("Organic", "Organic")]
    ex = R.first_order_expressions(F.lit(None).cast("date"), F.lit(None).cast("date"), F.lit(None).cast("date"),
                                   F.lit(0), "amt", "po", "pil", F.lit("camp"), F.lit("fun"), "vert")
    got = [tuple(r) for r in df.select(ex["adoption_class"], ex["adoption_class_test"],
                                       ex["adoption_coupon_used"]).collect()]
    assert got == [("Voucher Trial", "Voucher Incentivized", "camp"), ("Plus Trial", "Organic", None),
                   ("ILD Plus", "Organic", None), ("Organic", "Organic", None)]


def test_inaccuracy_and_week_label(spark):
    df = spark.createDataFrame([("CCR1", 1, "07", 3), ("CCR1", 0, "52", 7), (None, 1, None, 1)],
                               "c string, l int, w string, d long")
    out = df.select(*[v.alias(k) for k, v in R.inaccuracy_flags("c", "l").items()],
                    R.week_and_day("w", "d")).collect()
    assert [tuple(r) for r in out] == [(1, 1, "W07-3"), (1, 0, "W52-7"), (0, 0, None)]
