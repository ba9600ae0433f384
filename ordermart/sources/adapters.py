"""Test-data roles: derive the 21 raw input tables from the shared TPC-H-style tables.

The engine reads 21 warehouse tables; the test data has ``lineitem orders part customer``.
Each role below is a deterministic Spark derivation of those tables (FIXTURES.md §3), so
every query's work grows with the given data.  The DuckDB oracle (``oracle.py``) derives
the same roles with the same arithmetic.  A production run passes the real tables instead
(``spec.roles_from_catalog``).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermart.sources.spec import ROLES

TPCH_TABLES = ("lineitem", "orders", "part", "customer")


def read_tables(spark: SparkSession, sf_dir: str, names=TPCH_TABLES) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def _m(c: str | Column, n: int) -> Column:
    return (F.col(c) if isinstance(c, str) else c) % F.lit(n)


def _tag(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix), c.cast("string"))


def _pick(c: Column, values: list) -> Column:
    """CASE c WHEN 0 THEN values[0] WHEN 1 THEN values[1] ... (None = NULL)."""
    expr = None
    for i, v in enumerate(values):
        if v is None:
            continue
        expr = F.when(c == i, F.lit(v)) if expr is None else expr.when(c == i, F.lit(v))
    return expr


def _flag(cond: Column) -> Column:
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def _dec(c: Column) -> Column:
    return c.cast("decimal(18,2)")


def _month_of(c: str) -> Column:
    return F.trunc(F.to_date(F.col(c)), "MM")


def customer_months(orders: DataFrame) -> DataFrame:
    """(o_custkey, om) with the month's first order date and its order counts by priority group."""
    pri = F.col("o_orderpriority")
    return (orders.groupBy("o_custkey", _month_of("o_orderdate").alias("om"))
            .agg(F.min(F.to_date("o_orderdate")).alias("first_in"),
                 F.count(F.lit(1)).alias("n_all"),
                 F.count(F.when(pri.isin("1-URGENT", "2-HIGH"), 1)).alias("n_f"),
                 F.count(F.when(pri == "3-MEDIUM", 1)).alias("n_ls"),
                 F.count(F.when(pri.isin("4-NOT SPECIFIED", "5-LOW"), 1)).alias("n_c")))


LINE_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag",
                "l_linestatus", "l_shipdate")
LINE_ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")


def line_orders(t: dict[str, DataFrame]) -> DataFrame:
    """Lines with their order."""
    li, o = t["lineitem"].select(*LINE_COLUMNS), t["orders"].select(*LINE_ORDER_COLUMNS)
    return li.join(o, li.l_orderkey == o.o_orderkey)


def shared_tables(t: dict[str, DataFrame], since, cut) -> dict[str, DataFrame]:
    """``t`` with what several roles are derived from, each written once by ``cut``: the customers' months (five roles), and the
    lines with their order (four), which the sources read from the period's start ``since`` only."""
    dated = {**t, "orders": t["orders"].where(F.to_date("o_orderdate") >= F.lit(since))}
    return {**t, "customer_months": cut(customer_months(t["orders"]), "months"), "line_orders": cut(line_orders(dated), "line_orders")}


def _months(t: dict[str, DataFrame]) -> DataFrame:
    return t["customer_months"] if "customer_months" in t else customer_months(t["orders"])


def _line_orders(t: dict[str, DataFrame]) -> DataFrame:
    return t["line_orders"] if "line_orders" in t else line_orders(t)


def build_roles(t: dict[str, DataFrame], roles=ROLES) -> dict[str, DataFrame]:
    """Raw role tables, lazily; only the requested roles are planned."""
    builders = {
        "customer_orders_sku_level": _lines, "skus_pim_dmart": _skus, "pim_level_0_bis": _level0,
        "first_dmart_order_date_users": _lifecycle, "monthly_user_info": _monthly_user_info,
        "fact_payments_transaction": _payments, "dmarts_vendor_profiles": _vendors,
        "fact_orders": _fact_orders, "fact_talon_coupons": _coupons,
        "agg_user_lifecycle": _user_lifecycle, "user_income": _user_income,
        "peru_clusters": _clusters, "dim_coupon_crm_attributes": _crm,
        "dps_order_info": _dps, "df090_dma_discounts_bines": _bines,
        "dmart_purchase_missions": _missions, "dmart_behavioural_clustering": _behaviour,
        "dmarts_customer_compliant": _complaints, "orders_pe": _orders_pe,
        "dmart_growth_tracker": _growth, "fact_groceries_shopping_missions": _shop,
    }
    return {r: builders[r](t) for r in roles}


def _lines(t):
    p = t["part"]
    gross = _dec(F.col("l_extendedprice"))
    discount = _dec(gross * F.col("l_discount").cast("decimal(4,2)"))
    j = _line_orders(t).join(p.select("p_partkey", "p_type"), F.col("l_partkey") == p.p_partkey)
    return j.select(
        F.to_date("o_orderdate").alias("order_date"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderkey").alias("order_id"),
        _m("l_quantity", 5).alias("fulfilled_quantity"),
        F.col("p_type").alias("master_category_parent_english"),
        _dec(gross - discount).alias("total_amount_net_with_discount_lc"),
        _tag("store_", _m("o_custkey", 10)).alias("store_name"),
        _m("o_custkey", 10).alias("vendor_id"),
        F.expr("timestampadd(MINUTE, o_orderkey % 1440, o_orderdate)").alias("order_timestamp"),
        F.col("l_partkey").alias("sku_id"),
        _m("l_quantity", 6).alias("ordered_quantity"),
        gross.alias("total_amount_sold_net_lc"),
        _dec(gross * F.lit(Decimal("0.70"))).alias("total_cogs_sold_net_lc"),
        discount.alias("pcm_discount_amount_net_lc"),
        F.when(F.col("l_returnflag") == "R", F.lit("multi-buy")).alias("pcm_discount_subtype"),
        _pick(_m("l_linenumber", 4), ["SEGMENT_USER", "new_user", "SUBSCRIBED_USER", None]).alias("target_audience"),
        _pick(_m("l_suppkey", 4), ["x test ild y", "a_category_b", "summer", None]).alias("campaign_name"),
        _pick(_m("l_partkey", 4), ["Expiring Soon", "overstock", "growth", None]).alias("campaign_purpose"),
        F.lit("pe").alias("country_code"),
        F.when(F.col("o_orderstatus") == "O", F.lit("PENDING")).otherwise(F.lit("CONFIRMED")).alias("state"),
    )


def _skus(t):
    li, p = t["lineitem"], t["part"]
    pairs = li.select("l_partkey", "l_suppkey").distinct()
    return pairs.join(p, pairs.l_partkey == p.p_partkey).select(
        F.col("l_partkey").alias("sku"),
        F.lpad(F.col("l_suppkey").cast("string"), 6, "0").alias("piece_barcode"),
        F.col("p_type").alias("level_1"),
        F.col("p_brand").alias("level_2"),
        _tag("size_", _m("p_size", 5)).alias("level_3"),
        F.col("p_name").alias("level_4"),
        F.lit("pe").alias("country_code"),
    )


def _level0(t):
    level0 = (F.when(F.col("p_type").isin("STANDARD", "ECONOMY"), F.lit("Dry"))
              .when(F.col("p_type").isin("SMALL", "MEDIUM"), F.lit("Fresh"))
              .when(F.col("p_type") == "LARGE", F.lit("Ultra Fresh")))
    return (t["part"].select(F.col("p_type").alias("level_1"), level0.alias("level_0"))
            .where(F.col("level_0").isNotNull()).distinct())


def _lifecycle(t):
    cm = _months(t).where(F.col("o_custkey").isNotNull())
    mine = Window.partitionBy("o_custkey")
    x = (cm.select("o_custkey", "om", F.min("first_in").over(mine).alias("first_date"),
                   F.lag("om").over(mine.orderBy("om")).alias("prev_om"))
         .withColumn("first_month", F.trunc("first_date", "MM")))
    status = (F.when(F.col("prev_om").isNull(), F.lit("Adoption"))
              .when(F.col("prev_om") == F.add_months("om", -1),
                    F.when(F.col("prev_om") == F.col("first_month"), F.lit("M1 Return"))
                    .otherwise(F.lit("Recurring Return")))
              .otherwise(F.lit("Reactivated")))
    months_in = ((F.year("om") * 12 + F.month("om")) - (F.year("first_month") * 12 + F.month("first_month")))
    return x.select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_custkey").alias("id"),
        F.col("first_date").alias("adoption_since"),
        status.alias("type"),
        months_in.cast("int").alias("mes_en_curso"),
        F.col("om").alias("month"),
        F.col("first_date").alias("acquisition_since"),
        F.date_add("first_date", 30).alias("adoption_until"),
        F.date_add("first_date", 10).alias("acquisition_until"),
    )


def _monthly_user_info(t):
    # a customer has one row a month, so the month before is the row before or none
    along = Window.partitionBy("o_custkey").orderBy("om")
    follows = F.col("o_custkey").isNotNull() & (F.add_months(F.lag("om").over(along), 1) == F.col("om"))
    before = {f"p_{c}": F.when(follows, F.lag(f"n_{c}").over(along)) for c in ("all", "f", "ls", "c")}
    cm = _months(t).withColumns(before)
    cu = t["customer"].select("c_custkey", "c_nationkey")
    x = cm.join(cu, cm.o_custkey == cu.c_custkey, "left")
    return x.select(
        F.col("o_custkey").alias("user_id"),
        F.col("om").alias("mes"),
        F.when(_m("o_custkey", 7) == 0, F.lit("Churned")).otherwise(F.lit("Active")).alias("present_month_status_user"),
        F.when(F.col("p_all").isNull(), F.lit("Churned")).otherwise(F.lit("Active")).alias("past_month_status_user"),
        F.col("p_all").alias("dm_past_month_orders"),
        F.col("n_f").alias("f_present_month_orders"),
        F.col("n_ls").alias("ls_present_month_orders"),
        F.col("n_c").alias("c_present_month_orders"),
        F.col("p_f").alias("f_past_month_orders"),
        F.col("p_ls").alias("ls_past_month_orders"),
        F.col("p_c").alias("c_past_month_orders"),
        F.when(_m("c_nationkey", 2) == 0, F.lit("Perú")).otherwise(F.lit("Chile")).alias("country_name"),
    )


def _payments(t):
    return _line_orders(t).select(
        F.col("l_orderkey").alias("order_id"),
        _tag("BANK_", _m("l_suppkey", 5)).alias("issuer"),
        F.col("l_returnflag").alias("card_operation_type"),
        F.col("l_linestatus").alias("provider"),
        _m("o_custkey", 10).alias("restaurant_id"),
        F.lit(7).alias("country_id"),
        F.when(_m("l_linenumber", 3) == 0, F.lit("REJECTED")).otherwise(F.lit("ACCEPTED")).alias("payment_state"),
        F.col("o_orderdate").alias("date_created"),
    )


def _vendors(t):
    return t["orders"].select(_m("o_custkey", 10).alias("codigo")).distinct()


def _fact_orders(t):
    o = t["orders"]
    k = F.col("o_orderkey")
    return o.select(
        k.alias("order_id"),
        F.struct(F.when(_m(k, 50) == 0, F.lit(None).cast("bigint")).otherwise(F.col("o_custkey")).alias("id")).alias("user"),
        F.col("o_custkey").alias("customer_id"),
        F.struct((F.lit(30) + _m(k, 30)).cast("int").alias("maxMinutes"),
                 (F.lit(10) + _m(k, 10)).cast("int").alias("minMinutes")).alias("promisedDeliveryTime"),
        F.when(_m(k, 11) == 0, F.lit(None).cast("double"))
        .otherwise(_m(k, 4).cast("double") * F.lit(0.25)).alias("delivery_fee_revenue"),
        (F.col("o_totalprice") / F.lit(100.0)).alias("shipping_amount_no_discount"),
        (F.col("o_totalprice") / F.lit(200.0)).alias("shipping_amount"),
        _m(k, 5000).cast("double").alias("distance_meters"),
        _flag(_m("o_custkey", 3) == 0).alias("is_user_plus"),
        F.col("o_totalprice").alias("total_amount"),
        _flag(_m(k, 13) == 0).alias("has_bins_discount"),
        F.col("o_orderdate").alias("registered_date"),
    )


def _coupons(t):
    k = F.col("o_orderkey")
    return t["orders"].where(_m(k, 4) == 0).select(
        k.alias("order_id"),
        F.when(_m(k, 19) == 0, F.lit(-1.0)).otherwise(_m(k, 8).cast("double")).alias("coupon_used_amount"))


def _user_lifecycle(t):
    c = F.col("c_custkey")
    return t["customer"].select(
        c.alias("user_id"),
        _pick(_m(c, 3), ["healthy", "at_risk", "critical"]).alias("health_status"),
        F.col("c_mktsegment").alias("intermittency_type"),
        _tag("funnel_", _m(c, 4)).alias("funnel"),
        F.when(_m(c, 9) == 0, F.lit(None).cast("string")).otherwise(_tag("stage_", _m(c, 5))).alias("lifecycle_stage"),
    )


def _user_income(t):
    c = F.col("c_custkey")
    gender = F.when(_m(c, 2) == 0, F.lit("F")).otherwise(F.lit("M"))
    return t["customer"].select(
        c.alias("user_id"),
        (F.lit(18) + _m(c, 50)).cast("int").alias("age"),
        F.when(_m(c, 50) < 12, F.lit("18-29")).when(_m(c, 50) < 27, F.lit("30-44")).otherwise(F.lit("45+")).alias("age_group"),
        gender.alias("gender"),
        F.when(_m(c, 9) == 0, F.lit(None).cast("string")).otherwise(gender).alias("gender_merged"),
        _tag("age_", _m(c, 6)).alias("dh_age_prediction"),
        F.when(_m(c, 5) == 0, F.lit(None).cast("string")).when(_m(c, 3) == 0, F.lit("F"))
        .otherwise(F.lit("M")).alias("dh_gender_prediction"),
        F.col("c_mktsegment").alias("cell_segment"),
        F.col("c_acctbal").alias("income"),
        _tag("seg_", _m("c_nationkey", 4)).alias("segment"),
        _tag("grp_", _m(c + F.col("c_nationkey"), 7)).alias("user_demographic_group"),
    )


def _cm_key(cm: DataFrame) -> Column:
    return F.col("o_custkey") + F.month("om")


def _clusters(t):
    cm = _months(t).where(_m("o_custkey", 2) == 0)
    return cm.select(F.col("o_custkey").alias("user_id"), F.col("om").alias("mes"),
                     _m(_cm_key(cm), 5).cast("int").alias("n_cluster"))


def _crm(t):
    k = F.col("o_orderkey")
    o = t["orders"].where((_m(k, 4) == 0) & (_m(k, 12) != 0))
    return o.select(
        k.alias("order_id"),
        _pick(_m(k, 5), ["RMO", "RMA", "RAF", "OTHER", None]).alias("type"),
        _tag("cseg_", _m(k, 3)).alias("segment"),
        _tag("niv_", _m(k, 2)).alias("nivel"),
        _pick(_m(k, 3), ["acquisition", "retention", "reactivation"]).alias("funnel"),
        F.lit("promo").alias("purpose"),
        _tag("camp_", _m(k, 7)).alias("campaign"),
        _m(k, 100).alias("campaign_id"),
        F.when(_m(k, 7) == 0, F.lit("DMART")).otherwise(F.lit("FOOD")).alias("crm_vertical"),
        _tag("lc_", _m("o_custkey", 3)).alias("crm_lifecycle"),
        F.when(_m(k, 2) == 0, F.lit("crm")).otherwise(F.lit("partner")).alias("coupon_origin"),
    )


def _dps(t):
    k = F.col("o_orderkey")
    return t["orders"].select(
        k.alias("order_id"),
        _m(k, 3000).cast("double").alias("dropoff_distance_manhattan_m"),
        (_m(k, 40) - F.lit(10)).cast("double").alias("order_delay_mins"),
        _m(k, 20).alias("scheme_id"),
        F.lit(30.0).alias("dps_minimum_order_value_local"),
        (_m(k, 4).cast("double") * F.lit(0.5)).alias("dps_delivery_fee_local"),
        (F.col("o_totalprice") / F.lit(1000.0)).alias("dps_basket_value_fee_local"),
        (_m(k, 2) == 0).alias("is_df_discount_basket_value_deal"),
        F.col("o_orderdate").alias("registered_date"),
    )


def _bines(t):
    k = F.col("o_orderkey")
    p = F.col("o_totalprice")
    return t["orders"].where(_m(k, 13) == 0).select(
        k.alias("order_id"),
        _pick(_m(k, 3), ["Plus en PedidosYa Market", "Tarifa Fija Plus", "Banco X"]).alias("descuento"),
        (p / F.lit(100.0)).alias("aporte_peya"),
        (p / F.lit(200.0)).alias("aporte_banco"),
        (p / F.lit(400.0)).alias("aporte_partner"),
        (p / F.lit(50.0)).alias("inv_peya_en_lcy"),
        (p / F.lit(80.0)).alias("inv_bancos_en_lcy"),
        (p / F.lit(160.0)).alias("inv_partner_en_lcy"),
    )


def _missions(t):
    cm = _months(t)
    return cm.select(F.col("o_custkey").alias("user_id"), F.col("om").alias("month"),
                     _pick(_m(_cm_key(cm), 3), ["Stock Up", "Fill In", "Instant Need"]).alias("category"))


def _behaviour(t):
    cm = _months(t)
    return cm.select(F.col("o_custkey").alias("user_id"), F.col("om").alias("month"),
                     _tag("cluster_", _m(_cm_key(cm), 4)).alias("dmart_cluster"),
                     _tag("final_", _m(_cm_key(cm), 3)).alias("final_dm_cluster"))


def _complaints(t):
    j = _line_orders(t).where(F.col("l_returnflag") == "R")
    gross = _dec(F.col("l_extendedprice"))
    return j.select(
        F.col("l_orderkey").alias("order_number"),
        F.col("o_custkey").alias("customer_id"),
        _tag("CCR", _m("l_suppkey", 3)).alias("ccr1"),
        _tag("CCR2_", _m("o_orderkey", 2)).alias("ccr2"),
        _tag("CCR3_", _m("o_custkey", 3)).alias("ccr3"),
        F.when(_m("o_custkey", 10) == 0, F.lit("Y")).otherwise(F.lit("N")).alias("user_fraud"),
        _tag("trust_", _m("o_custkey", 4)).alias("user_trust_segment"),
        F.when(_m("o_orderkey", 2) == 0, F.lit("app")).otherwise(F.lit("web")).alias("case_origin"),
        gross.alias("amount"),
        _dec(gross * F.lit(Decimal("0.25"))).alias("euros"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("case_number"),
        F.lit("Perú").alias("country"),
        F.to_date("o_orderdate").alias("order_date"),
    )


def _orders_pe(t):
    o = t["orders"]
    ship = t.get("line_orders", t["lineitem"]).groupBy("l_orderkey").agg(F.min("l_shipdate").alias("first_ship"))
    k = F.col("o_orderkey")
    actual = (F.datediff(F.to_date("first_ship"), F.to_date("o_orderdate")) % 70).cast("double")
    promised = (F.lit(30) + _m(k, 25)).cast("double")
    j = o.join(ship, o.o_orderkey == ship.l_orderkey, "left")
    return j.select(
        k.alias("order_id"),
        _m(k, 15).cast("double").alias("estimated_prep_time"),
        _m(k, 20).cast("double").alias("updated_prep_time"),
        _m(k, 25).cast("double").alias("to_customer_time"),
        promised.alias("timing_promised_delivery_time"),
        actual.alias("actual_delivery_time"),
        _flag(actual > promised + F.lit(10)).alias("is_order_late_10"),
        _flag(_m(k, 6) == 0).alias("is_vendor_late"),
        _flag(_m(k, 9) == 0).alias("count_orders_inaccuracy"),
        _flag(_m(k, 17) == 0).alias("is_pre_order"),
        F.lit(1).alias("total_orders_vl"),
        _m(k, 3000).cast("double").alias("dropoff_distance_manhattan"),
        _flag(_m(k, 5) == 0).alias("is_stacked"),
        _m(k, 12).cast("double").alias("hold_back_time"),
        F.col("o_orderdate").alias("created_date"),
    )


def _growth(t):
    cm = _months(t)
    key = _cm_key(cm)
    c = F.col("o_custkey")
    return cm.select(
        c.alias("user_id"),
        F.col("om").alias("month"),
        _tag("bop0_", _m(key, 2)).alias("bop_level_0"),
        _tag("bop1_", _m(key, 3)).alias("bop_level_1"),
        _tag("bop2_", _m(key, 4)).alias("bop_level_2"),
        F.when(_m(c, 3) == 0, F.lit("plus")).otherwise(F.lit("regular")).alias("benefit_segment"),
        F.col("om").alias("month_dechurned"),
        F.col("n_all").alias("platform_current_frequency"),
        (_m(key, 2) == 0).alias("sundays_boolean"),
        (_m(key, 2) == 1).alias("sundays_boolean_last_month"),
        _tag("act_", _m(c, 3)).alias("activated_by"),
        _tag("act_", _m(c + F.lit(1), 3)).alias("last_month_activated_by"),
        _tag("freq_", F.least(F.col("n_all"), F.lit(3))).alias("user_dmart_frequency_interval"),
        _tag("cat_", _m(c, 4)).alias("dmart_category_range"),
        _tag("life_", _m(F.month("om"), 3)).alias("dmart_lifetime_stage"),
        _tag("pl_", _m(c, 2)).alias("plus_dmarts_lifecycle"),
        _tag("ret_", _m(key, 5)).alias("user_range_retention_tag"),
    )


def _shop(t):
    k = F.col("o_orderkey")
    return t["orders"].where(_m(k, 5) != 4).select(
        k.alias("order_id"),
        _pick(_m(k, 5), ["Stock Up", "Fill In", "Instant Need", None]).alias("mission_type"),
        F.col("o_orderdate").alias("registered_date"),
    )
