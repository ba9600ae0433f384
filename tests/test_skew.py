"""The customer stage equals plain joins + plain windows when one customer holds a third of
the orders, some customers are NULL, and customer / customer-month sources fan out."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from mart_paths import SF_SMALL
from ordermart import config as C
from ordermart.functions import rules as R
from ordermart.functions.dates import iso_weekday
from ordermart.functions.numeric import flag
from ordermart.operators.joins import enrich
from ordermart.pipeline import TEST_CONFIG
from ordermart.plans import mart as M
from ordermart.plans import users as U
from ordermart.sources.adapters import build_roles, read_tables
from ordermart.sources.spec import load_all


def skewed_sources(spark, times="as they are"):
    raw = build_roles(read_tables(spark, SF_SMALL))
    k = F.col("order_id")
    raw["customer_orders_sku_level"] = raw["customer_orders_sku_level"].withColumn(
        "customer_id", F.when(k % 3 == 0, F.lit(7)).when(k % 17 == 0, F.lit(None).cast("bigint"))
        .otherwise(F.col("customer_id")))
    if times != "as they are":
        lines = raw["customer_orders_sku_level"]
        kind = lines.schema["order_timestamp"].dataType
        value = F.lit(None).cast(kind) if times == "null" else F.date_trunc("day", "order_timestamp").cast(kind)
        raw["customer_orders_sku_level"] = lines.withColumn("order_timestamp", value)
    inc = raw["user_income"]
    raw["user_income"] = inc.unionByName(inc.where(F.col("user_id") % 5 == 0).withColumn("age", F.col("age") + 1))
    pm = raw["dmart_purchase_missions"]
    raw["dmart_purchase_missions"] = pm.unionByName(
        pm.where(F.col("user_id").isin(7, 10)).withColumn("category", F.lit("Extra")))
    return load_all(raw, TEST_CONFIG)


def naive_mart(src, cfg):
    s = M.O.customer_orders(src["customer_orders_sku_level"],
                            M.O.prep_skus_pim(src["skus_pim_dmart"], src["pim_level_0_bis"]))
    s = s.withColumns({"k_cust": F.coalesce("join_customer_id", F.lit("\u0000")),
                       "week_of_year": M.week_of_year_sunday(M.week_monday("order_date")),
                       "_mission": R.shopping_mission("fulfilled", "categories")})
    users = U.user_months(src, cfg)
    df = enrich(s, M.order_joins(src) + [M.user_month_join(users)] + M.customer_month_joins(src)
                + M.customer_joins(src))
    c = Window.partitionBy("join_customer_id")
    cm = Window.partitionBy("join_customer_id", "join_order_month")
    order = [F.col(x).asc_nulls_first() for x in [*M.FIRST_ORDER, *M.FANOUT_ORDER, *M.ROW_ORDER]]
    first = R.first_order_expressions("order_date", "d_acq_since", "d_acq_until", "is_ild", "coupon_used_amount",
                                      "plus_order", "plus_item_level", "coupon_campaign", "coupon_funnel",
                                      "crm_vertical")
    act = R.month_activation_expressions("coupon_used_amount", "plus_order", "plus_item_level", "crm_vertical")
    fo = [F.col(x).asc_nulls_first() for x in M.FIRST_ORDER]
    df = df.withColumns({
        "order_number": F.row_number().over(c.orderBy(*order)).cast("bigint"),
        "order_num_month": F.row_number().over(cm.orderBy(*order)).cast("bigint"),
        **{n: F.first(e).over(c.orderBy(*fo)) for n, e in first.items()},
        **{n: F.first(e).over(cm.orderBy(*fo)) for n, e in act.items()},
        "wsd_start_day": F.min(iso_weekday("order_date")).over(Window.partitionBy("join_customer_id", "week_of_year")),
        "has_stock_up_mission": F.max(flag(F.col("mission_type") == "Stock Up")).over(cm),
        "has_fill_in_mission": F.max(flag(F.col("mission_type") == "Fill In")).over(cm),
        "user_has_stock_up_v2": F.max(flag(F.col("_mission") == "Stock Up")).over(cm),
        "user_has_fill_in_v2": F.max(flag(F.col("_mission") == "Fill In")).over(cm),
    })
    return M.final_projection(df)


def by_order(df):
    nums = defaultdict(list)
    rest = Counter()
    cols = [c for c in C.OUTPUT_COLUMNS if c not in ("order_number", "order_num_month")]
    for r in df.select("order_id", "order_number", "order_num_month", *cols).collect():
        nums[r["order_id"]].append((r["order_number"], r["order_num_month"]))
        rest[tuple(str(r[c]) for c in cols)] += 1
    ranges = {k: (sorted(a for a, _ in v), sorted(b for _, b in v)) for k, v in nums.items()}
    return ranges, rest


@pytest.mark.parametrize("times", ["as they are", "null", "midnight"])
def test_customer_stage_matches_plain_windows_under_skew_and_fan_out(spark, times):
    src = skewed_sources(spark, times)
    fast = M.order_mart(src, TEST_CONFIG)
    plain = naive_mart(src, TEST_CONFIG)
    rf, cf = by_order(fast)
    rp, cp = by_order(plain)
    assert cf == cp          # every published column but the running numbers, as a multiset
    assert rf == rp          # each order gets the same block of running numbers
    hot = fast.where(F.col("sku_level_customer_id") == 7).count()
    assert hot > fast.count() / 4
    assert fast.where(F.col("sku_level_customer_id").isNull()).count() > 0
    assert fast.count() > fast.select("order_id").distinct().count()  # fan-out happened
