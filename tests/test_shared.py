"""Steps that the whole mart shares: tables written once for several roles, sources read once, months made only where they are read."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from mart_paths import SF_SMALL
from ordermart import session
from ordermart.config import RunConfig
from ordermart.operators.bitsets import codes_of
from ordermart.operators.joins import JoinSpec, enrich, meet
from ordermart.operators.keyfilter import key_filter
from ordermart.pipeline import TEST_CONFIG, shared_sources, test_sources
from ordermart.plans import mart as M
from ordermart.plans import orders as O
from ordermart.plans import users as U
from ordermart.queries import SPARK
from ordermart.session import cut_lineage
from ordermart.sources.adapters import build_roles, customer_months, shared_tables
from ordermart.sources.spec import load_all

CFG = RunConfig(as_of=dt.date(2024, 3, 15), spine_end=dt.date(2024, 9, 1))


def _rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def _tables(spark):
    """Orders, lines, parts and customers with gaps between months, NULL keys and dates, and keys that come twice."""
    rng = random.Random(5)
    some = lambda *of: rng.choice([*of, None] if rng.random() < 0.3 else of)
    orders = [(some(*range(40)), some(*range(8)), some("O", "F", "P"), some(10.0, 2000.5),
               some(*[dt.datetime(2024, m, d) for m in range(1, 9) for d in (1, 9, 28)]), some("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW")) for _ in range(90)]
    lines = [(some(*range(42)), some(*range(6)), some(*range(5)), some(1, 2, 3, 4), some(1.0, 5.0, 12.0), some(99.5, 1000.25), some(0.0, 0.05),
              0.1, some("R", "A", "N"), some("O", "F"), some(dt.datetime(2024, 5, 3), dt.datetime(2024, 6, 7))) for _ in range(300)]
    parts = [(k, f"name {k}", f"brand {(k or 0) % 3}", rng.choice(["SMALL", "LARGE", "PROMO"]), k, 1.0) for k in [*range(5), 4, None]]
    customers = [(k, f"c{k}", None if k == 2 else k, 5.0 * (k or 0), "AUTO") for k in [*range(7), 3, None]]
    return {
        "orders": spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
        "part": spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        "customer": spark.createDataFrame(customers, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")}


def test_sources_over_shared_tables_are_the_same(spark):
    t = _tables(spark)
    plain, shared = (load_all(build_roles(x), CFG) for x in (t, shared_tables(t, CFG.period_start, cut_lineage)))
    assert plain.keys() == shared.keys()
    for name in plain:
        assert plain[name].dtypes == shared[name].dtypes, name
        assert _rows(plain[name]) == _rows(shared[name]), name
    assert plain["fact_payments_transaction"].count() and plain["orders_pe"].where("actual_delivery_time IS NOT NULL").count()


def test_month_before_by_window_is_the_self_join(spark):
    t = _tables(spark)
    cm = customer_months(t["orders"])
    prev = cm.select(F.col("o_custkey").alias("p"), F.add_months("om", 1).alias("next"), F.col("n_all").alias("before"))
    want = cm.join(prev, (F.col("o_custkey") == F.col("p")) & (F.col("om") == F.col("next")), "left").select("o_custkey", "om", "before").distinct()
    got = build_roles(t, ["monthly_user_info"])["monthly_user_info"].select(F.col("user_id").alias("o_custkey"), F.col("mes").alias("om"), F.col("dm_past_month_orders").alias("before"))
    assert _rows(got.distinct()) == _rows(want)
    o = t["orders"]
    first = o.groupBy("o_custkey").agg(F.min(F.to_date("o_orderdate")).alias("first"))
    want = cm.join(first, "o_custkey").select(F.col("o_custkey").alias("id"), F.col("om").alias("month"), "first",
                                              F.lag("om").over(Window.partitionBy("o_custkey").orderBy("om")).isNull().alias("adopts"))
    got = build_roles(t, ["first_dmart_order_date_users"])["first_dmart_order_date_users"].select(
        "id", "month", F.col("adoption_since").alias("first"), (F.col("type") == "Adoption").alias("adopts"))
    assert _rows(got) == _rows(want)


def test_mart_reads_the_lines_table_twice(spark):
    """Once for all that is made of lines and their orders, once for the catalogue."""
    plans = []
    cut = lambda df, name: (plans.append(df._jdf.queryExecution().executedPlan().toString()), cut_lineage(df, name))[1]
    mart = M.order_mart(shared_sources(spark, SF_SMALL, cut=cut), TEST_CONFIG, cut=cut, columns=["order_id", "late_order"])
    plans.append(mart._jdf.queryExecution().executedPlan().toString())
    reads = [line for plan in plans for line in plan.splitlines() if "FileScan parquet" in line and "lineitem.parquet" in line]
    assert len(reads) == 2, reads


def test_mart_over_shared_tables_is_the_same(spark):
    got, want = (M.order_mart(src, TEST_CONFIG) for src in (shared_sources(spark, SF_SMALL), test_sources(spark, SF_SMALL)))
    assert got.dtypes == want.dtypes and _rows(got) == _rows(want)


def test_sources_meet_as_by_left_joins_to_their_keys(spark):
    rng = random.Random(3)
    side = lambda c: spark.createDataFrame([(rng.choice("abcd") if rng.random() < 0.9 else None, rng.choice([1, 2, None]), i) for i in range(9)], f"u string, m int, {c} int")
    specs = [JoinSpec(side(c), ["u", "m"], ["u", "m"], {f"x_{c}": c}) for c in "pqr"]
    keys = specs[0].right.select("u", "m").union(specs[1].right.select("u", "m")).union(specs[2].right.select("u", "m")).dropna().distinct()
    assert _rows(meet(specs, ["u", "m"])) == _rows(enrich(keys, specs))


def test_only_read_months_are_made(spark):
    """Months of a user that no order reads are left out after the windows; the others' values stay."""
    src = test_sources(spark, SF_SMALL)
    read = U.months_read(src["customer_orders_sku_level"], src["fact_orders"]).cache()
    floor, known = U.spine_floor(TEST_CONFIG), U.known_users(src)
    got = U.user_months(known, TEST_CONFIG, floor, read)
    every = U.user_months(known, TEST_CONFIG, floor, read.select("join_user_id"))
    wanted = read.select("join_user_id", F.explode(U.MONTHS_READ).alias("join_month"))
    assert _rows(got) == _rows(every.join(wanted, ["join_user_id", "join_month"], "left_semi"))
    assert got.where("type IS NULL").count() < every.where("type IS NULL").count()
    # orders of no known user, and users without an order line, ask for none
    lines = spark.createDataFrame([("1", dt.date(2024, 1, 1)), ("1", dt.date(2024, 1, 1)), ("2", dt.date(2024, 2, 1)), ("3", None), (None, dt.date(2024, 1, 1))],
                                  "join_order_id string, join_order_month date")
    fact = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "a"), ("2", None), ("3", "c"), ("4", "d"), (None, "e")], "join_order_id string, join_user_id string")
    assert {r[0]: sorted(r[1]) for r in U.months_read(lines, fact).collect()} == {
        "a": [dt.date(2024, 1, 1), dt.date(2024, 2, 1)], "b": [dt.date(2024, 1, 1)], "c": []}


def test_rollup_counts_categories_as_bits(spark):
    t = _tables(spark)
    src = load_all(build_roles(t), CFG)
    whole = O.prep_skus_pim(src["skus_pim_dmart"], src["pim_level_0_bis"])
    skus = O.prep_skus_pim(src["skus_pim_dmart"], src["pim_level_0_bis"], O.ROLLUP_PAYLOAD)
    few = [c for c in skus.columns]
    assert few == ["join_sku", *O.ROLLUP_PAYLOAD] and _rows(skus) == _rows(whole.select(*few))
    skus = skus.withColumn("level_2", F.when(F.col("join_sku") != "1", F.col("level_2")))  # a SKU without a category
    plain = O.customer_orders(src["customer_orders_sku_level"], skus)
    bits = O.customer_orders(src["customer_orders_sku_level"], skus, codes=codes_of(skus, "level_2", 10))
    assert plain.dtypes == bits.dtypes and _rows(plain) == _rows(bits)
    assert plain.where("categories > 1").count()
    assert "count(distinct" not in bits._jdf.queryExecution().optimizedPlan().toString()


def test_only_read_values_are_written(spark):
    """What a query's columns aren't made of is in none of the written tables, and its rows are the mart's."""
    src = test_sources(spark, SF_SMALL)
    whole = M.order_mart(src, TEST_CONFIG).cache()
    of_first = {"_first_m", "_first_c", "_wmin"}
    for columns, held in ((["inaccuracy_late", "month_activation_source"], {"_first_m"}), (["wsd_week_and_day", "adoption_class"], {"_wmin", "_first_c"}),
                          (["order_num_month", "dh_shopping_mission_user_v2", "afv_segment"], set())):
        read, written = ["order_id", *M.FANOUT_ORDER, *columns], {}
        cut = lambda df, name: (written.__setitem__(name, df.columns), cut_lineage(df, name))[1]  # noqa: E731, B023
        few = M.order_mart(src, TEST_CONFIG, cut=cut, columns=read)
        assert few.columns == read and _rows(few) == _rows(whole.select(*read)), columns
        assert of_first & set(written["fine"]) == held, columns
        assert ("total_amount_sold_net_lc" in written["lines"]) == ("afv_segment" in columns)
        assert "total_cogs_sold_net_lc" not in written["lines"] and ("mission_type" in written["orders"]) == ("order_num_month" in columns)
    whole.unpersist()


def test_rollup_of_some_columns_is_the_same(spark):
    src = load_all(build_roles(_tables(spark)), CFG)
    skus = O.prep_skus_pim(src["skus_pim_dmart"], src["pim_level_0_bis"], O.ROLLUP_PAYLOAD)
    lines = src["customer_orders_sku_level"]
    whole = O.customer_orders(lines, skus)
    for c in [c for c in whole.columns if c not in O.ORDER_KEYS]:
        few = O.customer_orders(lines.select(*O.line_reads([c])), skus, columns={c})
        assert dict(few.dtypes)[c] == dict(whole.dtypes)[c] and _rows(few.select(*O.ORDER_KEYS, c)) == _rows(whole.select(*O.ORDER_KEYS, c)), c


def test_lines_are_rolled_up_once(spark):
    """L16's orders, users and months are a table of their own; the rollup isn't made again for them."""
    plans = {}
    cut = lambda df, name: (plans.__setitem__(name, df._jdf.queryExecution().optimizedPlan().toString()), cut_lineage(df, name))[1]
    src = test_sources(spark, SF_SMALL)
    M.order_mart(src, TEST_CONFIG, cut=cut, columns=["order_id", "late_order"])
    assert plans["orders"].count("RepartitionByExpression [join_order_id") == 1
    got = U.order_users(src["customer_orders_sku_level"], src["fact_orders"])
    rows = M.enrich(O.customer_orders(src["customer_orders_sku_level"], O.prep_skus_pim(src["skus_pim_dmart"], src["pim_level_0_bis"])), M.order_joins(src))
    assert _rows(got) == _rows(rows.select(*got.columns).distinct())
    lines = spark.createDataFrame([("1", None), ("1", None), ("2", dt.date(2024, 2, 1)), (None, dt.date(2024, 1, 1))], "join_order_id string, join_order_month date")
    fact = spark.createDataFrame([("1", "a"), ("1", "a"), ("1", None), (None, "b")], "join_order_id string, join_user_id string")
    assert sorted(map(tuple, U.order_users(lines, fact).collect()), key=str) == sorted(
        [("1", "a", None), ("1", None, None), ("2", None, dt.date(2024, 2, 1)), (None, None, dt.date(2024, 1, 1))], key=str)


def test_no_other_months_are_generated(spark):
    src = test_sources(spark, SF_SMALL)
    read = U.months_read(src["customer_orders_sku_level"], src["fact_orders"])
    plan = U.user_months(U.known_users(src), TEST_CONFIG, U.spine_floor(TEST_CONFIG), read)._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(" not in plan


def test_months_of_a_run_that_are_read(spark):
    day = dt.date
    rows = [("a", day(2024, 1, 1), day(2024, 5, 1), [day(2023, 12, 1), day(2024, 1, 1), day(2024, 3, 1), day(2024, 6, 1)]),
            ("b", day(2024, 2, 1), day(2024, 2, 1), [day(2024, 2, 1)]), ("c", day(2024, 2, 1), day(2024, 4, 1), [])]
    df = spark.createDataFrame(rows, f"join_user_id string, join_month date, {U.RUN_END} date, {U.MONTHS_READ} array<date>") \
        .selectExpr("*", "'x' AS dmart_growth_status_past_month", f"'y' AS {U.TWO_BEFORE}", "1L AS _rows_of_month")
    got = U.idle_months(df, {"dmart_growth_status_past_month": "dmart_growth_status"})
    idle = spark.range(1).select(U.idle_status().alias("s")).first().s
    assert sorted(map(tuple, got.select("join_user_id", "join_month", "dmart_growth_status_past_month", U.TWO_BEFORE).collect())) == [
        ("a", day(2024, 1, 1), "x", "y"), ("a", day(2024, 3, 1), idle, idle), ("b", day(2024, 2, 1), "x", "y")]


def test_whole_users_are_not_sliced(spark):
    """Without a limit the windows see whole keys: no join, no aggregate."""
    src = test_sources(spark, SF_SMALL)
    missions = src["dmart_purchase_missions"]
    plain, split = (O.prep_purchase_missions(missions, limit) for limit in (0, 2))
    assert _rows(plain) == _rows(split)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert plan(plain).count("Join") == plan(missions).count("Join") and plan(plain).count("Aggregate") == plan(missions).count("Aggregate")


def test_tables_that_nothing_reads_any_more_are_deleted(spark):
    """Of the tables a mart query writes, only those that its rows are read from stay."""
    before = len(session._written)
    rows = SPARK["week_start_day"](spark, SF_SMALL)
    assert sorted(path.split("/ordermart-")[1].rsplit("-", 1)[0] for _, path in session._written[before:]) == ["fine", "matches", "orders"]
    assert _rows(rows) == _rows(M.order_mart(test_sources(spark, SF_SMALL), TEST_CONFIG, columns=rows.columns))
    seen = []  # a caller's own tables stay

    def cut(df, name):
        seen.append(cut_lineage(df, name))
        return seen[-1]
    M.order_mart(test_sources(spark, SF_SMALL), TEST_CONFIG, cut=cut, columns=["order_id"])
    assert len(seen) > 3 and all(t.count() >= 0 for t in seen)


def test_lookups_read_the_smallest_table(spark, monkeypatch):
    """The categories of a user month are looked up in the lines as they are, the filter's keys in the orders."""
    looked, keyed = [], []
    monkeypatch.setattr(U, "codes_of", lambda df, *a: (looked.append(df._jdf.queryExecution().optimizedPlan().toString()), codes_of(df, *a))[1])
    monkeypatch.setattr(M, "key_filter", lambda df, *a: (keyed.append(df.columns), key_filter(df, *a))[1])
    src = test_sources(spark, SF_SMALL)
    M.order_mart(src, TEST_CONFIG, columns=["order_id"])
    assert len(looked) == 1 and "Join" not in looked[0]
    assert keyed == [["join_order_id", "o1_join_user_id", "join_order_month"]]
    lines = load_all(build_roles(_tables(spark)), CFG)["customer_orders_sku_level"]
    few = lines.where("join_customer_id IN ('1', '3')")
    want = _rows(U.user_monthly_orders(few))
    assert want and all(_rows(U.user_monthly_orders(few, limit, lines)) == want for limit in (0, 1, 64))
