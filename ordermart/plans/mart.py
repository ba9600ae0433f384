"""C15 (order enrichment) and C16 (published projection), plus ``publish`` (K1).

Plan shape of the wide side (one row per order, times join fan-out):

1. order rollup (C14): the lines meet the SKU catalogue (L7) and are hashed on the order key once;
2. nine order-keyed joins (L8 L9 L13 L14 L15 L17 L20 L21 L23) on that partitioning, every
   right side co-partitioned on the order key;
3. L16 on (user of the order fact, month) through narrow (order, user, month) triples
   packed per order and joined back on the order key: no shuffle of the rows;
4. lineage cut (a Parquet table in ``spark.checkpoint.dir``, read back);
5. ``customer_stage``: one aggregate of the rows to narrow (customer, month, week, minute) rows; every
   customer-keyed value is a window or a lookup on those, and the rows are shuffled once to meet them;
6. final projection in the published column order.

Customer keys go through ``null_safe_key`` so the NULL customer, one window partition in
the reference, gets its own aggregates back through a plain equi-join; sources never carry
that key value, so their joins are unchanged.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermart import config as C
from ordermart.config import RunConfig
from ordermart.session import cut_lineage, drop_cut, hash_small_partitions, keeping
from ordermart.functions import rules as R
from ordermart.functions.dates import hour_of, iso_weekday, week_monday, week_of_year_sunday, year_start
from ordermart.functions.numeric import flag, net_of_tax
from ordermart.operators.bitsets import codes_of
from ordermart.operators.joins import JoinSpec, enrich, packed, unpacked
from ordermart.operators.keyfilter import key_filter, prune
from ordermart.operators.slices import SLICE, sliced
from ordermart.operators.windows import group_aggregate, null_safe_key, time_segment
from ordermart.plans import orders as O
from ordermart.plans import users as U

ORDER = ["join_order_id"]
CUST_MONTH = ["k_cust", "join_order_month"]
USER_MONTH = ["join_user_id", "join_month"]
FIRST_ORDER = ["order_timestamp", "order_id"]
# the complaint rollup (L20) is the join that fans out by construction; its columns order the fanned rows
FANOUT_ORDER = ["comp_ccr1", "comp_ccr2", "comp_ccr3", "comp_user_fraud", "comp_case_origin", "user_trust_segment"]


# rows of one order that other sources repeat
ROW_ORDER = ["o1_user_id", "customer_real_id", "coupon_used_amount", "bank", "coupon_campaign", "coupon_campaign_id", "dps_scheme_id",
             "d_bin_campaign", "actual_delivery_time", "mission_type", "type_user", "mes_en_curso", "dmart_growth_status"]


def _known(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key can meet anything: NULL equals no key."""
    return df.where(F.col(key).isNotNull())


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


# sources of order rows without a date that the period could filter
UNDATED = ("fact_talon_coupons", "dim_coupon_crm_attributes", "df090_dma_discounts_bines")


def of_the_period(src: dict[str, DataFrame], cfg: RunConfig, orders: DataFrame | None = None) -> dict[str, DataFrame]:
    """The undated order-keyed sources (L9, L14, L17) without rows that no order of the period can meet: a filter of the
    period's order keys is probed in their scans, so the rest of their history isn't shuffled.  ``orders``: rows with
    every order key of the lines, if there are fewer of them."""
    if not cfg.key_filter_bits:
        return src
    words = key_filter(src["customer_orders_sku_level"] if orders is None else orders, "join_order_id", cfg.key_filter_bits)
    return {**src, **{n: prune(src[n], "join_order_id", words, cfg.key_filter_bits) for n in UNDATED}}


def order_joins(src: dict[str, DataFrame]) -> list[JoinSpec]:
    """L8, L9, L13, L14, L15, L17, L20, L21, L23 — all on the order key."""
    return [
        JoinSpec(src["fact_orders"], ORDER, ["join_order_id"], {
            "o1_user_id": "user_id", "o1_join_user_id": "join_user_id", "customer_real_id": "customer_real_id",
            **_same("maxMinutes", "minMinutes", "delivery_fee_revenue", "shipping_amount_no_discount",
                    "shipping_amount_visualized", "shipping_amount", "plus_order", "total_amount",
                    "has_bins_discount", "is_user_plus")}, name="L8 fact_orders"),
        JoinSpec(src["fact_talon_coupons"], ORDER, ["join_order_id"], _same("coupon_used_amount"), name="L9 coupons"),
        JoinSpec(O.prep_payments(_known(src["fact_payments_transaction"], "join_order_id")), ORDER, ["join_order_id"],
                 _same("bank", "operation_type", "payment_name"), name="L13 payments"),
        JoinSpec(src["dim_coupon_crm_attributes"], ORDER, ["join_order_id"], {
            "v_type": "type", "coupon_segment": "segment", "coupon_nivel": "nivel", "coupon_funnel": "funnel",
            "coupon_purpose": "purpose", "coupon_campaign": "campaign", "coupon_campaign_id": "campaign_id",
            **_same("crm_vertical", "crm_lifecycle", "coupon_origin")}, name="L14 coupon crm"),
        JoinSpec(src["dps_order_info"], ORDER, ["join_order_id"], {
            "dps_dropoff_distance_manhattan_meters": "dropoff_distance_manhattan_m",
            "dps_order_delay_mins": "order_delay_mins", "dps_scheme_id": "scheme_id",
            "dps_mov_lc": "dps_minimum_order_value_local", "dps_df_applied": "dps_delivery_fee_local",
            "dps_basket_value": "dps_basket_value_fee_local",
            "flag_basket_value": "is_df_discount_basket_value_deal"}, name="L15 dps"),
        JoinSpec(src["df090_dma_discounts_bines"], ORDER, ["join_order_id"], {
            "d_bin_campaign": "descuento", "d_aporte_peya": "aporte_peya", "d_aporte_banco": "aporte_banco",
            "d_aporte_partner": "aporte_partner", "d_inv_peya": "inv_peya_en_lcy",
            "d_inv_bancos": "inv_bancos_en_lcy", "d_inv_partner": "inv_partner_en_lcy"}, name="L17 bines"),
        JoinSpec(src["orders_pe"], ORDER, ["join_order_id"], {
            **_same("estimated_prep_time", "updated_prep_time", "to_customer_time",
                    "timing_promised_delivery_time", "actual_delivery_time", "is_order_late_10",
                    "is_vendor_late", "is_pre_order", "hold_back_time"),
            "is_inaccuracy": "count_orders_inaccuracy", "fo_total_orders_vl": "total_orders_vl",
            "fo_dropoff_distance_manhattan": "dropoff_distance_manhattan", "flag_stacked": "is_stacked"},
            name="L21 orders_pe"),
        JoinSpec(src["fact_groceries_shopping_missions"], ORDER, ["join_order_id"], _same("mission_type"),
                 name="L23 shopping missions"),
        JoinSpec(O.complaint_rollup(_known(src["dmarts_customer_compliant"], "join_order_id")), ORDER, ["join_order_id"], {
            "comp_ccr1": "ccr1", "comp_ccr2": "ccr2", "comp_ccr3": "ccr3", "comp_user_fraud": "user_fraud",
            "comp_case_origin": "case_origin", "user_trust_segment": "user_trust_segment"},
            name="L20 complaints (fans out)"),
    ]


def user_month_join(users: DataFrame) -> JoinSpec:
    """Keyed by the user of the order fact (not the line's customer) and the order month."""
    return JoinSpec(users, ["o1_join_user_id", "join_order_month"], USER_MONTH, {
        "cohort_date": "adoption_since", "d_adoption_until": "adoption_until",
        "d_acq_since": "acquisition_since", "d_acq_until": "acquisition_until",
        "mes_en_curso": "mes_en_curso", "type_user": "type",
        **_same("platform_performance", "platform_status", "platform_prior_status",
                "dmart_churn_type_prior_month", "dmart_frec_performance", "dmart_afv_performance",
                "dmart_growth_status_past_month", "dmart_growth_status"),
        "dmart_growth_stage": "dmart_growth_status_fixed", "dmart_last_month_active": "last_month_active",
        "dmart_activation_period": "activation_period"}, name="L16 user months",
        # orders without a user match nothing; keep them from piling into one partition
        spread_nulls_by="join_order_id")


def customer_month_joins(src: dict[str, DataFrame], floor=None, limits: dict[str, int] = {}) -> list[JoinSpec]:
    """L12, L18, L19, L22, all on (customer, month).  ``floor``: the first order month; earlier months of
    the two sources that no look-back reads can't match.  ``limits``: by source, split users of more rows."""
    recent = lambda df: df if floor is None else df.where(F.col("join_month") >= F.lit(floor))
    gt_cols = ("bop_level_0", "bop_level_1", "bop_level_2", "benefit_segment", "platform_current_frequency",
               "month_dechurned", "sundays_boolean", "sundays_boolean_last_month", "activated_by",
               "last_month_activated_by", "dmart_category_range", "user_dmart_frequency_interval",
               "dmart_lifetime_stage", "plus_dmarts_lifecycle", "user_range_retention_tag")
    return [
        JoinSpec(recent(src["peru_clusters"]), CUST_MONTH, USER_MONTH, {"crm_pe_cluster": "n_cluster"}, name="L12 clusters"),
        JoinSpec(O.prep_purchase_missions(_known(src["dmart_purchase_missions"], "join_user_id"), limits.get("dmart_purchase_missions", 0)), CUST_MONTH, USER_MONTH, {
            "dmart_shopping_mission": "category",
            "dmart_pm_shopping_mission_prior_month": "dmart_pm_shopping_mission_prior_month"}, name="L18 missions"),
        JoinSpec(O.prep_behavioural_clustering(_known(src["dmart_behavioural_clustering"], "join_user_id"), limits.get("dmart_behavioural_clustering", 0)), CUST_MONTH, USER_MONTH, {
            "crm_pe_dm_cluster": "final_dm_cluster", "crm_pe_dmart_cluster": "dmart_cluster",
            "crm_pe_dmart_cluster_prior_month": "dmart_cluster_prior_month"}, name="L19 clustering"),
        JoinSpec(recent(src["dmart_growth_tracker"]), CUST_MONTH, USER_MONTH, _same(*gt_cols), name="L22 growth tracker"),
    ]


def user_income_with_max(s11: DataFrame) -> DataFrame:
    """L11's right side with W11 folded in: the customer-wide MAX over the joined rows equals
    the MAX over the customer's income rows, so it is computed here, per user, by an
    aggregate joined back, before the mart join."""
    maxes = group_aggregate(s11.where(F.col("join_user_id").isNotNull()), ["join_user_id"], {
        "gender_merged_max": F.max("gender_merged"), "dh_age_prediction_max": F.max("dh_age_prediction"),
        "dh_gender_prediction_max": F.max("dh_gender_prediction"), "segment_max": F.max("segment"),
        "user_demographic_group_max": F.max("user_demographic_group")})
    return s11.join(maxes, "join_user_id", "left")


def customer_joins(src: dict[str, DataFrame]) -> list[JoinSpec]:
    return [
        JoinSpec(src["agg_user_lifecycle"], ["k_cust"], ["join_user_id"], {
            "health_status": "health_status", "h_int_type": "intermittency_type", "h_funnel": "funnel",
            "h_lifecycle_stage": "lifecycle_stage"}, name="L10 lifecycle"),
        JoinSpec(user_income_with_max(src["user_income"]), ["k_cust"], ["join_user_id"], {
            **_same("u_age", "age_group", "gender"), "gender_merged": "gender_merged_max",
            "dh_age_prediction": "dh_age_prediction_max", "dh_gender_prediction": "dh_gender_prediction_max",
            "u_cell_segment": "u_cell_segment", "u_income": "u_income", "u_segmemnt": "segment_max",
            "u_user_demographic_group": "user_demographic_group_max"}, name="L11 income + W11"),
    ]


# what the mart reads of the order lines: three branches do, from one table
LINE_READS = [*O.ORDER_KEYS, "join_sku_id", "ordered_quantity", "fulfilled_quantity", "total_amount_sold_net_lc",
              "total_amount_net_with_discount_lc", "total_cogs_sold_net_lc", "pcm_discount_amount_net_lc", "pcm_discount_subtype",
              "target_audience", "ild_amount", U.CATEGORY]

# what the customer stage reads of the order rows, whatever its caller does
STAGE_READS = ["k_cust", "join_order_id", "join_order_month", "week_of_year", *FIRST_ORDER]
NUMBERS = ("order_number", "order_num_month")
MONTH_FIRST = ("month_activation_source", "month_activation_funnel_source")
CUSTOMER_FIRST = ("adoption_origin", "adoption_class", "adoption_class_test", "adoption_coupon_used", "adoption_funnel_used",
                  "adoption_vertical_attributed")
# what it reads beside these for its values.  Values of one first row are found together: rows that tie are told apart by all of them
STAGE_VALUES = {
    **dict.fromkeys(NUMBERS, (*FANOUT_ORDER, *ROW_ORDER)),
    **dict.fromkeys(MONTH_FIRST, ("coupon_used_amount", "plus_order", "plus_item_level", "crm_vertical")),
    **dict.fromkeys(CUSTOMER_FIRST, ("order_date", "d_acq_since", "d_acq_until", "is_ild", "coupon_used_amount", "plus_order", "plus_item_level",
                                     "coupon_campaign", "coupon_funnel", "crm_vertical")),
    "wsd_start_day": ("order_date",),
    **dict.fromkeys(("has_stock_up_mission", "has_fill_in_mission"), ("mission_type",)),
    **dict.fromkeys(("user_has_stock_up_v2", "user_has_fill_in_v2"), ("_mission",)),
}


def any_read(names, columns) -> bool:
    return columns is None or bool({*names} & {*columns})


def stage_reads(columns) -> list[str]:
    return list(dict.fromkeys([*STAGE_READS, *(c for name, reads in STAGE_VALUES.items() if any_read([name], columns) for c in reads)]))


def enrich_orders(src: dict[str, DataFrame], cfg: RunConfig, users: DataFrame | None = None, cut=cut_lineage,
                  columns: list[str] | None = None) -> DataFrame:
    """The period's orders with every enrichment and customer-level window value.  ``cut`` writes
    a table and reads it back.  ``columns``: the caller reads only these, so no others are written.

    A right side's columns travel as one struct through the joins after its own: rows of more than a hundred columns
    are copied field by field, outside generated code, at every one of them."""
    hash_small_partitions(src["customer_orders_sku_level"].sparkSession)
    # joins whose keys are not the customer: order key (9), then (user of the order fact, month)
    needed = None if columns is None else {*columns, *stage_reads(columns), "o1_join_user_id"}
    rolled = None if needed is None else {*needed, *(("fulfilled", "categories") if "_mission" in needed else ())}
    reads = LINE_READS if rolled is None else [c for c in LINE_READS if c in {*O.line_reads(rolled), *U.LINE_READS}]
    early: list[DataFrame] = []  # tables that nothing reads any more once the orders stand
    write = keeping(early, cut)
    src = {**src, "customer_orders_sku_level": write(src["customer_orders_sku_level"].select(*reads), "lines")}
    skus = O.prep_skus_pim(_known(src["skus_pim_dmart"], "join_sku"), src["pim_level_0_bis"], O.ROLLUP_PAYLOAD)
    skus = write(skus.select("join_sku", "level_0", "level_2"), "skus")
    codes = codes_of(skus, "level_2", cfg.category_codes) if cfg.category_codes else None
    s = O.customer_orders(src["customer_orders_sku_level"], skus, cfg.discount_incentive_threshold, cfg.order_buckets, codes, rolled)
    s = s.withColumns({
        "k_cust": null_safe_key("join_customer_id"),
        "week_of_year": week_of_year_sunday(week_monday("order_date")),
        **({"_mission": R.shopping_mission("fulfilled", "categories")} if needed is None or "_mission" in needed else {}),
    })
    large = U.large_users(src, cfg)
    triples = write(U.order_users(src["customer_orders_sku_level"], src["fact_orders"]), "triples")
    if users is None:
        if cfg.key_filter_bits:  # what an order of the period can meet, as in its sources
            period_users = write(U.months_of(triples), "users")
        else:
            period_users = _known(src["fact_orders"].select("join_user_id"), "join_user_id").distinct()
        users = U.user_months(U.known_users(src), cfg, U.spine_floor(cfg), period_users, large, write)
    specs = order_joins(of_the_period(src, cfg, triples))
    df = s if needed is None else s.select(*[c for c in s.columns if c in needed])
    df = enrich(df, packed(specs, needed)).withColumn("o1_join_user_id", F.col("_r0.o1_join_user_id"))
    df = unpacked(user_month_values(df, users, needed, triples, any_read(NUMBERS, columns)), specs, needed)
    # the customer stage reads these rows twice
    rows = cut(df, "orders")
    if cut is cut_lineage:  # else they are the caller's
        drop_cut(*early)
    return customer_stage(rows, src, cfg, cut, columns, large)


def user_month_values(rows: DataFrame, users: DataFrame, needed: set[str] | None = None, triples: DataFrame | None = None,
                      in_order: bool = True) -> DataFrame:
    """L16 without re-shuffling the order rows.  ``needed``: keep only these of its columns.  ``triples``: the rows' own
    (``users.order_users``), if they are written already.  ``in_order``: whether the caller numbers the rows.

    The rows are partitioned by the order key after the order-keyed joins; L16's key is
    (user of the order fact, month).  So the distinct (order, user, month) triples -- three
    narrow columns -- are joined to the user months (NULL users spread, they match
    nothing), the matches packed per order, and the pack joined back on the order key,
    where the rows already are.  Each row then takes the entries of its own (user, month),
    exploded: one per match (the join's fan-out), or one all-NULL entry when there is none.  Entries that are numbered are
    ordered by the last active month, then by their other values, not by how the join came to them."""
    spec = user_month_join(users)
    spec.select = {n: c for n, c in spec.select.items() if needed is None or n in needed}
    cols = list(spec.select)
    last = {"_last": "last_month_active"} if in_order else {}
    spec.select = {**last, **spec.select}
    keys = ["join_order_id", "o1_join_user_id", "join_order_month"]
    looked = enrich(rows.select(*keys).distinct() if triples is None else triples, [spec])
    entries = F.collect_list(F.struct(*last, F.col("o1_join_user_id").alias("_u"), F.col("join_order_month").alias("_m"),
                                      *[F.col(c) for c in cols]))
    packed = looked.groupBy("join_order_id").agg((F.sort_array(entries) if in_order else entries).alias("_um"))
    out = rows.join(packed, "join_order_id", "left")
    mine = F.filter("_um", lambda e: e["_u"].eqNullSafe(F.col("o1_join_user_id"))
                    & (e["_m"] == F.col("join_order_month")))
    out = out.select("*", F.explode_outer(mine).alias("_e"))
    return out.withColumns({c: F.col("_e").getField(c) for c in cols}).drop("_um", "_e")


def customer_stage(df: DataFrame, src: dict[str, DataFrame], cfg: RunConfig, cut=cut_lineage, columns: list[str] | None = None,
                   large: set[str] = frozenset()) -> DataFrame:
    """Everything keyed by the customer.

    One key can hold a third of all rows here, so the wide rows are never gathered by customer:

    1. a (customer, minute) group of more than ``cfg.slice_rows`` rows is cut into slices by sampled bounds of
       (timestamp, order id), so its rows go to several tasks;
    2. one aggregate of the rows to ``fine``, narrow rows (customer, month, week, minute, slice): counts and the
       pieces of W14-W18.  It is written once; a customer has at most as many of them as the clock has minutes,
       and a slice more for each ``slice_rows`` rows;
    3. the customer-month sources (L12 L18 L19 L22) are joined to the distinct (customer, month) keys and the
       customer sources (L10, L11 with W11) to the distinct customers, and packed per
       (customer, month): exactly the matches each order row gets, fan-out included;
    4. ``fine`` takes the number of matches and is hashed on the customer once; first values, week minimum, flags
       and the offsets of the running numbers are windows on that partitioning, and the matches are attached after
       them, so they aren't sorted with the rows;
    5. the rows are hashed on (customer, minute, slice), meet their ``fine`` row, explode the matches, and are
       numbered inside their groups on top of the offsets, the prefix sums of the groups before."""
    K, M_, WK, SEG = "k_cust", "join_order_month", "week_of_year", "_seg"
    d = df.withColumn(SEG, time_segment("order_timestamp", cfg.rank_segment))
    d = sliced(d, [K, SEG], FIRST_ORDER, cfg.slice_rows, cut)
    act = R.month_activation_expressions("coupon_used_amount", "plus_order", "plus_item_level", "crm_vertical")
    first = R.first_order_expressions("order_date", "d_acq_since", "d_acq_until", "is_ild", "coupon_used_amount",
                                      "plus_order", "plus_item_level", "coupon_campaign", "coupon_funnel",
                                      "crm_vertical")
    flags = {"has_stock_up_mission": F.col("mission_type") == "Stock Up", "has_fill_in_mission": F.col("mission_type") == "Fill In",
             "user_has_stock_up_v2": F.col("_mission") == "Stock Up", "user_has_fill_in_v2": F.col("_mission") == "Fill In"}
    order_key = [F.col(c) for c in FIRST_ORDER]
    act, first = (e if any_read(e, columns) else {} for e in (act, first))
    flags = {n: e for n, e in flags.items() if any_read([n], columns)}
    starts = any_read(["wsd_start_day"], columns)
    fine = cut(d.groupBy(K, M_, WK, SEG, SLICE).agg(
        F.count(F.lit(1)).alias("_n"),
        *([F.min(F.struct(*order_key, *[e.alias(n) for n, e in act.items()])).alias("_first_m")] if act else []),
        *([F.min(F.struct(*order_key, *[e.alias(n) for n, e in first.items()])).alias("_first_c")] if first else []),
        *([F.min(iso_weekday("order_date")).alias("_wmin")] if starts else []),
        *[F.max(flag(e)).alias(n) for n, e in flags.items()]), "fine")

    cm_specs, cu_specs = customer_month_joins(src, cfg.period_start, {n: cfg.slice_rows for n in large}), customer_joins(src)
    for spec in [*cm_specs, *cu_specs] if columns is not None else ():  # the joins stay: they can fan out
        spec.select = {n: c for n, c in spec.select.items() if n in columns}
    matched = [c for j in [*cm_specs, *cu_specs] for c in j.select]
    months = enrich(fine.select(K, M_).distinct(), cm_specs)
    customers = enrich(fine.select(K).distinct(), cu_specs)
    pack = F.struct(*[F.col(c) for c in matched]) if matched else F.struct(F.lit(0).alias("_none"))
    matches = cut(months.join(customers, K).groupBy(K, M_).agg(F.array_sort(F.collect_list(pack)).alias("_matches")), "matches")

    by = lambda *keys: Window.partitionBy(K, *keys)
    upto = lambda w: F.coalesce(F.sum("_rows").over(w.orderBy(SEG, SLICE).rangeBetween(Window.unboundedPreceding, Window.currentRow))
                                - F.sum("_rows").over(w.orderBy(SEG, SLICE).rangeBetween(Window.currentRow, Window.currentRow)), F.lit(0))
    counted = matches.select(K, M_, F.size("_matches").alias("_times"))
    values = fine.join(counted, [K, M_]).withColumn("_rows", F.col("_n") * F.col("_times")).repartition(K).withColumns({
        "_off_all": upto(by()), "_off_month": upto(by(M_)),
        **({"_c": F.min("_first_c").over(by())} if first else {}), **({"_m": F.min("_first_m").over(by(M_))} if act else {}),
        **({"wsd_start_day": F.min("_wmin").over(by(WK))} if starts else {}),
        **{n: F.max(n).over(by(M_)) for n in flags},
    }).select(K, M_, WK, SEG, SLICE, "_off_all", "_off_month", *(["wsd_start_day"] if starts else []), *flags,
              *[F.col("_m")[n].alias(n) for n in act], *[F.col("_c")[n].alias(n) for n in first])
    # Months and weeks are compared as ranges, which are no join keys: the rows stay where the join's own keys have put
    # them.  The planner's estimate of these joins ignores such a condition, but their sides are
    # measured by adaptive execution, and a customer has few months.
    same = lambda a, b, c: F.col(f"{a}.{c}").between(F.col(f"{b}.{c}"), F.col(f"{b}.{c}"))
    values = values.alias("v").join(matches.repartition(K).alias("m"), [F.col(f"v.{K}") == F.col(f"m.{K}"), same("v", "m", M_)]) \
        .select("v.*", "m._matches")
    place = [K, SEG, SLICE]
    mine = [F.col(f"r.{c}") == F.col(f"v.{c}") for c in place] + [same("r", "v", M_), same("r", "v", WK)]
    given = [c for c in values.columns if c not in (*place, M_, WK, "_matches")]
    # what is only carried along goes as one struct: sorts and windows copy it whole
    numbered = any_read(NUMBERS, columns)
    keep = list(dict.fromkeys([*place, M_, WK, *([*FIRST_ORDER, *FANOUT_ORDER, *ROW_ORDER] if numbered else [])]))
    carried = [c for c in d.columns if c not in keep and (columns is None or c in columns)]
    wide = d.select(*keep, *([F.struct(*carried).alias("_wide")] if carried else []))
    rows = wide.repartition(*place).alias("r").join(values.alias("v"), mine).select("r.*", *given, F.posexplode("_matches").alias("_pos", "_e"))
    order = [F.col(c) for c in [*FIRST_ORDER, *FANOUT_ORDER, *ROW_ORDER, "_pos"]]
    numbers = {
        "order_number": (F.row_number().over(Window.partitionBy(*place).orderBy(*order)) + F.col("_off_all")).cast("bigint"),
        "order_num_month": (F.row_number().over(Window.partitionBy(M_, *place).orderBy(*order)) + F.col("_off_month")).cast("bigint"),
    }
    rows = rows.withColumns({**(numbers if numbered else {}), **{c: F.col("_e")[c] for c in matched}})
    return rows.withColumns({c: F.col("_wide")[c] for c in carried}).drop(SEG, SLICE, "_wide", "_e", "_pos", "_off_all", "_off_month")


AMOUNT = ("coupon_used_amount",)
LATE = ("actual_delivery_time", "timing_promised_delivery_time")
LEVEL_TWO = ("flag_plus", "crm_vertical", "flag_vc", "order_source", "multibuy_order", "discount_order")
# what the columns of R13-R33 are computed from
READS = {
    "hour": ("order_timestamp",), "year": ("order_date",), "month": ("order_date",), "sku_level_customer_id": (),
    "customer_id": ("o1_user_id",), "customer_adverted_id": ("customer_real_id",), "business_stage": ("order_date",),
    "adoption_type": ("order_date", "cohort_date", "d_adoption_until"), "acquisition_type": ("order_date", "d_acq_since", "d_acq_until"),
    **dict.fromkeys(("sunday_plus", "fija_plus", "plus_benefit_orders"), ("d_bin_campaign",)),
    **dict.fromkeys(("wine_user", "rmo_high_mov", "rmo_qc_dmart"), ()),
    "has_delivery_time": ("fo_total_orders_vl", "is_pre_order"), "late_order": LATE,
    **dict.fromkeys(("coupon_type", "coupon_type_barter"), (*AMOUNT, "v_type", "plus_order")),
    "order_source": ("has_bins_discount", "is_user_plus", "crm_vertical", *AMOUNT, "v_type"),
    "order_source_level_one": ("has_bins_discount", "is_user_plus", "crm_vertical", *AMOUNT),
    "gfv": ("venta_neta",), "gmv": ("venta",), "discounts": ("discount",), "basket_sz": ("fulfilled",),
    "flag_plus": ("plus_order", "plus_item_level"), "peyaplus": ("plus_order",), "voucher_amount_net": AMOUNT,
    **dict.fromkeys(("flag_vc", "flag_voucher"), AMOUNT),
    **dict.fromkeys(("flag_df", "flag_delivery_free"), ("delivery_fee_revenue",)),
    "order_sub_nature": (*AMOUNT, "delivery_fee_revenue"),
    **dict.fromkeys(("flag_inaccuracy", "inaccuracy_late"), ("comp_ccr1", "late_order")),
    "wsd_week_and_day": ("week_of_year", "wsd_start_day"), "dh_shopping_mission": ("basket_sz", "categories"),
    "timings_actual_dt_interval": LATE[:1], "timings_potential_dt_interval": LATE[1:],
    "dh_shopping_mission_user": ("has_stock_up_mission", "has_fill_in_mission"),
    "dh_shopping_mission_user_v2": ("user_has_stock_up_v2", "user_has_fill_in_v2"),
    "order_source_level_two": LEVEL_TWO, "order_source_level_three": (*LEVEL_TWO, "d_bin_campaign"),
}


def computed_for(columns) -> set[str]:
    """The given columns and every one they are computed from."""
    found, todo = set(), list(columns)
    while todo:
        c = todo.pop()
        if c not in found:
            found.add(c)
            todo += READS.get(c, ())
    return found


def read_by(columns) -> list[str]:
    """Columns of C15's rows that the given columns read; ``customer_id`` is there under its own name before it gets the published one."""
    return sorted({"customer_id", *(c for c in computed_for(columns) if c not in READS)})


def order_columns(k: DataFrame, columns=None) -> DataFrame:
    """C15's computed columns (R13-R25) beside those of its joins and windows.  ``columns``: only what these are made of."""
    wanted = None if columns is None else computed_for(columns)
    col = F.col
    amt = "coupon_used_amount"
    src_cols = {
        "hour": hour_of("order_timestamp"),
        "year": year_start("order_date"),
        "month": F.trunc("order_date", "MM"),
        "sku_level_customer_id": col("customer_id"),
        "customer_id": col("o1_user_id"),
        "customer_adverted_id": col("customer_real_id"),
        "business_stage": R.business_stage("order_date"),
        "adoption_type": R.date_in_window("order_date", "cohort_date", "d_adoption_until", "adoption", "active"),
        "acquisition_type": R.date_in_window("order_date", "d_acq_since", "d_acq_until", "acquisition", "active"),
        **R.bin_campaign_flags("d_bin_campaign"),
        "wine_user": F.lit(None).cast("bigint"),
        "rmo_high_mov": F.lit(False),
        "rmo_qc_dmart": F.lit(False),
        "has_delivery_time": R.has_delivery_time("fo_total_orders_vl", "is_pre_order"),
        "late_order": R.late_order("actual_delivery_time", "timing_promised_delivery_time"),
        "coupon_type": R.coupon_type(amt, "v_type", "plus_order"),
        "coupon_type_barter": R.coupon_type(amt, "v_type", "plus_order", plus_first=True),
        "order_source": R.order_source("has_bins_discount", "is_user_plus", "crm_vertical", amt, "v_type"),
        "order_source_level_one": R.order_source_level_one("has_bins_discount", "is_user_plus", "crm_vertical", amt),
        "gfv": col("venta_neta"),
        "gmv": col("venta"),
        "discounts": col("discount"),
        "basket_sz": col("fulfilled"),
        "flag_plus": R.flag_plus("plus_order", "plus_item_level"),
        "peyaplus": R.peyaplus("plus_order"),
        "voucher_amount_net": net_of_tax(amt),
        **R.voucher_flags(amt),
        **R.delivery_fee_flags("delivery_fee_revenue"),
        "order_sub_nature": R.order_sub_nature(amt, "delivery_fee_revenue"),
    }
    src_cols = {n: c for n, c in src_cols.items() if wanted is None or n in wanted}
    k = k.withColumns({n: c for n, c in src_cols.items() if n != "customer_id"})
    return k.withColumn("customer_id", src_cols["customer_id"]) if "customer_id" in src_cols else k


def final_projection(k: DataFrame, columns=C.OUTPUT_COLUMNS) -> DataFrame:
    """The 174 published columns, in order, with R26-R33; or some of them."""
    k = order_columns(k, columns)
    wanted = computed_for(columns)
    add = lambda k, new: k.withColumns({n: c for n, c in new.items() if n in wanted})
    late = "late_order"
    k = add(k, {
        **R.inaccuracy_flags("comp_ccr1", late),
        "wsd_week_and_day": R.week_and_day("week_of_year", "wsd_start_day"),
        "dh_shopping_mission": R.shopping_mission("basket_sz", "categories"),
        "timings_actual_dt_interval": R.duration_band("actual_delivery_time"),
        "timings_potential_dt_interval": R.duration_band("timing_promised_delivery_time"),
        "dh_shopping_mission_user": R.user_mission("has_stock_up_mission", "has_fill_in_mission"),
        "dh_shopping_mission_user_v2": R.user_mission("user_has_stock_up_v2", "user_has_fill_in_v2"),
    })
    k = add(k, {
        "order_source_level_two": R.order_source_level_two("flag_plus", "crm_vertical", "flag_vc", "order_source",
                                                           "multibuy_order", "discount_order"),
        "order_source_level_three": R.order_source_level_three("flag_plus", "d_bin_campaign", "crm_vertical",
                                                               "flag_vc", "order_source", "multibuy_order",
                                                               "discount_order"),
    })
    return k.select(*columns)


def order_mart(src: dict[str, DataFrame], cfg: RunConfig, cut=cut_lineage, columns=C.OUTPUT_COLUMNS) -> DataFrame:
    """The published order mart.  ``columns``: the caller reads only these."""
    return final_projection(enrich_orders(src, cfg, cut=cut, columns=read_by(columns)), columns)


def mart_schema(src: dict[str, DataFrame], cfg: RunConfig):
    """The mart's schema; plans only, no data is read."""
    return order_mart(src, replace(cfg, slice_rows=0, key_filter_bits=0, category_codes=0), cut=lambda df, *_: df).schema


def check_target(spark, target: str, schema, mode: str = "append") -> None:
    """Refuse a target that the mart can't be appended to by position, or whose months can't be
    replaced.  Reads the catalog only."""
    fields = spark.table(target).schema.fields
    parts = [c.name for c in spark.catalog.listColumns(target) if c.isPartition]
    if len(fields) != len(schema.fields):
        raise ValueError(f"{target} has {len(fields)} columns, the mart {len(schema.fields)}")
    for at, (have, give) in enumerate(zip(fields, positioned(schema.fields, parts), strict=True)):
        if have.dataType != give.dataType:
            raise ValueError(f"column {at + 1} of {target} ({have.name}) is {have.dataType.simpleString()}, the mart's {give.name} {give.dataType.simpleString()}")
    if mode not in ("append", "replace_month"):
        raise ValueError(mode)
    if mode == "replace_month" and parts != ["month"]:
        raise ValueError(f"replace_month needs a target partitioned by month alone; {target} is partitioned by {parts or 'nothing'}")


def positioned(columns: list, parts: list[str]) -> list:
    """The published columns in a target's order: a table keeps its partition columns last."""
    name = lambda c: getattr(c, "name", c)
    return [c for c in columns if name(c) not in parts] + [c for p in parts for c in columns if name(c) == p]


def publish(df: DataFrame, target: str, mode: str = "append") -> None:
    """K1: append the mart to ``target`` by position; the target's column names are its own.
    ``mode='replace_month'`` overwrites only the months present, so rerunning a month does not append it twice."""
    spark = df.sparkSession
    df = df.select(*C.OUTPUT_COLUMNS)
    check_target(spark, target, df.schema, mode)
    parts = [c.name for c in spark.catalog.listColumns(target) if c.isPartition]
    writer = df.select(*positioned(df.columns, parts)).write
    if mode == "append":
        writer.insertInto(target)
        return
    key = "spark.sql.sources.partitionOverwriteMode"  # an insert by position reads the session's, not the writer's
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        writer.insertInto(target, overwrite=True)
    finally:
        spark.conf.set(key, before)


def publish_once(df: DataFrame, target: str, run: str) -> bool:
    """K1 for a run that may be started again: append ``df`` to ``target`` by position unless ``run`` has been appended already.

    The run's ledger is a folder beside the table's files, ``_runs/<run>``, which readers of the table skip:

    1. the rows are written there (``stage``); a stage without its success marker was cut off and is written anew;
    2. each staged file is moved into the table under a name that holds the run.  A move either happens or not, so a
       job that was killed moves the files that are left when it is started again, and never one twice;
    3. a commit marker is written.  A run with a marker does nothing.

    Returns whether this call did the append.  ``publish(mode="append")`` stays the plain insert."""
    spark = df.sparkSession
    if not run or "/" in run or run.startswith("."):
        raise ValueError(f"{run!r} can't name a run")
    df = df.select(*C.OUTPUT_COLUMNS)
    check_target(spark, target, df.schema)
    parts = [c.name for c in spark.catalog.listColumns(target) if c.isPartition]
    detail = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {target}").collect()}
    if (detail.get("Provider") or "").lower() != "parquet":
        raise ValueError(f"{target} is no Parquet table: its files can't be added one by one")
    path = spark._jvm.org.apache.hadoop.fs.Path
    table = path(detail["Location"])
    fs = table.getFileSystem(spark._jsc.hadoopConfiguration())
    ledger = path(table, f"_runs/{run}")
    stage, commit = path(ledger, "stage"), path(ledger, "_COMMITTED")
    if fs.exists(commit):
        return False
    if not fs.exists(path(stage, "_SUCCESS")):
        fs.delete(stage, True)
        names = spark.table(target).columns
        writer = df.select(*[F.col(c).alias(n) for c, n in zip(positioned(df.columns, parts), names, strict=True)]).write
        (writer.partitionBy(*parts) if parts else writer).parquet(stage.toString())
    for source, folder in _staged_files(fs, path, stage):
        home = path(table, folder) if folder else table
        fs.mkdirs(home)
        if not fs.rename(source, path(home, f"{run}-{source.getName()}")):
            raise OSError(f"{source.toString()} could not be moved")
    fs.create(commit, True).close()
    fs.delete(stage, True)
    if parts:
        spark.catalog.recoverPartitions(target)
    spark.catalog.refreshTable(target)
    return True


def _staged_files(fs, path, stage) -> list[tuple]:
    """Data files of a stage with their partition folder: a file per task, named on the driver, never read there."""
    found, files = [], fs.listFiles(stage, True)
    prefix = fs.makeQualified(stage).toString() + "/"
    while files.hasNext():
        file = files.next().getPath()
        folder, _, name = fs.makeQualified(file).toString().removeprefix(prefix).rpartition("/")
        if not name.startswith(("_", ".")):
            found.append((file, folder))
    return found


def create_target(schema, target: str, spark, path: str | None = None) -> None:
    """Create an empty month-partitioned Parquet target for the mart."""
    w = spark.createDataFrame([], schema).select(*C.OUTPUT_COLUMNS).write.format("parquet").partitionBy("month")
    if path:
        w = w.option("path", path)
    w.saveAsTable(target)
