"""Order branch and preparations: C5-C9, C14."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart import config as C
from ordermart.functions import rules as R
from ordermart.functions.numeric import any_flag, safe_ratio
from ordermart.operators.bitsets import Codes, set_of, size_of, with_code
from ordermart.operators.joins import JoinSpec, enrich
from ordermart.operators.slices import scan
from ordermart.operators.windows import latest_per_key

ORDER_KEYS = ["store_name", "vendor_id", "order_date", "join_order_month", "order_timestamp",
              "customer_id", "join_customer_id", "order_id", "join_order_id"]


SKU_PAYLOAD = ("piece_barcode", "level_0", "level_1", "level_2", "level_3", "level_4", "country_code")
# as far as the order rollup reads it: the best row is the greatest in this order, so its first columns are the greatest of these
ROLLUP_PAYLOAD = SKU_PAYLOAD[:4]


def prep_skus_pim(s4: DataFrame, s5: DataFrame, payload: tuple[str, ...] = SKU_PAYLOAD) -> DataFrame:
    """Catalogue ⟕ level-0 lookup (L1), best barcode per SKU (W1).  ``payload``: the columns given, first ones of ``SKU_PAYLOAD``."""
    cat = enrich(s4, [JoinSpec(s5, ["level_1"], ["level_1"], {"level_0": "level_0"}, name="L1 level 0")])
    return latest_per_key(cat, ["join_sku"], ["piece_barcode"], payload)


def prep_payments(s6: DataFrame, s7: DataFrame | None = None) -> DataFrame:
    """One payment per order, the greatest issuer.

    The reference also left-joins vendor profiles (L2) but uses none of their columns and
    keeps one row per order afterwards, so the join cannot change the result; pass ``s7``
    to run it anyway (a test checks both give the same table)."""
    df = s6
    if s7 is not None:
        df = enrich(df, [JoinSpec(s7, ["join_restaurant_id"], ["join_codigo"], {"_v": "join_codigo"})])
    df = df.select("join_order_id", F.col("issuer").alias("bank"),
                   F.col("card_operation_type").alias("operation_type"), F.col("provider").alias("payment_name"))
    return latest_per_key(df, ["join_order_id"], ["bank"],
                          ["bank", "operation_type", "payment_name"])


def prep_purchase_missions(s16: DataFrame, limit: int = 0) -> DataFrame:
    """Previous month's purchase mission (W3).  Users of more than ``limit`` rows, such as no user, are split."""
    return scan(s16, ["join_user_id"], ["join_month", "category"], {"dmart_pm_shopping_mission_prior_month": "category"}, limit=limit)


def prep_behavioural_clustering(s17: DataFrame, limit: int = 0) -> DataFrame:
    """Previous month's behavioural cluster."""
    return scan(s17, ["join_user_id"], ["join_month", "dmart_cluster", "final_dm_cluster"], {"dmart_cluster_prior_month": "dmart_cluster"}, limit=limit)


def complaint_rollup(s18: DataFrame) -> DataFrame:
    """Complaints per order and six attributes."""
    return (s18.groupBy("join_order_id", "ccr1", "ccr2", "ccr3", "user_fraud", "user_trust_segment", "case_origin")
            .agg(F.sum("amount").alias("sum_amount"),
                 F.sum("euros").alias("sum_euros"),
                 F.countDistinct("case_number").alias("cases")))


# what the rollup's columns are made of: columns of the lines, or others of its own
ROLLUP_READS = {
    "categories": (), "ordered": ("ordered_quantity",), "fulfilled": ("fulfilled_quantity",), "venta": ("total_amount_sold_net_lc",),
    "venta_neta": ("total_amount_net_with_discount_lc",), "cost": ("total_cogs_sold_net_lc",), "discount": ("pcm_discount_amount_net_lc",),
    **dict.fromkeys(("fresh_order", "ultra_fresh_order"), ("fulfilled_quantity",)), "discount_order": ("pcm_discount_amount_net_lc",),
    "multibuy_order": ("pcm_discount_subtype", "fulfilled_quantity"), "plus_item_level": ("target_audience", "pcm_discount_amount_net_lc"),
    "is_ild": ("ild_amount",), "front_margin": ("venta_neta", "cost"), "theoric_margin": ("venta", "cost"),
    **dict.fromkeys(("discount_rate", "discount_incentivized"), ("discount", "venta")),
    "basket_segment": ("fulfilled",), "afv_segment": ("venta",),
}


def rolled_for(columns) -> set[str]:
    """The given columns and every one that the rollup makes them of."""
    found, todo = set(), list(columns)
    while todo:
        c = todo.pop()
        if c not in found:
            found.add(c)
            todo += ROLLUP_READS.get(c, ())
    return found


def line_reads(columns) -> list[str]:
    """Columns of the lines that ``customer_orders`` reads for the given ones."""
    return [*ORDER_KEYS, "join_sku_id", *sorted(c for c in rolled_for(columns) if c not in ROLLUP_READS)]


def customer_orders(lines: DataFrame, skus: DataFrame, threshold: float = 0.25, buckets: int = 0,
                    codes: Codes | None = None, columns: set[str] | None = None) -> DataFrame:
    """C14 / A5: order lines ⟕ catalogue (L7) rolled up to orders, with bands (R2, R3) and
    flags (R4, R5).

    The lines are hashed on the order key once: that partitioning serves the nine-key grouping, the
    distinct categories and every order-keyed join after it.  Sums keep the type that the lines' money has.
    ``buckets``: those of the right sides, if they are laid out by order key.  ``codes``: the categories', which are then counted
    as sets of bits beside the sums; a distinct count groups every line twice more.  ``columns``: the caller reads only these, and
    ``lines`` need hold only their ``line_reads``."""
    cat = skus.select("join_sku", "level_0", "level_2")
    if codes is not None:
        cat = with_code(cat, codes)
    df = enrich(lines, [JoinSpec(cat, ["join_sku_id"], ["join_sku"], {c: c for c in cat.columns if c != "join_sku"}, name="L7 catalogue")])
    df = df.repartition(buckets, "join_order_id") if buckets else df.repartition("join_order_id")
    qty = F.col("fulfilled_quantity")
    disc = F.col("pcm_discount_amount_net_lc")
    made = None if columns is None else rolled_for(columns)
    sums = {
        "ordered": F.sum("ordered_quantity"),
        "fulfilled": F.sum("fulfilled_quantity"),
        "venta": F.sum("total_amount_sold_net_lc"),
        "venta_neta": F.sum("total_amount_net_with_discount_lc"),
        "cost": F.sum("total_cogs_sold_net_lc"),
        "discount": F.sum("pcm_discount_amount_net_lc"),
        "fresh_order": any_flag(F.col("level_0").isin(*C.FRESH_LEVELS) & (qty > 0)),
        "ultra_fresh_order": any_flag((F.col("level_0") == C.ULTRA_FRESH_LEVEL) & (qty > 0)),
        "discount_order": any_flag(disc > 0),
        "multibuy_order": any_flag((F.col("pcm_discount_subtype") == C.MULTIBUY_SUBTYPE) & (qty > 0)),
        "plus_item_level": any_flag((F.col("target_audience") == C.SUBSCRIBED_AUDIENCE) & (disc > 0)),
        "is_ild": any_flag(F.col("ild_amount") > 0),
    }
    agg = df.groupBy(*ORDER_KEYS).agg(
        *([F.countDistinct("level_2").alias("categories")] if codes is None else set_of(codes)),
        *[c.alias(n) for n, c in sums.items() if made is None or n in made])
    if codes is not None:
        rest = [c for c in agg.columns if c not in (*ORDER_KEYS, *codes.words)]
        agg = agg.select(*ORDER_KEYS, size_of(codes).alias("categories"), *rest)
    ratio = safe_ratio("discount", "venta")
    derived = {
        "front_margin": F.col("venta_neta") - F.col("cost"),
        "theoric_margin": F.col("venta") - F.col("cost"),
        "discount_rate": ratio,
        "basket_segment": R.basket_segment("fulfilled"),
        "afv_segment": R.value_band("venta"),
        "discount_incentivized": R.discount_incentivized(ratio, threshold),
    }
    return agg.withColumns({n: c for n, c in derived.items() if made is None or n in made})
