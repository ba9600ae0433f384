"""One generic source operator, used 21 times.

Every source projects its columns, adds a STRING join key next to each native id (J2),
adds a month key (J3) and filters (F1, F2).  The projection and the filters are plain
Column expressions, so Catalyst prunes the Parquet read schema (nested fields included)
and pushes the filters into the scan.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermart import config as C
from ordermart.config import RunConfig
from ordermart.functions.dates import month_key
from ordermart.functions.numeric import net_of_tax
from ordermart.functions.rules import ild_amount


@dataclass(frozen=True)
class SourceSpec:
    name: str
    # output column -> source column path (``None`` = same name); order is kept
    columns: tuple[tuple[str, str | None], ...]
    # join key name -> source column path, cast to STRING
    string_keys: tuple[tuple[str, str], ...] = ()
    # month key name -> source date/timestamp column
    month_keys: tuple[tuple[str, str], ...] = ()
    predicate: Callable[[RunConfig], Column] | None = None
    derived: Callable[[RunConfig], dict[str, Column]] | None = None
    doc: str = field(default="", compare=False)


def _cols(*names: str) -> tuple[tuple[str, str | None], ...]:
    return tuple((n, None) for n in names)


def since_period(column: str) -> Callable[[RunConfig], Column]:
    """``DATE(column) >= period start`` (pushed to Parquet for DATE and TIMESTAMP)."""
    return lambda cfg: F.to_date(F.col(column)) >= F.lit(cfg.period_start)


def check_ids(df: DataFrame, spec: SourceSpec) -> None:
    """Refuse ids that have no exact string form: the key of a double 12.0 would be '12.0' and join nothing."""
    for key, path in spec.string_keys:
        kind = df.select(F.col(path)).schema.fields[0].dataType
        exact = isinstance(kind, (T.StringType, T.IntegralType)) or isinstance(kind, T.DecimalType) and kind.scale == 0
        if not exact:
            raise TypeError(f"{spec.name}.{path} ({key}) is {kind.simpleString()}; ids must be whole numbers or strings")


def load_source(df: DataFrame, spec: SourceSpec, cfg: RunConfig) -> DataFrame:
    """Apply one SourceSpec to the raw table ``df``."""
    check_ids(df, spec)
    if spec.predicate is not None:
        df = df.where(spec.predicate(cfg))
    out: list[Column] = []
    keys = dict(spec.string_keys)
    months = dict(spec.month_keys)
    derived = spec.derived(cfg) if spec.derived else {}
    emitted = set()
    for name, path in spec.columns:
        if name in derived:
            out.append(derived[name].alias(name))
        else:
            out.append(F.col(path or name).alias(name))
        emitted.add(name)
        # keep each join key right after its native column, as the reference lays them out
        for k, src in spec.string_keys:
            if src == (path or name) and k not in emitted:
                out.append(F.col(src).cast("string").alias(k))
                emitted.add(k)
        for k, src in spec.month_keys:
            if src == (path or name) and k not in emitted:
                out.append(month_key(src).alias(k))
                emitted.add(k)
    for k, src in keys.items():
        if k not in emitted:
            out.append(F.col(src).cast("string").alias(k))
    for k, src in months.items():
        if k not in emitted:
            out.append(month_key(src).alias(k))
    for k, expr in derived.items():
        if k not in emitted:
            out.append(expr.alias(k))
    return df.select(*out)


def _lines_derived(cfg: RunConfig) -> dict[str, Column]:
    return {
        "order_timestamp": F.col("order_timestamp").cast("timestamp_ntz"),
        "ild_amount": ild_amount("target_audience", "campaign_name", "campaign_purpose",
                                 "pcm_discount_amount_net_lc"),
    }


def _fact_orders_derived(cfg: RunConfig) -> dict[str, Column]:
    return {"shipping_amount_no_discount": net_of_tax("shipping_amount_no_discount")}


SPECS: dict[str, SourceSpec] = {s.name: s for s in [
    SourceSpec(
        "first_dmart_order_date_users",
        _cols("customer_id", "id", "adoption_since", "type", "mes_en_curso", "month",
              "acquisition_since", "adoption_until", "acquisition_until"),
        string_keys=(("join_customer_id", "customer_id"), ("join_id", "id")),
        month_keys=(("join_month", "month"),),
        doc="S1 lifecycle row per user and month"),
    SourceSpec(
        "customer_orders_sku_level",
        _cols("order_date") + (("join_order_month", "order_date"),) + _cols(
            "customer_id", "order_id", "fulfilled_quantity", "master_category_parent_english",
            "total_amount_net_with_discount_lc", "store_name", "vendor_id", "order_timestamp",
            "sku_id", "ordered_quantity", "total_amount_sold_net_lc", "total_cogs_sold_net_lc",
            "pcm_discount_amount_net_lc", "pcm_discount_subtype", "target_audience",
            "campaign_name", "campaign_purpose", "ild_amount"),
        string_keys=(("join_customer_id", "customer_id"), ("join_order_id", "order_id"),
                     ("join_vendor_id", "vendor_id"), ("join_sku_id", "sku_id")),
        predicate=lambda cfg: (F.col("country_code") == C.COUNTRY_CODE)
        & (F.col("state") == C.CONFIRMED_STATE) & since_period("order_date")(cfg),
        derived=lambda cfg: {"join_order_month": month_key("order_date"), **_lines_derived(cfg)},
        doc="S2 order lines of the period"),
    SourceSpec(
        "monthly_user_info",
        _cols("user_id", "mes", "present_month_status_user", "past_month_status_user",
              "dm_past_month_orders", "f_present_month_orders", "ls_present_month_orders",
              "c_present_month_orders", "f_past_month_orders", "ls_past_month_orders",
              "c_past_month_orders"),
        string_keys=(("join_user_id", "user_id"),),
        month_keys=(("join_month", "mes"),),
        predicate=lambda cfg: F.col("country_name") == C.COUNTRY_NAME,
        doc="S3 platform activity per user month"),
    SourceSpec(
        "skus_pim_dmart",
        _cols("sku", "piece_barcode", "level_1", "level_2", "level_3", "level_4", "country_code"),
        string_keys=(("join_sku", "sku"),), doc="S4 SKU catalogue"),
    SourceSpec("pim_level_0_bis", _cols("level_1", "level_0"), doc="S5 level_1 -> level_0"),
    SourceSpec(
        "fact_payments_transaction",
        _cols("order_id", "issuer", "card_operation_type", "provider", "restaurant_id"),
        string_keys=(("join_order_id", "order_id"), ("join_restaurant_id", "restaurant_id")),
        predicate=lambda cfg: (F.col("country_id") == C.PAYMENTS_COUNTRY_ID)
        & (F.col("payment_state") == C.PAYMENT_ACCEPTED) & since_period("date_created")(cfg),
        doc="S6 accepted payments of the period"),
    SourceSpec("dmarts_vendor_profiles", _cols("codigo"), string_keys=(("join_codigo", "codigo"),),
               doc="S7 vendor profiles"),
    SourceSpec(
        "fact_orders",
        (("order_id", None), ("user_id", "user.id"), ("customer_real_id", "customer_id"),
         ("maxMinutes", "promisedDeliveryTime.maxMinutes"),
         ("minMinutes", "promisedDeliveryTime.minMinutes"),
         ("delivery_fee_revenue", None), ("shipping_amount_no_discount", None),
         ("shipping_amount_visualized", "shipping_amount_no_discount"), ("shipping_amount", None),
         ("distance", "distance_meters"), ("plus_order", "is_user_plus"), ("total_amount", None),
         ("has_bins_discount", None), ("is_user_plus", None)),
        string_keys=(("join_order_id", "order_id"), ("join_user_id", "user.id"),
                     ("join_customer_real_id", "customer_id")),
        predicate=since_period("registered_date"),
        derived=_fact_orders_derived,
        doc="S8 order facts of the period"),
    SourceSpec("fact_talon_coupons", _cols("order_id", "coupon_used_amount"),
               string_keys=(("join_order_id", "order_id"),), doc="S9 coupons"),
    SourceSpec("agg_user_lifecycle",
               _cols("user_id", "health_status", "intermittency_type", "funnel", "lifecycle_stage"),
               string_keys=(("join_user_id", "user_id"),), doc="S10 user lifecycle"),
    SourceSpec(
        "user_income",
        (("user_id", None), ("u_age", "age"), ("age_group", None), ("gender", None),
         ("gender_merged", None), ("dh_age_prediction", None), ("dh_gender_prediction", None),
         ("u_cell_segment", "cell_segment"), ("u_income", "income"), ("segment", None),
         ("user_demographic_group", None)),
        string_keys=(("join_user_id", "user_id"),), doc="S11 user demographics"),
    SourceSpec("peru_clusters", _cols("user_id", "mes", "n_cluster"),
               string_keys=(("join_user_id", "user_id"),), month_keys=(("join_month", "mes"),),
               doc="S12 CRM cluster per user month"),
    SourceSpec(
        "dim_coupon_crm_attributes",
        _cols("order_id", "type", "segment", "nivel", "funnel", "purpose", "campaign", "campaign_id",
              "crm_vertical", "crm_lifecycle", "coupon_origin"),
        string_keys=(("join_order_id", "order_id"),), doc="S13 coupon CRM attributes"),
    SourceSpec(
        "dps_order_info",
        _cols("order_id", "dropoff_distance_manhattan_m", "order_delay_mins", "scheme_id",
              "dps_minimum_order_value_local", "dps_delivery_fee_local", "dps_basket_value_fee_local",
              "is_df_discount_basket_value_deal"),
        string_keys=(("join_order_id", "order_id"),), predicate=since_period("registered_date"),
        doc="S14 dynamic pricing per order"),
    SourceSpec(
        "df090_dma_discounts_bines",
        _cols("order_id", "descuento", "aporte_peya", "aporte_banco", "aporte_partner",
              "inv_peya_en_lcy", "inv_bancos_en_lcy", "inv_partner_en_lcy"),
        string_keys=(("join_order_id", "order_id"),), doc="S15 bank discounts"),
    SourceSpec("dmart_purchase_missions", _cols("user_id", "month", "category"),
               string_keys=(("join_user_id", "user_id"),), month_keys=(("join_month", "month"),),
               doc="S16 purchase mission per user month"),
    SourceSpec("dmart_behavioural_clustering",
               _cols("user_id", "month", "dmart_cluster", "final_dm_cluster"),
               string_keys=(("join_user_id", "user_id"),), month_keys=(("join_month", "month"),),
               doc="S17 behavioural cluster per user month"),
    SourceSpec(
        "dmarts_customer_compliant",
        _cols("order_number", "customer_id", "ccr1", "ccr2", "ccr3", "user_fraud",
              "user_trust_segment", "case_origin", "amount", "euros", "case_number"),
        string_keys=(("join_order_id", "order_number"), ("join_customer_id", "customer_id")),
        predicate=lambda cfg: (F.col("country") == C.COUNTRY_NAME) & since_period("order_date")(cfg),
        doc="S18 complaints of the period"),
    SourceSpec(
        "orders_pe",
        _cols("order_id", "estimated_prep_time", "updated_prep_time", "to_customer_time",
              "timing_promised_delivery_time", "actual_delivery_time", "is_order_late_10",
              "is_vendor_late", "count_orders_inaccuracy", "is_pre_order", "total_orders_vl",
              "dropoff_distance_manhattan", "is_stacked", "hold_back_time"),
        string_keys=(("join_order_id", "order_id"),), predicate=since_period("created_date"),
        doc="S19 delivery timings of the period"),
    SourceSpec(
        "dmart_growth_tracker",
        _cols("user_id", "month", "bop_level_0", "bop_level_1", "bop_level_2", "benefit_segment",
              "month_dechurned", "platform_current_frequency", "sundays_boolean",
              "sundays_boolean_last_month", "activated_by", "last_month_activated_by",
              "user_dmart_frequency_interval", "dmart_category_range", "dmart_lifetime_stage",
              "plus_dmarts_lifecycle", "user_range_retention_tag"),
        string_keys=(("join_user_id", "user_id"),), month_keys=(("join_month", "month"),),
        doc="S20 growth tracker per user month"),
    SourceSpec("fact_groceries_shopping_missions", _cols("order_id", "mission_type"),
               string_keys=(("join_order_id", "order_id"),), predicate=since_period("registered_date"),
               doc="S21 shopping mission per order"),
]}

ROLES = tuple(SPECS)


def roles_from_catalog(spark: SparkSession, table_names: dict[str, str]) -> dict[str, DataFrame]:
    """Production: role name -> catalog table name."""
    return {role: spark.table(name) for role, name in table_names.items()}


def load_all(raw: dict[str, DataFrame], cfg: RunConfig) -> dict[str, DataFrame]:
    """Normalise every raw role table given in ``raw`` (role name -> DataFrame)."""
    return {name: load_source(raw[name], SPECS[name], cfg) for name in ROLES if name in raw}
