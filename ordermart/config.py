"""Run parameters, fixed business values and the published column contract."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class RunConfig:
    """Parameters of one mart run.

    ``as_of`` plays the role of the warehouse's "today": the loaded period starts at
    ``period_start(as_of)`` and the user-month spine runs up to the month of ``as_of``.
    ``spine_end`` overrides the spine's last month (tests run a past period against
    data that continues after it).  ``discount_incentive_threshold`` is the ratio from
    which an order counts as discount-incentivised.
    """

    as_of: dt.date
    spine_end: dt.date | None = None
    discount_incentive_threshold: float = 0.25
    # minute buckets that split a hot customer's rows before ranking them (operators.windows)
    rank_segment: str = "minute"
    # groups of more rows than this are split by sampled bounds of their order (operators.slices)
    slice_rows: int = 1_000_000
    # bits of the filter of the period's order keys that undated sources are probed with (operators.keyfilter); 0: none
    key_filter_bits: int = 1 << 23
    # product categories counted as sets of bits, at most (operators.bitsets); of more, or 0: as distinct values
    category_codes: int = 1024
    # buckets of sources laid out by order key (sources.layout), and partitions of the order rows that meet them; 0: the session's
    order_buckets: int = 0

    @property
    def period_start(self) -> dt.date:
        return period_start_date(self.as_of)

    @property
    def spine_last_month(self) -> dt.date:
        end = self.spine_end or self.as_of
        return end.replace(day=1)


def period_start_date(as_of: dt.date) -> dt.date:
    """Driver-side twin of ``functions.dates.period_start`` (P2): day 1 → previous month."""
    if as_of.day <= 3:
        prev = as_of - dt.timedelta(days=1)
        return prev.replace(day=1)
    return as_of.replace(day=1)


# --------------------------------------------------------------------------------------
# These literals must equal the reference's for identical results.
# --------------------------------------------------------------------------------------

# R1 ild_amount
ILD_AUDIENCES = ("segment_user", "new_user")
ILD_EXCLUDED_CAMPAIGN_PATTERNS = ("%%test ild%%", "%%_category_%%")
ILD_EXCLUDED_PURPOSES = ("expiring Soon", "overstock", "delisting")

# source filters
COUNTRY_CODE = "pe"
CONFIRMED_STATE = "CONFIRMED"
COUNTRY_NAME = "Perú"
PAYMENTS_COUNTRY_ID = 7
PAYMENT_ACCEPTED = "ACCEPTED"

# R2 basket_segment: above BASKET_OUTLIER_ABOVE -> outliers; then (low, high, label) inclusive
BASKET_OUTLIER_ABOVE = 19
BASKET_OUTLIERS = "Outliers"
BASKET_SEGMENTS = (
    (15, 19, "Supermarket Family Size"),
    (7, 14, "Supermarket Orders"),
    (5, 6, "Healthy Convenience"),
    (3, 4, "Convenience Orders"),
    (1, 2, "Impulse Orders"),
)
BASKET_INVALID = "Invalid Basket Size"

# R3 afv_segment: (lower edge, label), first match from the top; else AFV_LOWEST
AFV_BANDS = (
    (99, "[99,+]"),
    (90, "[90,99]"),
    (80, "[80,89]"),
    (70, "[70,79]"),
    (60, "[60,69]"),
    (50, "[50,59]"),
    (40, "[40,49]"),
    (30, "[30,39]"),
    (20, "[20,29]"),
    (10, "[10,19]"),
)
AFV_LOWEST = "[00,09]"

# R4 order flags
FRESH_LEVELS = ("Fresh", "Ultra Fresh")
ULTRA_FRESH_LEVEL = "Ultra Fresh"
MULTIBUY_SUBTYPE = "multi-buy"
SUBSCRIBED_AUDIENCE = "SUBSCRIBED_USER"

# R6 .. R12 user lifecycle
CHURNED = "Churned"
STATUS_PASSTHROUGH = ("Adoption", "Churned", "Reactivated")
EARLY_CHURN_PRIOR = ("Adoption", "M1 Return")

# R13 business_stage
STAGE_EDGES = (dt.date(2022, 7, 1), dt.date(2022, 12, 31))
STAGE_LABELS = ("Growth Stage", "Improving the Basics", "Growth & Profitability")

# R15 bin campaign flags
SUNDAY_PLUS_CAMPAIGN = "Plus en PedidosYa Market"
FIJA_PATTERN = "%Fija%"
PLUS_PATTERN = "%Plus%"

# R19 / R20 order source
RMO_COUPON_TYPES = ("RMO", "RMA", "RAF")
DMART_VERTICAL = "DMART"

# R24 / R25 delivery fee
FREE_DELIVERY_MAX_FEE = 0.5

# R30 delivery-time bands: (upper edge inclusive, label); above the last: TIME_BAND_TOP
TIME_BANDS = ((10, "[0,10]"), (20, "[10,20]"), (30, "[20,30]"), (40, "[30,40]"), (50, "[40,50]"))
TIME_BAND_TOP = "[50,+]"

# tax divisor used twice (shipping, voucher)
TAX_DIVISOR = 1.18

# --------------------------------------------------------------------------------------
# The published contract: 174 columns, strictly in this order (the target is appended
# by position).
# --------------------------------------------------------------------------------------
OUTPUT_COLUMNS = (
    "order_date", "order_timestamp", "hour", "year", "month", "week_of_year", "store_name",
    "vendor_id", "sku_level_customer_id", "customer_id", "customer_adverted_id",
    "business_stage", "adoption_type", "acquisition_type",
    "cohort_date", "mes_en_curso", "type_user", "crm_pe_dm_cluster", "crm_pe_dmart_cluster",
    "crm_pe_dmart_cluster_prior_month",
    "platform_performance", "platform_status", "platform_prior_status",
    "dmart_churn_type_prior_month", "dmart_frec_performance", "dmart_afv_performance",
    "dmart_growth_status_past_month", "dmart_growth_status", "dmart_growth_stage",
    "dmart_last_month_active", "dmart_activation_period",
    "dmart_shopping_mission", "dmart_pm_shopping_mission_prior_month",
    "comp_ccr1", "comp_ccr2", "comp_ccr3", "comp_user_fraud", "comp_case_origin",
    "user_trust_segment",
    "d_bin_campaign", "d_aporte_peya", "d_aporte_banco", "d_aporte_partner", "d_inv_peya",
    "d_inv_bancos", "d_inv_partner", "sunday_plus", "fija_plus", "plus_benefit_orders",
    "health_status", "h_int_type", "h_funnel", "h_lifecycle_stage",
    "u_age", "age_group", "gender", "gender_merged", "dh_age_prediction",
    "dh_gender_prediction", "u_cell_segment", "u_income", "u_segmemnt",
    "u_user_demographic_group",
    "bop_level_0", "bop_level_1", "bop_level_2", "benefit_segment",
    "platform_current_frequency", "month_dechurned", "sundays_boolean",
    "sundays_boolean_last_month", "activated_by", "last_month_activated_by", "wine_user",
    "dmart_category_range", "user_dmart_frequency_interval", "dmart_lifetime_stage",
    "plus_dmarts_lifecycle", "user_range_retention_tag", "rmo_high_mov", "rmo_qc_dmart",
    "order_id", "bank", "operation_type", "payment_name",
    "estimated_prep_time", "updated_prep_time", "to_customer_time",
    "timing_promised_delivery_time", "actual_delivery_time", "is_order_late_10",
    "is_vendor_late", "is_inaccuracy", "is_pre_order", "has_delivery_time", "late_order",
    "fo_dropoff_distance_manhattan",
    "delivery_fee_revenue", "total_amount", "shipping_amount", "shipping_amount_no_discount",
    "shipping_amount_visualized", "maxMinutes", "minMinutes", "is_user_plus",
    "coupon_type", "coupon_segment", "coupon_nivel", "coupon_funnel", "coupon_purpose",
    "coupon_campaign", "coupon_campaign_id", "crm_vertical", "crm_lifecycle", "coupon_origin",
    "coupon_type_barter", "crm_pe_cluster",
    "order_source", "order_source_level_one",
    "dps_dropoff_distance_manhattan_meters", "dps_order_delay_mins", "dps_scheme_id",
    "dps_mov_lc", "dps_df_applied", "dps_basket_value", "flag_basket_value",
    "mission_type", "basket_segment", "fresh_order", "ultra_fresh_order", "discount_order",
    "discount_incentivized", "multibuy_order", "gfv", "gmv", "cost", "theoric_margin",
    "front_margin", "discounts", "basket_sz", "afv_segment", "categories",
    "flag_stacked", "flag_plus", "is_ild", "peyaplus", "voucher_amount_net", "flag_vc",
    "flag_df", "flag_voucher", "flag_delivery_free", "order_sub_nature",
    "order_number", "order_num_month", "hold_back_time",
    "flag_inaccuracy", "inaccuracy_late", "month_activation_source",
    "month_activation_funnel_source", "adoption_origin", "adoption_class",
    "adoption_class_test", "adoption_coupon_used", "adoption_funnel_used",
    "adoption_vertical_attributed", "wsd_week_and_day", "wsd_start_day",
    "dh_shopping_mission", "timings_actual_dt_interval", "timings_potential_dt_interval",
    "dh_shopping_mission_user", "dh_shopping_mission_user_v2", "order_source_level_two",
    "order_source_level_three",
)

assert len(OUTPUT_COLUMNS) == 174 and len(set(OUTPUT_COLUMNS)) == 174

# C16 adds these to C15's rows, which have four flags of their own besides the other published columns
FINAL_COLUMNS = ("flag_inaccuracy", "inaccuracy_late", "wsd_week_and_day", "dh_shopping_mission", "timings_actual_dt_interval",
                 "timings_potential_dt_interval", "dh_shopping_mission_user", "dh_shopping_mission_user_v2", "order_source_level_two",
                 "order_source_level_three")
MISSION_FLAGS = ("has_stock_up_mission", "has_fill_in_mission", "user_has_stock_up_v2", "user_has_fill_in_v2")
ENRICHED_COLUMNS = (*(c for c in OUTPUT_COLUMNS if c not in FINAL_COLUMNS), *MISSION_FLAGS)

assert len(ENRICHED_COLUMNS) == 168
