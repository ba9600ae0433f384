"""Classification rules R1-R33: pure Column functions, ordered ``when`` chains.

First match wins and a NULL comparison never matches, exactly as in a SQL searched CASE.
Thresholds and labels are arguments with the reference's values as defaults (config.py).
"""

from __future__ import annotations


from pyspark.sql import Column
from pyspark.sql import functions as F

from ordermart import config as C
from ordermart.functions.dates import month_diff

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _chain(branches: list[tuple[Column, Column]], otherwise: Column | None = None) -> Column:
    expr = None
    for cond, value in branches:
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return expr if otherwise is None else expr.otherwise(otherwise)


# --- order lines and order rollup --------------------------------------------------------

def ild_amount(audience: ColumnOrName, campaign: ColumnOrName, purpose: ColumnOrName,
               discount: ColumnOrName) -> Column:
    """The discount counts as item-level discount (ILD) for targeted audiences, except
    excluded campaign patterns and purposes; NULL name / purpose never qualify."""
    name = F.lower(_c(campaign))
    cond = F.lower(_c(audience)).isin(*C.ILD_AUDIENCES)
    for pattern in C.ILD_EXCLUDED_CAMPAIGN_PATTERNS:
        cond = cond & ~name.like(pattern)
    cond = cond & ~F.lower(_c(purpose)).isin(*C.ILD_EXCLUDED_PURPOSES)
    return F.when(cond, _c(discount)).otherwise(F.lit(0))


def basket_segment(items: ColumnOrName, outlier_above=C.BASKET_OUTLIER_ABOVE,
                   segments=C.BASKET_SEGMENTS) -> Column:
    """R2: basket size segment on the fulfilled quantity; gaps, zero, negatives and NULL
    are invalid."""
    x = _c(items)
    branches = [(x > outlier_above, F.lit(C.BASKET_OUTLIERS))]
    branches += [(x.between(lo, hi), F.lit(label)) for lo, hi, label in segments]
    return _chain(branches, F.lit(C.BASKET_INVALID))


def value_band(amount: ColumnOrName, bands=C.AFV_BANDS, lowest=C.AFV_LOWEST) -> Column:
    """R3 (afv_segment) and any ``>= edge`` ladder: first lower edge reached, else ``lowest``."""
    x = _c(amount)
    return _chain([(x >= edge, F.lit(label)) for edge, label in bands], F.lit(lowest))


def discount_incentivized(ratio: ColumnOrName, threshold: float = 0.25) -> Column:
    """1 if the discount ratio reaches ``threshold`` (NULL ratio -> 0)."""
    return F.when(_c(ratio) >= F.lit(threshold), F.lit(1)).otherwise(F.lit(0))


# --- user lifecycle -----------------------------------------------------------------------

def growth_status(month_type: ColumnOrName) -> Column:
    """A spine month without a lifecycle row is a churned month."""
    return F.coalesce(_c(month_type), F.lit(C.CHURNED))


def afv_performance(status: ColumnOrName, freq: ColumnOrName, prev_freq: ColumnOrName,
                    afv: ColumnOrName, prev_afv: ColumnOrName) -> Column:
    """R7."""
    s, f, pf, a, pa = map(_c, (status, freq, prev_freq, afv, prev_afv))
    return _chain([
        (s.isin(*C.STATUS_PASSTHROUGH), F.lower(s)),
        ((f > pf) & (a > pa), F.lit("increased_afv_frec")),
        (a > pa, F.lit("increased_afv")),
        (a < pa, F.lit("decreased_afv")),
    ], F.lit("steady performance"))


def frec_performance(status: ColumnOrName, freq: ColumnOrName, prev_freq: ColumnOrName) -> Column:
    """R8."""
    s, f, pf = map(_c, (status, freq, prev_freq))
    return _chain([
        (s.isin(*C.STATUS_PASSTHROUGH), F.lower(s)),
        (f > pf, F.lit("increased_frec")),
        (f < pf, F.lit("decreased_frec")),
    ], F.lit("steady performance"))


def growth_status_fixed(status: ColumnOrName, prev_status: ColumnOrName) -> Column:
    """A 'Recurring Return' right after 'Reactivated' is a 'Reorder'."""
    s, p = _c(status), _c(prev_status)
    return F.when((p == "Reactivated") & (s == "Recurring Return"), F.lit("Reorder")).otherwise(s)


def churn_type(status: ColumnOrName, prev_status: ColumnOrName) -> Column:
    """R10."""
    s, p = _c(status), _c(prev_status)
    churned = s == C.CHURNED
    return _chain([
        (s != C.CHURNED, s),
        (p.isin(*C.EARLY_CHURN_PRIOR) & churned, F.lit("dmart_early_churn")),
        (churned & (p == C.CHURNED), F.lit("dmart_recurring_churn")),
        (churned & (p == "Reactivated"), F.lit("dmart_strong_churn")),
    ], F.lit("regular churn"))


def platform_performance(platform_status: ColumnOrName, status: ColumnOrName,
                         current: ColumnOrName, prior: ColumnOrName) -> Column:
    """R11."""
    ps, s, cur, pri = map(_c, (platform_status, status, current, prior))
    return _chain([
        (ps == C.CHURNED, F.lit("churned")),
        (s == "Reactivated", F.lit("reactivated")),
        (cur > pri, F.lit("increased_frec")),
        (cur < pri, F.lit("decreased_frec")),
    ], F.lit("steady performance"))


def activation_period(month: ColumnOrName, last_active: ColumnOrName) -> Column:
    """Months since the last active month, 0 when there is none."""
    return F.coalesce(month_diff(month, last_active), F.lit(0))


# --- order enrichment ---------------------------------------------------------------------

def business_stage(order_date: ColumnOrName, edges=C.STAGE_EDGES, labels=C.STAGE_LABELS) -> Column:
    """NULL dates fall to the last stage."""
    d = _c(order_date)
    lo, hi = (F.lit(e) for e in edges)
    return _chain([(d < lo, F.lit(labels[0])), (d.between(lo, hi), F.lit(labels[1]))], F.lit(labels[2]))


def date_in_window(d: ColumnOrName, since: ColumnOrName, until: ColumnOrName,
                   inside: str, outside: str) -> Column:
    """Inclusive window test; NULL bounds count as outside."""
    return F.when(_c(d).between(_c(since), _c(until)), F.lit(inside)).otherwise(F.lit(outside))


def bin_campaign_flags(campaign: ColumnOrName) -> dict[str, Column]:
    """Three case-sensitive tests on the bank-discount campaign name."""
    c = _c(campaign)
    return {
        "sunday_plus": F.when(c == C.SUNDAY_PLUS_CAMPAIGN, 1).otherwise(0),
        "fija_plus": F.when(c.like(C.FIJA_PATTERN), 1).otherwise(0),
        "plus_benefit_orders": F.when(c.like(C.PLUS_PATTERN), 1).otherwise(0),
    }


def has_delivery_time(total_orders_vl: ColumnOrName, is_pre_order: ColumnOrName) -> Column:
    """R16a (boolean)."""
    return F.when((_c(total_orders_vl) == 1) & (_c(is_pre_order) == 0), F.lit(True)).otherwise(F.lit(False))


def late_order(actual: ColumnOrName, promised: ColumnOrName) -> Column:
    """R16b."""
    return F.when(_c(actual) > _c(promised), 1).otherwise(0)


def voucher_used(coupon_amount: ColumnOrName) -> Column:
    """A voucher counts when its amount is >= 0 (zero counts, NULL does not)."""
    return _c(coupon_amount) >= 0


def no_voucher(coupon_amount: ColumnOrName) -> Column:
    a = _c(coupon_amount)
    return a.isNull() | (a < 0)


def coupon_type(coupon_amount, v_type, plus_order, plus_first: bool = False) -> Column:
    """``coupon_type`` (voucher first) and, with ``plus_first``, ``coupon_type_barter``."""
    voucher = (voucher_used(coupon_amount), _c(v_type))
    plus = (_c(plus_order) > 0, F.lit("Plus"))
    return _chain([plus, voucher] if plus_first else [voucher, plus], F.lit("Organic"))


def shopping_mission(items: ColumnOrName, categories: ColumnOrName) -> Column:
    """Derived mission of one order; NULL when nothing matches."""
    n, k = _c(items), _c(categories)
    return _chain([
        (n.between(1, 5) | k.between(1, 2), F.lit("Instant Need")),
        (n.between(6, 15) & k.between(3, 4), F.lit("Fill In")),
        ((n > 15) & (k >= 5), F.lit("Stock Up")),
        (n > 5, F.lit("Fill In")),
    ])


def order_source(has_bins, is_user_plus, crm_vertical, coupon_amount, v_type) -> Column:
    """R19."""
    v = voucher_used(coupon_amount)
    return _chain([
        (_c(has_bins) == 1, F.lit("Bin")),
        (_c(is_user_plus) > 0, F.lit("Plus")),
        (_c(crm_vertical) == C.DMART_VERTICAL, F.lit("Dmart RMO")),
        (v & _c(v_type).isin(*C.RMO_COUPON_TYPES), _c(v_type)),
        (v, F.lit("Other Vouchers")),
    ], F.lit("Organic"))


def order_source_level_one(has_bins, is_user_plus, crm_vertical, coupon_amount) -> Column:
    """R20."""
    return _chain([
        (_c(has_bins) == 1, F.lit("3-Bin")),
        (_c(is_user_plus) > 0, F.lit("2.Plus")),
        (_c(crm_vertical) == C.DMART_VERTICAL, F.lit("4.Dmart RMO")),
        (voucher_used(coupon_amount), F.lit("5.Other Vouchers")),
    ], F.lit("1.Organic"))


def flag_plus(plus_order, plus_item_level) -> Column:
    """2 = plus order with item-level plus discount, 1 = plus only, else 0."""
    po, pil = _c(plus_order), _c(plus_item_level)
    return _chain([((po > 0) & (pil > 0), F.lit(2)), ((po > 0) & (pil == 0), F.lit(1))], F.lit(0))


def peyaplus(plus_order) -> Column:
    """R22."""
    return F.when(_c(plus_order) > 0, F.lit("PeYa Plus Order")).otherwise(F.lit("Regular Order"))


def voucher_flags(coupon_amount) -> dict[str, Column]:
    """R23."""
    v = voucher_used(coupon_amount)
    return {
        "flag_vc": F.when(v, 1).otherwise(0),
        "flag_voucher": F.when(v, F.lit("Voucher")).otherwise(F.lit("No Voucher")),
    }


def delivery_fee_flags(fee, max_free: float = C.FREE_DELIVERY_MAX_FEE) -> dict[str, Column]:
    """A NULL fee counts as free delivery here."""
    paid = _c(fee) > max_free
    return {
        "flag_df": F.when(paid, F.lit("Inc. Delivery Fee")).otherwise(F.lit("No Inc. DF")),
        "flag_delivery_free": F.when(paid, 0).otherwise(1),
    }


def order_sub_nature(coupon_amount, fee, max_free: float = C.FREE_DELIVERY_MAX_FEE) -> Column:
    """A NULL fee is *not* free here (unlike R24)."""
    free = _c(fee) <= max_free
    return F.when(
        voucher_used(coupon_amount),
        F.when(free, F.lit("Voucher & Free Delivery")).otherwise(F.lit("Voucher")),
    ).otherwise(F.when(free, F.lit("Free Delivery")).otherwise(F.lit("Organic Order")))


def first_order_expressions(order_date, acq_since, acq_until, is_ild, coupon_amount,
                            plus_order, plus_item_level, campaign, funnel, crm_vertical) -> dict[str, Column]:
    """Per-order expressions whose first value per customer is published.
    NULL acquisition bounds give 'adoption' (the opposite default of R14)."""
    d = _c(order_date)
    v = voucher_used(coupon_amount)
    po, pil = _c(plus_order), _c(plus_item_level)
    return {
        "adoption_origin": F.when((d >= _c(acq_since)) & (d <= _c(acq_until)), F.lit("acquisition"))
        .otherwise(F.lit("adoption")),
        "adoption_class": _chain([
            (_c(is_ild) == 1, F.lit("ILD Trial")),
            (v, F.lit("Voucher Trial")),
            ((po > 0) & (pil > 0), F.lit("ILD Plus")),
            ((po > 0) & (pil == 0), F.lit("Plus Trial")),
        ], F.lit("Organic")),
        "adoption_class_test": F.when(v, F.lit("Voucher Incentivized")).otherwise(F.lit("Organic")),
        "adoption_coupon_used": F.when(v, _c(campaign)),
        "adoption_funnel_used": F.when(v, _c(funnel)),
        "adoption_vertical_attributed": F.when(v, _c(crm_vertical)),
    }


def month_activation_expressions(coupon_amount, plus_order, plus_item_level, crm_vertical) -> dict[str, Column]:
    """Per-order expressions whose first value per customer-month is published."""
    v, nv = voucher_used(coupon_amount), no_voucher(coupon_amount)
    po, pil = _c(plus_order), _c(plus_item_level)
    return {
        "month_activation_source": _chain([
            (v, F.lit("CRM")),
            (nv & ((po > 0) & (pil == 0)), F.lit("Plus")),
            (nv & ((po > 0) & (pil > 0)), F.lit("Plus Item Level")),
        ], F.lit("Organic")),
        "month_activation_funnel_source": _chain([
            (v, _c(crm_vertical)),
            (nv & (po > 0), F.lit("Plus")),
        ], F.lit("Organic")),
    }


def inaccuracy_flags(ccr1, late) -> dict[str, Column]:
    """R28."""
    has = _c(ccr1).isNotNull()
    return {
        "flag_inaccuracy": F.when(has, 1).otherwise(0),
        "inaccuracy_late": F.when(has & (_c(late) == 1), 1).otherwise(0),
    }


def week_and_day(week, start_day) -> Column:
    """R29: 'W' + week + '-' + first weekday; NULL if any part is NULL."""
    return F.concat(F.lit("W"), _c(week).cast("string"), F.lit("-"), _c(start_day).cast("string"))


def duration_band(minutes, bands=C.TIME_BANDS, top=C.TIME_BAND_TOP) -> Column:
    """Inclusive upper edges; negative or NULL durations have no band."""
    x = _c(minutes)
    return F.when(x >= 0, _chain([(x <= edge, F.lit(label)) for edge, label in bands], F.lit(top)))


def user_mission(has_stock_up, has_fill_in) -> Column:
    """R31."""
    return _chain([(_c(has_stock_up) == 1, F.lit("Stock Up")), (_c(has_fill_in) == 1, F.lit("Fill In"))],
                  F.lit("Instant Need"))


def _level_tail(crm_vertical, flag_vc, order_source_col, multibuy, discount_order):
    return [
        (_c(crm_vertical) == C.DMART_VERTICAL, F.lit("Dmart RMO")),
        (_c(flag_vc) == 1, _c(order_source_col)),
        (_c(multibuy) == 1, F.lit("Organic Multibuy")),
        (_c(discount_order) == 1, F.lit("Organic Discount")),
    ]


def order_source_level_two(flag_plus_col, crm_vertical, flag_vc, order_source_col, multibuy, discount_order) -> Column:
    """R32."""
    return _chain([(_c(flag_plus_col) >= 1, F.lit("Plus"))]
                  + _level_tail(crm_vertical, flag_vc, order_source_col, multibuy, discount_order),
                  F.lit("Organic"))


def order_source_level_three(flag_plus_col, bin_campaign, crm_vertical, flag_vc, order_source_col,
                             multibuy, discount_order) -> Column:
    """R33."""
    fp, b = _c(flag_plus_col), _c(bin_campaign)
    return _chain([
        (fp > 1, F.lit("Plus Item Level")),
        ((fp == 1) & b.isNull(), F.lit("Plus")),
        ((fp == 1) & b.isNotNull(), F.lit("Plus Benefit")),
    ] + _level_tail(crm_vertical, flag_vc, order_source_col, multibuy, discount_order), F.lit("Organic"))
