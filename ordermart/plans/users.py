"""User branch: C1-C4, C10-C13 (user x month lifecycle spine and its metrics).

A user's spine is a run of months, kept as its two ends.  Only months in which a source has a row of the user
are joined and shuffled; the idle months between them are generated after the rows have met on the user.
Every window is partitioned by user and ordered by month.  A user has a row per month, times the fan-out of the left
joins; if one has more active rows than ``cfg.slice_rows``, the windows become scans over slices of the
order (``operators.slices``).  Window orders end in the payload
columns, so rows that repeat a (user, month) give the same values in any input order.  The tables
keep rows with a NULL user; the mart drops them before it comes here (``known_users``), as
``NULL = x`` is never true.
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermart.config import RunConfig
from ordermart.functions import rules as R
from ordermart.functions.dates import month_diff, month_sequence
from ordermart.functions.numeric import safe_ratio
from ordermart.operators.bitsets import codes_of, set_of, size_of, with_code
from ordermart.operators.joins import JoinSpec, enrich, meet
from ordermart.operators.slices import scan
from ordermart.operators.spine import expand, fill_idle, month_intervals
from ordermart.operators.windows import last_active_before, partition_total, prior_value
from ordermart.session import cut_lineage

USER_MONTH = ["join_user_id", "join_month"]
CATEGORY = "master_category_parent_english"
# what C4 reads of the order lines
LINE_READS = ["join_customer_id", "join_order_month", "join_order_id", "fulfilled_quantity", "total_amount_net_with_discount_lc", CATEGORY]


def add_months(d: dt.date, n: int) -> dt.date:
    y, m = divmod(d.year * 12 + d.month - 1 + n, 12)
    return dt.date(y, m + 1, 1)


def spine_floor(cfg: RunConfig) -> dt.date:
    """First month the mart can read: the mart joins only order months >= period start,
    and the deepest look-back is two months (LAG of a rule over a LAG).  ``last_month_active``
    only sees months with loaded order lines, which start at the period start.  So the
    spine can start two months before the period without changing any published value."""
    return add_months(cfg.period_start, -2)


def user_global_dates(s1: DataFrame) -> DataFrame:
    """One row per distinct (user, adoption and acquisition window)."""
    return (s1.select(F.col("join_id").alias("join_user_id"), "adoption_since", "acquisition_since",
                      "adoption_until", "acquisition_until")
            .distinct())


def user_intervals(ugd: DataFrame, cfg: RunConfig, floor: dt.date | None = None) -> DataFrame:
    """A user's spine as its first and last month."""
    return month_intervals(ugd, "join_user_id", "adoption_since", cfg.spine_last_month, floor)


def date_grid(ugd: DataFrame, cfg: RunConfig, floor: dt.date | None = None) -> DataFrame:
    """Dense (user, month) spine from the adoption month to the spine's last month."""
    return expand(user_intervals(ugd, cfg, floor), "join_user_id")


def user_monthly_status(s1: DataFrame, floor: dt.date | None = None) -> DataFrame:
    """Lifecycle type and month-of-life per (user, month)."""
    if floor is not None:
        s1 = s1.where(F.col("join_month") >= F.lit(floor))
    return s1.select(F.col("join_id").alias("join_user_id"), "join_month", "type", "mes_en_curso")


def user_monthly_orders(lines: DataFrame, code_limit: int = 0, every: DataFrame | None = None) -> DataFrame:
    """C4 / A3: orders, basket size, categories and average order value per (user, month).

    Two distinct counts would copy every line for each of them (an Expand).  The categories are few: if there are
    no more than ``code_limit``, they are counted as sets of bits beside the sums, and one distinct count is left.
    ``every``: rows that ``lines`` were picked from, if their categories are cheaper to look up."""
    n_orders = F.countDistinct("join_order_id")
    codes = codes_of(lines if every is None else every, CATEGORY, code_limit) if code_limit else None
    rows = lines if codes is None else with_code(lines, codes)
    sets = [F.countDistinct(CATEGORY).alias("categories")] if codes is None else set_of(codes)
    out = (rows.groupBy(F.col("join_customer_id").alias("join_user_id"),
                        F.col("join_order_month").alias("join_month"))
           .agg(n_orders.alias("dm_current_frequency"),
                safe_ratio(F.sum("fulfilled_quantity"), n_orders).alias("basket_size"),
                *sets,
                safe_ratio(F.sum("total_amount_net_with_discount_lc"), n_orders).alias("afv")))
    if codes is None:
        return out
    return out.select(*USER_MONTH, "dm_current_frequency", "basket_size", size_of(codes).alias("categories"), "afv")


DATES = ("adoption_since", "acquisition_since", "adoption_until", "acquisition_until")


def active_months(ums: DataFrame, umo: DataFrame, more: list[JoinSpec] = ()) -> DataFrame:
    """The user months that a source has rows of, with all their rows (L4, L5 [, ``more``]); no user, no match."""
    specs = [JoinSpec(ums, USER_MONTH, USER_MONTH, {"type": "type", "mes_en_curso": "mes_en_curso"}, name="L4 monthly status"),
             JoinSpec(umo, USER_MONTH, USER_MONTH, {c: c for c in ("dm_current_frequency", "basket_size", "categories", "afv")}, name="L5 monthly orders"),
             *more]
    return meet(specs, USER_MONTH)


# last month of a run of idle months that is kept as one row
RUN_END = "_run_end"


def dmart_data(intervals: DataFrame, ugd: DataFrame, active: DataFrame, runs: bool = False) -> DataFrame:
    """Spine ⟕ monthly status ⟕ monthly orders (L4, L5) [⟕ further user-month joins] ⟕ user dates (L3).
    ``active``: the rows of ``active_months``.  Idle months have no row of any source: they are the months of
    the user's interval without an active one, generated where the user's rows are; with ``runs`` a run of them is
    one row here, and ``user_data`` makes its months."""
    df = fill_idle(intervals, active, "join_user_id", until=RUN_END if runs else None)
    df = enrich(df, [JoinSpec(ugd, ["join_user_id"], ["join_user_id"], {c: c for c in DATES}, name="L3 user dates")])
    own = ("type", "mes_en_curso", "dm_current_frequency", "basket_size", "categories", "afv")
    extra = [c for c in active.columns if c not in (*USER_MONTH, *own)]
    return df.select(
        "join_user_id",
        R.growth_status("type").alias("dmart_growth_status"),
        "type", "mes_en_curso", *DATES, "join_month",
        F.coalesce(F.col("dm_current_frequency"), F.lit(0)).alias("dm_current_frequency"),
        "basket_size", "categories", "afv", *extra, *([RUN_END] if runs else []),
    )


MONTHLY_INFO = ["present_month_status_user", "past_month_status_user", "dm_past_month_orders",
                "f_present_month_orders", "ls_present_month_orders", "c_present_month_orders",
                "f_past_month_orders", "ls_past_month_orders", "c_past_month_orders"]


def monthly_info_join(s3: DataFrame) -> JoinSpec:
    """Platform info per (user, month), columns prefixed ``m_``."""
    return JoinSpec(s3, USER_MONTH, USER_MONTH, {f"m_{c}": c for c in MONTHLY_INFO}, name="L6 monthly info")


# rows that repeat a (user, month) are told apart by what the windows read
USER_MONTH_ORDER = ["join_month", "type", "mes_en_curso", "adoption_since", "acquisition_since", "adoption_until",
                    "acquisition_until", "dm_current_frequency", "afv", "platform_status", "platform_prior_status"]


TWO_BEFORE = "_status_two_before"

# months of a user that the caller reads, an array beside the user
MONTHS_READ = "_months_read"


def order_users(lines: DataFrame, fact: DataFrame) -> DataFrame:
    """Distinct (order, user of the order fact, month) of the order lines; an order that the fact doesn't know has no user."""
    orders = lines.select("join_order_id", "join_order_month").distinct()
    users = fact.select(F.col("join_order_id").alias("_order"), F.col("join_user_id").alias("o1_join_user_id"))
    return orders.join(users, F.col("join_order_id") == F.col("_order"), "left").select("join_order_id", "o1_join_user_id", "join_order_month").distinct()


def months_of(triples: DataFrame) -> DataFrame:
    """The users of ``order_users`` with the months of their orders."""
    known = triples.where(F.col("o1_join_user_id").isNotNull())
    return known.groupBy(F.col("o1_join_user_id").alias("join_user_id")).agg(F.collect_set("join_order_month").alias(MONTHS_READ))


def months_read(lines: DataFrame, fact: DataFrame) -> DataFrame:
    """The users of the order fact (L16's key) that order lines meet, with the months of their orders."""
    return months_of(order_users(lines, fact))


def idle_status() -> Column:
    return R.growth_status(F.lit(None).cast("string"))


def idle_months(df: DataFrame, prior: dict[str, str]) -> DataFrame:
    """The months of runs that the windows saw as one row, the run's first month.

    Rows of idle months differ in nothing that a later row looks back on, so what the windows give the months after
    the first is known: the month before was idle.  Two rows before is idle, too, but for the second month's only
    row, which finds there what the first month found one row before."""
    if MONTHS_READ in df.columns:  # no others are made: those of them that are months of the run
        start = F.col("join_month")
        of_run = lambda m: (m >= start) & (m <= F.col(RUN_END)) & (F.add_months(start, month_diff(m, start)) == m)
        df = df.select("*", F.explode(F.filter(MONTHS_READ, of_run)).alias("_month")).drop(MONTHS_READ)
        df = df.withColumn("_nth", month_diff("_month", "join_month"))
    else:
        df = df.select("*", F.posexplode(month_sequence(F.col("join_month"), F.col(RUN_END))).alias("_nth", "_month"))
    idle = {"dmart_growth_status": idle_status(), "dm_current_frequency": F.lit(0)}
    before = {n: F.when(F.col("_nth") > 0, idle.get(c, F.lit(None))).otherwise(F.col(n)) for n, c in prior.items()}
    two = (F.when((F.col("_nth") == 1) & (F.col("_rows_of_month") == 1), F.col("dmart_growth_status_past_month"))
           .when(F.col("_nth") > 0, idle_status()).otherwise(F.col(TWO_BEFORE)))
    return df.withColumns({TWO_BEFORE: two, **before, "join_month": F.col("_month")}).drop("_nth", "_month", "_rows_of_month", RUN_END)


def user_data(dd: DataFrame, limit: int = 0, cut=cut_lineage, read: DataFrame | None = None) -> DataFrame:
    """C11 over C10 with the ``m_`` columns of L6: prior-month values (W5-W7), R7/R8, month totals (W9), last
    active month (W10).  Runs of idle months that are one row are expanded after the windows.  ``limit``: split users of more rows.  ``read``: of runs, only the
    months of ``months_read`` are given.  Carries the status of two months before
    for W8 (``prep_united_users`` drops it)."""
    m = MONTHLY_INFO
    df = dd.withColumns({"platform_status": F.col("m_present_month_status_user"),
                         "platform_prior_status": F.col("m_past_month_status_user")})
    prior = {"dmart_growth_status_past_month": "dmart_growth_status", "previous_mes_en_curso": "mes_en_curso",
             "_prev_freq": "dm_current_frequency", "_prev_afv": "afv"}
    bought = F.col("dm_current_frequency") > 0
    if limit:
        df = scan(df, ["join_user_id"], USER_MONTH_ORDER, prior, {"last_month_active": ("join_month", bought)}, limit, cut)
        df = scan(df, ["join_user_id"], USER_MONTH_ORDER, {TWO_BEFORE: "dmart_growth_status_past_month"}, limit=limit, cut=cut)
    else:
        df = prior_value(df, ["join_user_id"], USER_MONTH_ORDER, prior)
        df = prior_value(df, ["join_user_id"], USER_MONTH_ORDER, {TWO_BEFORE: "dmart_growth_status"}, offset=2)
        if RUN_END in df.columns:
            df = prior_value(df, ["join_user_id"], USER_MONTH_ORDER, {"_run_from": "join_month", "_run_to": RUN_END})
        df = last_active_before(df, ["join_user_id"], USER_MONTH_ORDER, "join_month", bought, "last_month_active")
    z = lambda c: F.coalesce(F.col(f"m_{c}"), F.lit(0))
    runs = RUN_END in df.columns
    df = partition_total(df, USER_MONTH, {
        **({"_rows_of_month": F.count(F.lit(1))} if runs else {}),
        "dm_prior_frequency": F.sum("m_dm_past_month_orders"),
        "platform_current_frequency": F.sum(z("f_present_month_orders") + z("ls_present_month_orders")
                                            + z("c_present_month_orders")),
        "platform_prior_frequency": F.sum(z("f_past_month_orders") + z("ls_past_month_orders")
                                          + z("c_past_month_orders")),
        "ls_current_frequency": F.sum(z("ls_present_month_orders") + z("c_present_month_orders")),
        "ls_prior_frequency": F.sum(z("ls_past_month_orders") + z("c_past_month_orders")),
    }).drop(*[f"m_{c}" for c in m])
    if runs:  # after a run of several months, both rows before are idle
        after = (F.col("_run_to") > F.col("_run_from")) & (F.col("_run_from") < F.col("join_month"))
        df = df.withColumn(TWO_BEFORE, F.when(after, idle_status()).otherwise(F.col(TWO_BEFORE))).drop("_run_from", "_run_to")
        if read is not None:
            df = df.join(read.select(USER_MONTH[0], MONTHS_READ), USER_MONTH[0])
        df = idle_months(df, prior)
    df = df.withColumns({
        "dmart_afv_performance": R.afv_performance("dmart_growth_status", "dm_current_frequency", "_prev_freq",
                                                   "afv", "_prev_afv"),
        "dmart_frec_performance": R.frec_performance("dmart_growth_status", "dm_current_frequency", "_prev_freq"),
    })
    return df.drop("_prev_freq", "_prev_afv")


def united_users(ud: DataFrame) -> DataFrame:
    """R9-R12."""
    return ud.withColumns({
        "dmart_growth_status_fixed": R.growth_status_fixed("dmart_growth_status", "dmart_growth_status_past_month"),
        "dmart_churn_type": R.churn_type("dmart_growth_status", "dmart_growth_status_past_month"),
        "platform_performance": R.platform_performance("platform_status", "dmart_growth_status",
                                                       "platform_current_frequency", "platform_prior_frequency"),
        "activation_period": R.activation_period("join_month", "last_month_active"),
    })


def prep_united_users(uu: DataFrame) -> DataFrame:
    """Prior month's churn type (W8): R10 over the statuses of one and two months before.  Only a user's first
    row has no status before."""
    past = "dmart_growth_status_past_month"
    return uu.withColumn("dmart_churn_type_prior_month", F.when(F.col(past).isNotNull(), R.churn_type(past, TWO_BEFORE))).drop(TWO_BEFORE)


def known_users(src: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The user branch's inputs without rows of no user, which nothing in the mart can meet."""
    keys = {"first_dmart_order_date_users": "join_id", "customer_orders_sku_level": "join_customer_id", "monthly_user_info": "join_user_id"}
    return {name: src[name].where(F.col(key).isNotNull()) for name, key in keys.items()}


def large_users(src: dict[str, DataFrame], cfg: RunConfig) -> set[str]:
    """The sources in which a user (or no user) has so many rows that windows over a user must be split: more than
    ``cfg.slice_rows`` in the two that are windowed as they are, more than its root in the two whose rows of a month
    multiply in C10.  One narrow aggregate over all of them."""
    keys = {"first_dmart_order_date_users": "join_id", "monthly_user_info": "join_user_id",
            "dmart_purchase_missions": "join_user_id", "dmart_behavioural_clustering": "join_user_id"}
    if not cfg.slice_rows:
        return set()
    rows = None
    # by number and hash: users who share a hash are counted together, which can only split windows that needn't be
    for i, (name, key) in enumerate(keys.items()):
        if name in src:
            own = src[name].select(F.lit(i).alias("source"), F.xxhash64(key).alias("user"),
                                   F.lit(cfg.slice_rows if name.startswith("dmart_") else math.isqrt(cfg.slice_rows)).alias("most"))
            rows = own if rows is None else rows.unionByName(own)
    counted = rows.groupBy("source", "user", "most").count().where("count > most")
    return {list(keys)[r.source] for r in counted.select("source").distinct().collect()}


SPINE_SOURCES = {"first_dmart_order_date_users", "monthly_user_info"}


def spine_rows(src: dict[str, DataFrame], cfg: RunConfig, floor: dt.date | None = None, info: bool = True,
               only_users: DataFrame | None = None, runs: bool = False, cut=None) -> DataFrame:
    """C1-C4 and C10, with L6 if ``info``; ``runs`` as in ``dmart_data``.  ``cut`` writes the lifecycle rows, which three steps read."""
    mine = lambda df, key="join_user_id": df if only_users is None else df.join(
        only_users.select(F.col("join_user_id").alias("__only")), F.col(key) == F.col("__only"), "left_semi")
    s1 = mine(src["first_dmart_order_date_users"].select("join_id", "join_month", "type", "mes_en_curso", *DATES), "join_id")
    if cut is not None:
        s1 = cut(s1, "lifecycle")
    ugd = user_global_dates(s1)
    more = []
    if info:
        s3 = mine(src["monthly_user_info"])
        more = [monthly_info_join(s3 if floor is None else s3.where(F.col("join_month") >= F.lit(floor)))]
    lines = src["customer_orders_sku_level"]
    umo = user_monthly_orders(mine(lines, "join_customer_id"), cfg.category_codes, lines)
    return dmart_data(user_intervals(ugd, cfg, floor), ugd, active_months(user_monthly_status(s1, floor), umo, more), runs)


def user_metrics(src: dict[str, DataFrame], cfg: RunConfig, floor: dt.date | None = None, only_users: DataFrame | None = None,
                 large: set[str] | None = None, cut=cut_lineage) -> DataFrame:
    """C11 end to end.  ``large``: what ``large_users`` found, if the caller has asked already."""
    if SPINE_SOURCES & (large_users({n: src[n] for n in SPINE_SOURCES}, cfg) if large is None else large):
        return user_data(cut(spine_rows(src, cfg, floor, True, only_users), "spine"), cfg.slice_rows, cut)
    rows = spine_rows(src, cfg, floor, True, only_users, runs=True, cut=None if only_users is None else cut)
    return user_data(rows, read=only_users if only_users is not None and MONTHS_READ in only_users.columns else None)


def user_months(src: dict[str, DataFrame], cfg: RunConfig, floor: dt.date | None = None,
                only_users: DataFrame | None = None, large: set[str] | None = None, cut=cut_lineage) -> DataFrame:
    """C1-C4, C10-C13 end to end.

    ``only_users`` (a ``join_user_id`` column) restricts every input to those users before the spine
    is generated: every window here is per user, so dropping whole users changes nothing
    for the others, and the mart reads the spine only for users of its orders.  If it has their ``months_read``, too,
    the windows see all months and the other ones are left out after them."""
    return prep_united_users(united_users(user_metrics(src, cfg, floor, only_users, large, cut)))
