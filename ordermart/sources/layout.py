"""Sources laid out by order key: written once in buckets of the key, joined in every run without an exchange.

The nine order-keyed right sides (L8, L9, L13-L15, L17, L20, L21, L23) are normalised (``load_all``) and written as tables
bucketed and sorted by ``join_order_id``.  Buckets are numbered by the hash that Spark deals rows with, so order rows dealt
into as many partitions by the key (``RunConfig.order_buckets``) meet them where they lie: only the order rows
are shuffled.  The per-order roll-ups of payments and complaints need no exchange either.  Tables hold what the sources hold, repeated rows and
NULL keys included.  A job that refreshes a source lays it out anew, as a whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

KEY = "join_order_id"
ORDER_KEYED = ("fact_orders", "fact_talon_coupons", "fact_payments_transaction", "dim_coupon_crm_attributes", "dps_order_info",
               "df090_dma_discounts_bines", "orders_pe", "fact_groceries_shopping_missions", "dmarts_customer_compliant")


def lay_out(src: dict[str, DataFrame], prefix: str, buckets: int, location: str | None = None) -> None:
    """Write the order-keyed sources as tables ``<prefix><source>`` of the session's catalog; ``location``: a folder
    that all executors share, if not the catalog's own.  The rows are dealt by key first, so that a bucket is one file."""
    if buckets < 1:
        raise ValueError("order-keyed sources need at least one bucket")
    for name in ORDER_KEYED:
        if name not in src:
            continue
        rows = src[name].repartition(buckets, KEY).write.bucketBy(buckets, KEY).sortBy(KEY).mode("overwrite").format("parquet")
        (rows.option("path", f"{location}/{name}") if location else rows).saveAsTable(prefix + name)


def laid_out(spark: SparkSession, src: dict[str, DataFrame], prefix: str) -> dict[str, DataFrame]:
    """The sources, with the order-keyed ones read from their tables; a table that lacks a column is refused."""
    out = dict(src)
    for name in ORDER_KEYED:
        if name in src:
            table = spark.table(prefix + name)
            missing = [c for c in src[name].columns if c not in table.columns]
            if missing:
                raise ValueError(f"{prefix}{name} was laid out without {', '.join(missing)}")
            out[name] = table.select(*src[name].columns)
    return out


def drop_layout(spark: SparkSession, prefix: str) -> None:
    for name in ORDER_KEYED:
        spark.sql(f"DROP TABLE IF EXISTS {prefix}{name}")
