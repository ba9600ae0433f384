"""Batch job: build the order mart for one run date and publish it.

    spark-submit -m ordermart --tables tables.json --target db.order_mart [--as-of 2024-06-15]
                 [--mode append|append_once|replace_month] [--create] [--fan-out FILE]

``tables.json`` maps each of the 21 input roles (``ordermart.sources.spec.ROLES``) to a
catalog table name.  Without ``--as-of`` the run date is today (UTC), as the scheduled
script does.
"""

from __future__ import annotations

import argparse
import contextlib
import datetime as dt
import json

from pyspark.sql import SparkSession


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="ordermart")
    p.add_argument("--tables", required=True, help="JSON file: role name -> catalog table")
    p.add_argument("--target", required=True, help="table to append the mart to")
    p.add_argument("--as-of", type=dt.date.fromisoformat, default=None)
    p.add_argument("--mode", choices=["append", "append_once", "replace_month"], default="append",
                   help="append_once: a run date that was published before, or was cut off, is not appended twice")
    p.add_argument("--fan-out", default=None, help="JSON file for the number of rows that repeat a key, per right side")
    p.add_argument("--shuffle-partitions", type=int, default=None,
                   help="about the input's bytes / 128 MB; AQE merges small ones but does not multiply")
    p.add_argument("--create", action="store_true", help="create the target (month-partitioned Parquet) first")
    args = p.parse_args(argv)

    from ordermart.config import RunConfig
    from ordermart.operators.joins import fan_out_report
    from ordermart.plans.mart import check_target, create_target, mart_schema, order_mart, publish, publish_once
    from ordermart.session import apply_defaults, drop_scratch, shared_dir
    from ordermart.sources.spec import ROLES, load_all, roles_from_catalog

    spark = apply_defaults(SparkSession.builder.appName("ordermart").getOrCreate(), args.shuffle_partitions)
    with open(args.tables) as f:
        names = json.load(f)
    missing = sorted(set(ROLES) - set(names))
    if missing:
        raise SystemExit(f"no table given for roles: {', '.join(missing)}")
    shared_dir(spark)
    cfg = RunConfig(as_of=args.as_of or dt.datetime.now(dt.timezone.utc).date())
    src = load_all(roles_from_catalog(spark, names), cfg)
    schema = mart_schema(src, cfg)
    if args.create:
        create_target(schema, args.target, spark)
    once = args.mode == "append_once"
    check_target(spark, args.target, schema, "append" if once else args.mode)  # before any work
    try:
        with fan_out_report() if args.fan_out else contextlib.nullcontext() as report:
            mart = order_mart(src, cfg)
        if once:
            publish_once(mart, args.target, f"period-{cfg.period_start}-as-of-{cfg.as_of}")
        else:
            publish(mart, args.target, mode=args.mode)
        if report is not None:
            with open(args.fan_out, "w") as f:
                json.dump([{"join": n, "right_rows": r, "repeated_rows": x} for n, r, x in report.rows()], f, indent=1)
    finally:
        drop_scratch(spark)


if __name__ == "__main__":
    main()
