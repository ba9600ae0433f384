"""The batch entry point runs end to end against catalog tables."""

import json
import os
import tempfile

from mart_paths import SF_SMALL
from ordermart import config as C
from ordermart.__main__ import main
from ordermart.pipeline import TEST_CONFIG
from ordermart.sources.adapters import build_roles, read_tables


def test_job_publishes_the_mart(spark):
    roles = build_roles(read_tables(spark, SF_SMALL))
    names = {}
    for role, df in roles.items():
        df.createOrReplaceTempView(f"role_{role}")
        names[role] = f"role_{role}"
    d = tempfile.mkdtemp(prefix="ordermart-job-")
    tables = os.path.join(d, "tables.json")
    with open(tables, "w") as f:
        json.dump(names, f)
    spark.sql("DROP TABLE IF EXISTS job_target")
    main(["--tables", tables, "--target", "job_target", "--as-of", TEST_CONFIG.as_of.isoformat(), "--create",
          "--mode", "replace_month"])
    out = spark.table("job_target")
    assert sorted(out.columns) == sorted(C.OUTPUT_COLUMNS)
    assert out.count() > 0
    spark.sql("DROP TABLE job_target")
