"""The SQL of the operators' queries against the queries, on the smallest tables."""

import duckdb
import pytest
from llm_fixtures import same

from ordermart.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = con.execute(f"SELECT {', '.join(cols)} FROM ({ORACLE[name]})").fetchall()
    same([tuple(r) for r in df.select(*cols).collect()], got)
