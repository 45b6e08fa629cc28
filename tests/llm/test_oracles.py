import duckdb
import pytest

from heddle.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", registry.ORACLE_SQL)
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        con.sql(f"create view {table} as select * from '{SF}/{table}.parquet'")
    df, want = registry.QUERIES[name](spark, SF), con.sql(registry.ORACLE_SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    got = df.select(*columns).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want.select(*columns).fetchall())) and got
