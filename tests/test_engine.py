import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from heddle.functions import local_to_instant, trunc_ntz
from heddle.session import get_session, run_logged
from heddle.sources import SCHEMAS, read_table
from heddle.streaming import windowed_counts

SF = "/root/testdata/sf0.001"


def test_schemas_match_the_files(spark):
    for name in SCHEMAS:
        stated = read_table(spark, SF, name).dtypes
        assert stated == spark.read.parquet(f"{SF}/{name}.parquet").dtypes, name


def test_pricing_summary_matches_sql(spark):
    got = sorted(map(tuple, entry.queries()["pricing_summary"](spark, SF).collect()))
    con = duckdb.connect()
    con.sql(f"create view lineitem as select * from '{SF}/lineitem.parquet'")
    assert got == sorted(con.sql(entry.oracle_sql()["pricing_summary"]).fetchall())
    assert sorted(map(tuple, entry.entry(spark).collect())) == got


def test_filter_and_columns_reach_the_scan(spark):
    plan = entry.entry(spark)._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(l_shipdate), LessThanOrEqual(l_shipdate" in plan
    assert "l_comment" not in plan and "l_partkey" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_zone_free_functions(spark):
    row = spark.range(1).select(
        trunc_ntz("hour", F.lit("2024-01-01 05:06:07").cast("timestamp_ntz")).alias("t"),
        local_to_instant(F.lit("2012-01-10 04:00:00").cast("timestamp_ntz"), "Europe/Moscow").cast("string").alias("m"),
        trunc_ntz("hour", F.lit(None).cast("timestamp_ntz")).alias("none"),
    ).first()
    assert (row.t, row.m, row.none) == (dt.datetime(2024, 1, 1, 5), "2012-01-10 00:00:00", None)


def test_stream_counts_match_batch(spark, tmp_path):
    events = read_table(spark, SF, "events")
    events.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMAS["events"]).parquet(str(tmp_path / "in"))
    query = windowed_counts(stream, "ts", ["event_type"], "1 day", "1 hour").writeStream.outputMode("complete").format("memory").queryName("counted").start()
    query.processAllAvailable()
    query.stop()
    batch = windowed_counts(events, "ts", ["event_type"], "1 day", "1 hour")
    assert sorted(map(tuple, spark.table("counted").collect())) == sorted(map(tuple, batch.collect()))


def test_session_and_logging(spark, caplog):
    assert get_session().conf.get("spark.sql.session.timeZone") == "UTC"
    with pytest.raises(ZeroDivisionError):
        run_logged("q", lambda: 1 / 0)
    assert "query q failed" in caplog.text
