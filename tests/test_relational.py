import datetime as dt
import os
import shutil
import subprocess
import sys

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from heddle.functions import local_to_instant, micros_ntz, ntz_of_micros, trunc_ntz
from heddle.operators import asof_join, interval_join, latest, salted_join, sessions, top_k
from heddle.plans import relational
from heddle.sources import SCHEMAS
from heddle.streaming import windowed_counts

SF = "/root/testdata/sf0.001"
REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in SCHEMAS:
        con.sql(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", relational.QUERIES)
def test_queries_match_their_sql(spark, duck, name):
    df, want = entry.queries()[name](spark, SF), duck.sql(entry.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    got = df.select(*columns).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want.select(*columns).fetchall()))


@pytest.fixture(params=["UTC", "Europe/Moscow", "America/New_York"])
def zone(spark, request):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_functions_do_not_follow_the_session_zone(spark, zone):
    def ntz(text):
        return F.lit(text).cast("timestamp_ntz")

    row = spark.range(1).select(
        trunc_ntz("hour", ntz("2024-03-10 02:30:15.25")).cast("string").alias("gap"),
        trunc_ntz("minute", ntz("1969-12-31 23:59:59.999999")).cast("string").alias("early"),
        trunc_ntz("second", ntz("2024-03-10 02:30:15.25")).cast("string").alias("second"),
        trunc_ntz("day", ntz("2012-03-25 02:30:00")).cast("string").alias("day"),
        trunc_ntz("week", ntz("2012-03-25 02:30:00")).cast("string").alias("week"),
        trunc_ntz("quarter", ntz("2012-03-25 02:30:00")).cast("string").alias("quarter"),
        F.unix_micros(local_to_instant(ntz("2012-01-10 04:00:00"), "Europe/Moscow")).alias("moscow"),
        F.unix_micros(local_to_instant(ntz("2024-03-10 02:30:00"), "UTC")).alias("utc"),
        micros_ntz(ntz("2024-03-10 02:30:00.000001")).alias("micros"),
        micros_ntz(ntz("1969-12-31 23:59:59.999999")).alias("before"),
        ntz_of_micros(F.lit(1710037800000001)).cast("string").alias("back"),
        trunc_ntz("hour", ntz(None)).alias("null_hour"),
        local_to_instant(ntz(None), "UTC").alias("null_instant"),
    ).first()
    assert tuple(row) == (
        "2024-03-10 02:00:00", "1969-12-31 23:59:00", "2024-03-10 02:30:15", "2012-03-25 00:00:00", "2012-03-19 00:00:00", "2012-01-01 00:00:00",
        1326153600000000, 1710037800000000, 1710037800000001, -1, "2024-03-10 02:30:00.000001", None, None,
    )


def test_windowed_counts_do_not_follow_the_session_zone(spark, duck, zone):
    got = entry.queries()["hourly_events"](spark, SF).select("window_start", "event_type", "n").collect()
    assert sorted(map(tuple, got)) == sorted(duck.sql(f"select window_start, event_type, n from ({entry.oracle_sql()['hourly_events']})").fetchall())


def test_stream_in_append_mode_drops_late_rows(spark, tmp_path):
    kind = "ts timestamp_ntz, k string"
    at = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    batches = [[(at(0, 5), "a"), (at(0, 50), "a"), (at(1), "b")], [(at(5), "a")], [(at(0, 30), "late"), (at(5, 30), "b"), (None, "b")], [(at(9), "z")]]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, kind).coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    (tmp_path / "read").mkdir()
    stream = spark.readStream.schema(kind).parquet(str(tmp_path / "read"))
    query = windowed_counts(stream, "ts", ["k"], "1 hour", "1 hour").writeStream.outputMode("append").format("memory").queryName("appended").start()
    for i in range(len(batches)):  # a batch at a time, so that the watermark moves in between
        for f in (tmp_path / f"in/{i}").glob("*.parquet"):
            shutil.copy(f, tmp_path / "read" / f"{i}-{f.name}")
        query.processAllAvailable()
    query.stop()
    got = sorted(map(tuple, spark.table("appended").collect()))
    assert got == [(at(0), "a", 2), (at(1), "b", 1), (at(5), "a", 1), (at(5), "b", 1)]


def test_joins_match_brute_force(spark):
    rng = np.random.default_rng(1)
    left = [(i, None if rng.random() < 0.1 else int(rng.integers(4)), None if rng.random() < 0.1 else int(rng.integers(50))) for i in range(120)]
    right = [(None if rng.random() < 0.1 else int(rng.integers(4)), None if rng.random() < 0.1 else int(rng.integers(50)), int(rng.integers(100))) for _ in range(60)]
    a = spark.createDataFrame(left, "id int, k int, t int")
    b = spark.createDataFrame(right, "k int, at int, v int")
    want = {i: max(((at, v) for k2, at, v in right if k2 == k is not None and at is not None and t is not None and at <= t), default=(None, None))[1] for i, k, t in left}
    got = asof_join(a, b, ["k"], "t", "at", ["v"]).collect()
    assert {r.id: r.v for r in got} == want and [r.asDict().keys() for r in got][0] == {"id", "k", "t", "v"} and len(got) == len(left)
    ranges = [(n, int(x), int(x + rng.integers(-3, 40))) for n, x in enumerate(rng.integers(-20, 50, 40))] + [(99, None, 5)]
    r = spark.createDataFrame(ranges, "n int, b int, e int")
    pairs = {(i, n) for i, _, t in left for n, x, y in ranges if t is not None and x is not None and x <= t < y}
    for width in (1, 7, 1000):
        got = interval_join(a, r, F.col("t"), F.col("b"), F.col("e"), width).select("id", "n").collect()
        assert len(got) == len(pairs) and set(map(tuple, got)) == pairs
    plain, salted = a.join(b, "k"), salted_join(a, b, "k", 5)
    assert sorted(map(str, plain.collect())) == sorted(map(str, salted.select(*plain.columns).collect()))


def test_ordered_operators(spark):
    rows = [("a", 3, "x"), ("a", 5, "y"), ("b", 1, "z"), ("a", 4, None), (None, 2, "w")]
    df = spark.createDataFrame(rows, "k string, t int, v string")
    assert sorted(map(str, map(tuple, latest(df, ["k"], ["t"]).collect()))) == sorted(map(str, [("a", 5, "y"), ("b", 1, "z"), (None, 2, "w")]))
    top = top_k(df, ["k"], [F.desc("t")], 2)
    assert sorted((str(r.k), r.t, r["rank"]) for r in top.collect()) == [("None", 2, 1), ("a", 4, 2), ("a", 5, 1), ("b", 1, 1)]
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
    at = lambda m: dt.datetime(2024, 1, 1, 0, m)
    events = spark.createDataFrame([("u", at(0)), ("u", at(4)), ("u", at(10)), ("w", at(1)), ("u", None)], "u string, t timestamp_ntz")
    got = sorted(map(tuple, sessions(events, "u", "t", "5 minutes").collect()))
    assert got == [("u", at(0), at(4), 2), ("u", at(10), at(10), 1), ("w", at(1), at(1), 1)]
    for empty in (latest(df.limit(0), ["k"], ["t"]), top_k(df.limit(0), ["k"], [F.desc("t")], 2), sessions(events.limit(0), "u", "t", "5 minutes")):
        assert empty.collect() == []


@pytest.mark.parametrize("left", ["nothing", "folder", "cache"])
def test_entry_without_the_corpus_subpackage(tmp_path, left):
    shutil.copytree(REPO, tmp_path / "r", ignore=shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__"))
    if left != "nothing":
        (tmp_path / "r/heddle/llm" / ("__pycache__" if left == "cache" else "")).mkdir(parents=True)
    code = "import __spark_entry__ as e; print(len(e.queries()), set(e.queries()) == set(e.oracle_sql()), any('op' == k[:2] or k == 'pipeline' for k in e.queries()))"
    env = os.environ | {"PYTHONPATH": str(tmp_path / "r")}
    said = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path / "r", env=env, capture_output=True, text=True, timeout=100)
    assert said.stdout.split() == [str(1 + len(relational.QUERIES)), "True", "False"], said.stderr
