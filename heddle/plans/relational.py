"""Relational queries over the driver's tables, each with its SQL twin.

They exercise joins, windows, sets, grouping sets, sessions and scalars on the
tables at hand; none of them comes from elsewhere. Double sums are rounded on
both sides, as their order is free.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from heddle.functions import trunc_ntz
from heddle.operators import asof_join, interval_join, latest, sessions, top_k
from heddle.sources import read_table
from heddle.streaming import windowed_counts

DAY = "yyyy-MM-dd"
SECOND = "yyyy-MM-dd HH:mm:ss"


def nation_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue by the region and nation of customers and suppliers of one nation. The lines are summed by order and supplier first, so the joins see fewer rows."""
    lines = read_table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_suppkey").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"))
    found = (
        lines.join(read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"), (F.col("l_suppkey") == F.col("s_suppkey")) & (F.col("c_nationkey") == F.col("s_nationkey")))
        .groupBy("c_nationkey")
        .agg(F.sum("revenue").alias("revenue"))
    )
    nation, region = read_table(spark, sf_dir, "nation"), read_table(spark, sf_dir, "region")
    named = found.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return named.select("r_name", "n_name", F.round("revenue", 2).alias("revenue"))


NATION_REVENUE_SQL = """
SELECT r_name, n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN supplier ON l_suppkey = s_suppkey AND c_nationkey = s_nationkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY r_name, n_name
"""


def largest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's three largest orders."""
    orders = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return top_k(orders, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3, "place")


LARGEST_ORDERS_SQL = """
SELECT o_custkey, o_orderkey, o_totalprice, place FROM (
  SELECT o_custkey, o_orderkey, o_totalprice, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS INT) AS place FROM orders)
WHERE place <= 3
"""


def orders_without_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by status, of those that no line belongs to (anti-join)."""
    orders, lines = read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "lineitem")
    alone = orders.join(lines.select("l_orderkey"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti")
    return alone.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_order"))


ORDERS_WITHOUT_LINES_SQL = """
SELECT o_orderstatus, count(*) AS n, min(o_orderkey) AS first_order FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) GROUP BY o_orderstatus
"""


def orders_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by segment with the number of their orders, those without any too (outer join)."""
    orders = read_table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    customers = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    joined = customers.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return joined.groupBy("c_mktsegment").agg(F.sum("n").alias("n_orders"), F.max("n").alias("most"), F.count_if(F.col("n") == 0).alias("without"))


ORDERS_BY_SEGMENT_SQL = """
SELECT c_mktsegment, CAST(sum(n) AS BIGINT) AS n_orders, max(n) AS most, count(*) FILTER (n = 0) AS without
FROM (SELECT c_custkey, c_mktsegment, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL)
GROUP BY c_mktsegment
"""


def status_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines by return flag and status, all grouping sets of the two."""
    lines = read_table(spark, sf_dir, "lineitem")
    return lines.cube("l_returnflag", "l_linestatus").agg(F.grouping_id().cast("int").alias("level"), F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


STATUS_CUBE_SQL = """
SELECT l_returnflag, l_linestatus, CAST(grouping(l_returnflag, l_linestatus) AS INT) AS level, count(*) AS n, round(sum(l_quantity), 2) AS quantity
FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)
"""


def event_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of each type by day, a column for each type (the types are given, so that no job looks for them)."""
    events = read_table(spark, sf_dir, "events").select(F.date_format("ts", DAY).alias("day"), "event_type")
    return events.groupBy("day").pivot("event_type", ["click", "error", "purchase", "signup", "view"]).count().na.fill(0)


EVENT_PIVOT_SQL = """
SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) FILTER (event_type = 'click') AS click, count(*) FILTER (event_type = 'error') AS error,
       count(*) FILTER (event_type = 'purchase') AS purchase, count(*) FILTER (event_type = 'signup') AS signup, count(*) FILTER (event_type = 'view') AS view
FROM events GROUP BY 1
"""


def event_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's sessions of events, six hours apart."""
    found = sessions(read_table(spark, sf_dir, "events").select("user_id", "ts"), "user_id", "ts", "6 hours")
    return found.select("user_id", *[F.date_format(c, SECOND).alias(c) for c in ("started", "ended")], "n")


EVENT_SESSIONS_SQL = """
WITH cut AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER u <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM events WHERE ts IS NOT NULL WINDOW u AS (PARTITION BY user_id ORDER BY ts)),
named AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM cut)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS started, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS ended, count(*) AS n
FROM named GROUP BY user_id, session
"""


def purchases_after_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each purchase with the value of its user's last click at or before it (as-of join)."""
    events = read_table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "value")
    clicks = events.where("event_type = 'click'").select("user_id", F.col("ts").alias("click_ts"), F.col("value").alias("click_value"))
    bought = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts", "value")
    return asof_join(bought, clicks, ["user_id"], "ts", "click_ts", ["click_value"]).drop("ts")


PURCHASES_AFTER_CLICKS_SQL = """
WITH clicks AS (SELECT user_id, ts, max(value) AS click_value FROM events WHERE event_type = 'click' GROUP BY user_id, ts)
SELECT event_id, e.user_id, value, click_value
FROM (SELECT * FROM events WHERE event_type = 'purchase') e ASOF LEFT JOIN clicks c ON e.user_id = c.user_id AND e.ts >= c.ts
"""


def events_after_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of any user in the ten minutes from each error on (interval join)."""
    events = read_table(spark, sf_dir, "events")
    second = F.unix_date(F.col("ts").cast("date")).cast("long") * 86_400 + F.hour("ts") * 3_600 + F.minute("ts") * 60 + F.second("ts")
    errors = events.where("event_type = 'error'").select(F.col("event_id").alias("error_id"), second.alias("begin"))
    points = events.where("event_type <> 'error'").select("event_id", second.alias("second"))
    pairs = interval_join(points, errors, F.col("second"), F.col("begin"), F.col("begin") + 600, 600)
    return pairs.groupBy("error_id").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("second") - F.col("begin")).alias("last_after"))


EVENTS_AFTER_ERRORS_SQL = """
WITH e AS (SELECT event_id, event_type, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS second FROM events)
SELECT a.event_id AS error_id, count(*) AS n, max(b.second - a.second) AS last_after
FROM e a JOIN e b ON a.event_type = 'error' AND b.event_type <> 'error' AND b.second >= a.second AND b.second < a.second + 600
GROUP BY a.event_id
"""


def running_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's running count, previous value and greatest of the last three values (window frames)."""
    events = read_table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    user = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return events.select(
        "event_id",
        F.row_number().over(user).cast("long").alias("n"),
        F.lag("value").over(user).alias("before"),
        F.max("value").over(user.rowsBetween(-2, 0)).alias("greatest"),
        F.first("event_id").over(user).alias("first_event"),
    )


RUNNING_VALUES_SQL = """
SELECT event_id, row_number() OVER u AS n, lag(value) OVER u AS before, max(value) OVER (u ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS greatest,
       first_value(event_id) OVER u AS first_event
FROM events WINDOW u AS (PARTITION BY user_id ORDER BY ts, event_id)
"""


def event_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by a field of their JSON text."""
    k = F.get_json_object("props", "$.k").cast("int")
    return read_table(spark, sf_dir, "events").groupBy((k % 10).alias("k")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("users"), F.max(k).alias("most"))


EVENT_PROPS_SQL = """
SELECT k % 10 AS k, count(*) AS n, count(DISTINCT user_id) AS users, max(k) AS most
FROM (SELECT user_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events) GROUP BY 1
"""


def nation_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations with rich customers, rich suppliers, both or the former alone (set operations)."""
    of = lambda table, c: read_table(spark, sf_dir, table).where(f"{c}_acctbal > 9000").select(F.col(f"{c}_nationkey").alias("nation"))
    c, s = of("customer", "c"), of("supplier", "s")
    sets = {"both": c.intersect(s), "customers alone": c.subtract(s), "either": c.union(s).distinct()}
    out = None
    for name, rows in sets.items():
        rows = rows.select(F.lit(name).alias("kind"), "nation")
        out = rows if out is None else out.unionByName(rows)
    return out


NATION_SETS_SQL = """
WITH c AS (SELECT c_nationkey AS nation FROM customer WHERE c_acctbal > 9000), s AS (SELECT s_nationkey AS nation FROM supplier WHERE s_acctbal > 9000)
SELECT 'both' AS kind, nation FROM (SELECT * FROM c INTERSECT SELECT * FROM s)
UNION ALL SELECT 'customers alone', nation FROM (SELECT * FROM c EXCEPT SELECT * FROM s)
UNION ALL SELECT 'either', nation FROM (SELECT * FROM c UNION SELECT * FROM s)
"""


def brand_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median, spread and kinds of each brand's prices."""
    price = F.col("p_retailprice")
    found = read_table(spark, sf_dir, "part").groupBy("p_brand").agg(
        F.round(F.percentile(price, F.lit(0.5)), 4).alias("median"),
        F.round(F.stddev_samp(price), 4).alias("spread"),
        F.countDistinct("p_type").alias("types"),
        F.array_join(F.slice(F.array_sort(F.collect_set(F.col("p_size").cast("string"))), 1, 5), ",").alias("sizes"),
    )
    return found


BRAND_PRICES_SQL = """
SELECT p_brand, round(quantile_cont(p_retailprice, 0.5), 4) AS median, round(stddev_samp(p_retailprice), 4) AS spread, count(DISTINCT p_type) AS types,
       array_to_string(list_sort(list(DISTINCT CAST(p_size AS VARCHAR)))[1:5], ',') AS sizes
FROM part GROUP BY p_brand
"""


def last_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's last order (by date, then key)."""
    orders = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority")
    return latest(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).withColumn("o_orderdate", F.date_format("o_orderdate", DAY))


LAST_ORDERS_SQL = """
SELECT o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderkey, o_orderpriority FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
"""


def monthly_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by month, with the share of the year's and the months so far (zone-free dates)."""
    month = trunc_ntz("month", F.col("o_orderdate")).alias("month")
    by_month = read_table(spark, sf_dir, "orders").groupBy(month).agg(F.count(F.lit(1)).alias("n"))
    year = Window.partitionBy(F.year("month"))
    share = F.round(F.col("n") / F.sum("n").over(year), 6).alias("share")
    return by_month.select(F.date_format("month", "yyyy-MM").alias("month"), "n", share, F.rank().over(year.orderBy(F.desc("n"))).cast("long").alias("place"))


MONTHLY_ORDERS_SQL = """
SELECT strftime(month, '%Y-%m') AS month, n, round(n / sum(n) OVER (PARTITION BY year(month)), 6) AS share, rank() OVER (PARTITION BY year(month) ORDER BY n DESC) AS place
FROM (SELECT date_trunc('month', o_orderdate) AS month, count(*) AS n FROM orders GROUP BY 1)
"""


def frequent_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 most frequent words of all texts by language (strings, arrays, top-k)."""
    words = read_table(spark, sf_dir, "documents").select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("word"))
    return top_k(words.groupBy("lang", "word").count().withColumnRenamed("count", "n"), ["lang"], [F.desc("n"), F.asc("word")], 50, "place")


FREQUENT_WORDS_SQL = """
SELECT lang, word, n, CAST(place AS INT) AS place FROM (
  SELECT lang, word, count(*) AS n, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, word) AS place
  FROM (SELECT lang, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents) GROUP BY lang, word)
WHERE place <= 50
"""


def vector_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length, norm and greatest component of the vectors, by label (higher-order functions)."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    rows = read_table(spark, sf_dir, "embeddings").select("label", F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)).alias("norm"), F.size(v).alias("dim"), F.array_max(v).alias("most"))
    return rows.groupBy("label").agg(F.max("dim").alias("dim"), F.round(F.avg("norm"), 6).alias("norm"), F.round(F.max("most"), 6).alias("most"))


VECTOR_NORMS_SQL = """
SELECT label, CAST(max(len(v)) AS INT) AS dim, round(avg(sqrt(list_inner_product(v, v))), 6) AS norm, round(max(list_max(v)), 6) AS most
FROM (SELECT label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings) GROUP BY label
"""


def hourly_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of each type by six hours, as the stream of them counts them."""
    counted = windowed_counts(read_table(spark, sf_dir, "events"), "ts", ["event_type"], "6 hours", "1 hour")
    return counted.withColumn("window_start", F.date_format("window_start", SECOND))


HOURLY_EVENTS_SQL = """
SELECT strftime(time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01'), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n FROM events WHERE ts IS NOT NULL GROUP BY 1, 2
"""

QUERIES = {
    f.__name__: f
    for f in (nation_revenue, largest_orders, orders_without_lines, orders_by_segment, status_cube, event_pivot, event_sessions, purchases_after_clicks, events_after_errors)
    + (running_values, event_props, nation_sets, brand_prices, last_orders, monthly_orders, frequent_words, vector_norms, hourly_events)
}
ORACLE_SQL = {name: globals()[f"{name.upper()}_SQL"] for name in QUERIES}
