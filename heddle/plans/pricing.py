"""Pricing summary over line items: one scan, one filter pushed to Parquet, one partial-then-final aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heddle.sources import read_table

CUTOFF = "1998-09-02"


def pricing_summary(spark: SparkSession, sf_dir: str, cutoff: str = CUTOFF) -> DataFrame:
    """Totals by return flag and line status of the lines shipped up to ``cutoff``. Null keys form a group of their own."""
    price = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return (
        read_table(spark, sf_dir, "lineitem")
        .where(F.col("l_shipdate") <= F.lit(cutoff).cast("timestamp_ntz"))
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.round(F.sum("l_quantity"), 2).alias("sum_qty"),
            F.round(F.sum(price), 2).alias("sum_disc_price"),
            F.count(F.lit(1)).alias("n_lines"),
        )
    )


PRICING_SUMMARY_SQL = f"""
SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty,
       round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price, count(*) AS n_lines
FROM lineitem WHERE l_shipdate <= TIMESTAMP '{CUTOFF}'
GROUP BY l_returnflag, l_linestatus
"""
