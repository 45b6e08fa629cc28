"""Operators on the order of rows within a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group in a total ``order``, numbered from 1 in ``rank``.

    The filter on the row number becomes a limit within each map task, so at
    most k rows a task and group are shuffled.
    """
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(rank) <= k)


def latest(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row a group: that with the greatest ``order``. An aggregate with map-side combine; no group is sorted or held."""
    rest = [c for c in df.columns if c not in by and c not in order]
    row = F.max(F.struct(*order, *rest)).alias("_row")
    return df.groupBy(*by).agg(row).select(*[c if c in by else F.col(f"_row.{c}") for c in df.columns])


def sessions(events: DataFrame, user: str, at: str, gap: str) -> DataFrame:
    """(user, started, ended, n): runs of a user's events at most ``gap`` apart; ended is the last event's time. Null times are in none."""
    window = F.session_window(at, gap).alias("w")
    found = events.where(F.col(at).isNotNull()).groupBy(user, window).agg(F.max(at).alias("ended"), F.count(F.lit(1)).alias("n"))
    return found.select(user, F.col("w.start").alias("started"), "ended", "n")
