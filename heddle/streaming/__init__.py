"""Structured Streaming helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heddle.functions import micros_ntz, ntz_of_micros


def windowed_counts(events: DataFrame, ts: str, keys: list[str], width: str, late: str) -> DataFrame:
    """(window_start timestamp_ntz, keys, n): rows per tumbling window and key, on a stream (with watermark ``late``) and on a batch.

    Windows begin at whole multiples of ``width`` since 1970 on the clock of
    UTC; a zone-free ``ts`` is taken as that clock. Neither depends on the
    session's zone. In append mode a window comes out once, when the watermark
    has passed its end, and rows that come later still are dropped. Rows with a
    null ``ts`` fall in no window.
    """
    if dict(events.dtypes)[ts] == "timestamp_ntz":  # a watermark needs an instant
        events = events.withColumn(ts, F.timestamp_micros(micros_ntz(F.col(ts))))
    at = events.withWatermark(ts, late) if events.isStreaming else events.where(F.col(ts).isNotNull())
    counted = at.groupBy(F.window(ts, width).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(ntz_of_micros(F.unix_micros("w.start")).alias("window_start"), *keys, "n")
