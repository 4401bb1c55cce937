"""Request-rate panels over an event table or over counter samples.

Input events are `(ts, handler, status, duration)`. All functions that only group by
window and handler also run on streams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.numeric import rounded
from tidemart.operators.ordered import HOT_ROWS, previous_values

# The panels' range and the sampling interval.
RANGE = "1 minute"
RANGE_SECONDS = 60
SCRAPE_INTERVAL = "15 seconds"


def _by_window(df: DataFrame, ts: str, slide: str | None, *aggs: Column) -> DataFrame:
    window = F.window(ts, RANGE, slide) if slide else F.window(ts, RANGE)
    grouped = df.groupBy(window, "handler").agg(*aggs)
    return grouped.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        *[c for c in grouped.columns if c != "window"],
    )


def request_rate(requests: DataFrame, ts: str = "ts", slide: str | None = None) -> DataFrame:
    """Requests per second by handler and one-minute window, tumbling or sliding."""
    counted = _by_window(requests, ts, slide, F.count(F.lit(1)).alias("requests"))
    return counted.withColumn("per_second", rounded(F.col("requests") / RANGE_SECONDS, 6))


def mean_duration(requests: DataFrame, ts: str = "ts", slide: str | None = None) -> DataFrame:
    """Mean request duration by handler and window."""
    summed = _by_window(
        requests, ts, slide,
        F.sum("duration").alias("seconds"), F.count("duration").alias("requests"),
    )
    mean = rounded(F.try_divide("seconds", "requests"), 6)
    return summed.withColumn("mean_duration", mean).drop("seconds")


def error_rate(
    requests: DataFrame, status_class: int, ts: str = "ts", slide: str | None = None
) -> DataFrame:
    """Request rate of one status class, e.g. 5 for all of 500..599."""
    chosen = requests.filter(F.col("status").rlike(f"^{status_class}..$"))
    return request_rate(chosen, ts, slide)


def counter_increase(
    samples: DataFrame, series: list[str], ts: str = "ts", value: str = "value",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Increase since the series' preceding sample; null on the first one.

    A drop means the counter restarted, so the new value is the whole increase. Sample
    times must be unique within a series.
    """
    lagged = previous_values(samples, series, ts, {"previous": value}, hot_rows=hot_rows)
    now, before = F.col(value), F.col("previous")
    increase = F.when(now < before, now).otherwise(now - before)
    return lagged.withColumn("increase", increase).drop("previous")


def counter_rate(
    samples: DataFrame, series: list[str], ts: str = "ts", value: str = "value",
    slide: str | None = None, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Per-second increase summed by handler and window."""
    increases = counter_increase(samples, series, ts, value, hot_rows)
    summed = _by_window(increases, ts, slide, F.sum("increase").alias("increase"))
    return summed.withColumn("per_second", rounded(F.col("increase") / RANGE_SECONDS, 6))
