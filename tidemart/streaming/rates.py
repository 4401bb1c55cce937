"""Request panels on a stream: the batch functions over watermarked rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemart.operators import monitoring
from tidemart.streaming.ingest import with_event_time


def request_rate(
    requests: DataFrame, delay: str, ts: str = "ts", slide: str | None = None
) -> DataFrame:
    """In append mode a window is emitted once the watermark has passed its end."""
    return monitoring.request_rate(with_event_time(requests, ts, delay), ts, slide)


def mean_duration(
    requests: DataFrame, delay: str, ts: str = "ts", slide: str | None = None
) -> DataFrame:
    return monitoring.mean_duration(with_event_time(requests, ts, delay), ts, slide)


def error_rate(
    requests: DataFrame, status_class: int, delay: str, ts: str = "ts",
    slide: str | None = None,
) -> DataFrame:
    return monitoring.error_rate(with_event_time(requests, ts, delay), status_class, ts, slide)
