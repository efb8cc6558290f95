"""Event-time aggregation: tumbling windows and session windows with watermarks.

The same functions run on batch and streaming DataFrames. A watermark bounds
the state kept per window: a row older than the watermark does not reopen a
closed window (late data is dropped, as in the original jobs).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def event_time(df: DataFrame, col: str = "event_time", out: str = "event_timestamp") -> DataFrame:
    """A TIMESTAMP event-time column (watermarks reject TIMESTAMP_NTZ)."""
    return df.withColumn(out, F.col(col).cast("timestamp"))


def tumbling_counts(df: DataFrame, keys: Sequence[str], *, ts: str = "event_timestamp", size: str = "5 minutes",
                    watermark: str | None = "15 seconds", count_col: str = "host", out: str = "num_hits",
                    start: str = "event_hour") -> DataFrame:
    """``count(count_col)`` per tumbling window and keys; ``start`` is the window start
    (named event_hour after the original sink although it holds a 5-minute start)."""
    if watermark and df.isStreaming:
        df = df.withWatermark(ts, watermark)
    g = df.groupBy(F.window(ts, size).alias("_w"), *keys).agg(F.count(count_col).alias(out))
    return g.select(F.col("_w.start").alias(start), *keys, out)


def sessions(df: DataFrame, keys: Sequence[str], *, ts: str = "event_timestamp", gap: str = "5 minutes",
             watermark: str | None = None) -> DataFrame:
    """Sessions per keys: events at most ``gap`` apart belong to one session (a gap of
    exactly ``gap`` does not split).

    Grouped by the ``session_window`` column itself (grouping by its start would
    skip the session merge)."""
    if watermark and df.isStreaming:
        df = df.withWatermark(ts, watermark)
    g = df.groupBy(F.session_window(ts, gap).alias("_s"), *keys).agg(F.count(F.lit(1)).alias("num_events"))
    return g.select(*keys, F.col("_s.start").alias("session_start"), F.col("_s.end").alias("session_end"),
                    "num_events")


def session_stats(sessions_df: DataFrame, by: str = "host") -> DataFrame:
    """Mean events per session, per ``by`` value."""
    return sessions_df.groupBy(by).agg(F.count(F.lit(1)).alias("n_sessions"),
                                       F.sum("num_events").cast("bigint").alias("n_events"),
                                       F.avg("num_events").alias("avg_events_per_session"))
