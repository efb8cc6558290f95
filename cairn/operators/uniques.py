"""Distinct users that can be added up: bitmaps (exact) and sketches (approximate) per day.

Daily distinct counts do not add up to a week's, as users come back. Kept instead per key and day is
a structure that merges: a bitmap of user ids in blocks of 32,768 ids, or a HyperLogLog sketch. Any
span is then the OR (or union) of its days, without reading events again, and a new day only adds
its own rows. Both are built-in aggregates with map-side partials, so a busy key is combined where
its rows lie.

Ids are integers, NULL ids do not count. A bitmap block takes 4 KB however few of its ids occur,
so sparse ids (hashes) belong in the sketch, or are numbered first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# HyperLogLog with 2^12 slots: relative standard error 1.04 / sqrt(4096) = 1.6 %.
SKETCH_LOG_SLOTS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_LOG_SLOTS / 2)


def daily_bitmaps(events: DataFrame, keys: Sequence[str], user: str, ts: str) -> DataFrame:
    """keys, day, block, users (bitmap): one row per block of ids seen that day."""
    known = events.where(F.col(user).isNotNull())
    return (known.groupBy(*keys, F.to_date(ts).alias("day"), F.bitmap_bucket_number(user).alias("block"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(user)).alias("users")))


def distinct_in(days: DataFrame, keys: Sequence[str], out: str = "unique_users") -> DataFrame:
    """Distinct users per ``keys`` of rows with ``block`` and ``users``: OR per block, then the bits."""
    merged = days.groupBy(*keys, "block").agg(F.bitmap_or_agg("users").alias("users"))
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count("users")).cast("bigint").alias(out))


def spans(days: DataFrame, rolling: int = 7) -> DataFrame:
    """Every daily row once per span it belongs to: span (day, week, month, rolling_<n>), span_start.

    A rolling span holds ``rolling`` days and starts on any day from which its days are all on or
    before the last day there is.
    """
    last, name = days.select(F.max("day")).scalar(), f"rolling_{rolling}"
    windows = F.transform(F.sequence(F.date_sub("day", rolling - 1), F.col("day")),
                          lambda d: F.struct(F.lit(name).alias("span"), d.alias("span_start")))
    fixed = F.array(*[F.struct(F.lit(span).alias("span"), start.cast("date").alias("span_start")) for span, start in (
        ("day", F.col("day")), ("week", F.trunc("day", "week")), ("month", F.trunc("day", "month")))])
    every = days.select("*", F.explode(F.concat(fixed, windows)).alias("_s")).select(*days.columns, "_s.*")
    return every.where((F.col("span") != name) | (F.col("span_start") <= F.date_sub(last, rolling - 1)))


def distinct_by_span(bitmaps: DataFrame, keys: Sequence[str], rolling: int = 7) -> DataFrame:
    """keys, span, span_start, unique_users for every day, week, month and rolling window."""
    return distinct_in(spans(bitmaps, rolling), [*keys, "span", "span_start"])


def daily_sketches(events: DataFrame, keys: Sequence[str], user: str, ts: str, log_slots: int = SKETCH_LOG_SLOTS) -> DataFrame:
    """keys, day, sketch: a HyperLogLog sketch of the day's users."""
    known = events.where(F.col(user).isNotNull())
    return known.groupBy(*keys, F.to_date(ts).alias("day")).agg(F.hll_sketch_agg(user, F.lit(log_slots)).alias("sketch"))


def estimated_in(days: DataFrame, keys: Sequence[str], out: str = "estimated_users") -> DataFrame:
    """Estimated distinct users per ``keys`` from daily sketches."""
    return days.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(out))


def within_bound(estimate: Column, exact: Column, sigmas: float = 4.0) -> Column:
    """Whether an estimate lies within ``sigmas`` standard errors of the exact count (and 1)."""
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), exact * (sigmas * SKETCH_ERROR))
