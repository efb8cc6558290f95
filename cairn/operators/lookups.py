"""Joins with a lookup table that hold when one key owns a third of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 1000


def hot_keys(rows: DataFrame, on: Sequence[str], most: int = HOT_KEYS) -> DataFrame:
    """Keys that hold more than one row in ``most`` of all rows (NULL keys left out): fewer than
    ``most`` rows by construction, so the result may be broadcast."""
    counts = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.select(F.sum("_n")).scalar()
    known = _no_nulls(on)
    return counts.where(known & (F.col("_n") * most > total)).select(*on)


def _no_nulls(on: Sequence[str]):
    known = F.lit(True)
    for k in on:
        known = known & F.col(k).isNotNull()
    return known


def lookup_join(rows: DataFrame, lookup: DataFrame, on: Sequence[str], most: int = HOT_KEYS) -> DataFrame:
    """LEFT JOIN of ``rows`` with ``lookup`` (one row per key) on ``on``; NULL keys match nothing.

    Keys are counted in the plan itself. The lookup rows of hot keys, fewer than ``most``, are
    broadcast; rows of all other keys are shuffled, and each of those keys has at most one row in
    ``most``. Rows without a key take neither way. ``rows`` is read three times: pass a table.
    """
    hot = hot_keys(rows, on, most).join(lookup, list(on), "left").withColumn("_hot", F.lit(True))
    tagged = rows.join(F.broadcast(hot), list(on), "left")
    settled = F.col("_hot").isNotNull() | ~_no_nulls(on)
    values = [c for c in lookup.columns if c not in on]
    done = tagged.where(settled).select(*rows.columns, *values)
    rest = tagged.where(~settled).select(*rows.columns).join(lookup, list(on), "left")
    return done.unionByName(rest.select(*rows.columns, *values))
