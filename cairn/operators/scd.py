"""Slowly changing dimensions, type 2: backfill, incremental step, as-of replay.

Semantics (fixed against the quirks of the original SQL):
* a change is any null-safe difference of a tracked column from the previous
  observed period of the same entity; a missing period does not end a spell, in all three forms;
* spells are grouped by island id, so two separate spells of one value stay
  two rows;
* the incremental step keeps historical, unchanged, changed (old closed + new
  opened) and new records, and keeps the open record of an entity that is
  absent from today's snapshot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.operators.core import change_islands


def scd2_backfill(df: DataFrame, key: str, period: str, tracked: Sequence[str], *,
                  as_of=None, start: str = "start_season", end: str = "end_season",
                  current: str | None = "current_season", current_value=None) -> DataFrame:
    """One row per spell: key, tracked..., start, end[, current].

    ``df`` holds one row per (key, period). One shuffle on ``key``: the island
    window and the spell aggregate share its partitioning. ``current_value``
    (a literal or a scalar Column the caller already has) avoids a separate
    job for the latest period.
    """
    if as_of is not None:
        df = df.where(F.col(period) <= F.lit(as_of))
    isl = change_islands(df.select(key, period, *tracked), [key], period, tracked, "_island")
    out = (isl.groupBy(key, "_island", *tracked)
           .agg(F.min(period).alias(start), F.max(period).alias(end))
           .drop("_island"))
    if current is not None:
        if as_of is not None:
            cur = F.lit(as_of)
        elif current_value is not None:
            cur = F.lit(current_value)
        else:
            cur = df.select(F.max(period)).scalar()
        out = out.withColumn(current, cur.cast(df.schema[period].dataType))
    return out


def scd2_incremental(prev_scd: DataFrame, snapshot: DataFrame, key: str, period: str,
                     tracked: Sequence[str], period_value, *, start: str = "start_season",
                     end: str = "end_season", current: str = "current_season") -> DataFrame:
    """SCD(t-1) + snapshot(t) -> SCD(t).

    ``prev_scd``: key, tracked..., start, end (as of t-1). ``snapshot``: rows
    with ``period`` and tracked columns; the rows of period t are used. An
    entity's latest record is open, also if it was not seen of late; the records
    before it pass through untouched. Open records meet the snapshot in one full
    outer join on ``key`` (the window that finds them shares its partitioning),
    and each joined row expands to one or two records.
    """
    t = F.lit(period_value)
    prev_scd = prev_scd.select(key, *tracked, start, end)
    prev_scd = prev_scd.withColumn("_latest", F.max(start).over(Window.partitionBy(key)))
    historical = prev_scd.where(F.col(start) < F.col("_latest")).drop("_latest")
    ls = (prev_scd.where(F.col(start) == F.col("_latest"))
          .select(key, *[F.col(c).alias(f"_l_{c}") for c in tracked],
                  F.col(start).alias("_l_start"), F.col(end).alias("_l_end"), F.lit(True).alias("_in_l")))
    ts = (snapshot.where(F.col(period) == t)
          .select(key, *[F.col(c).alias(f"_t_{c}") for c in tracked], F.lit(True).alias("_in_t")))
    j = ls.join(ts, key, "full_outer")

    in_l = F.coalesce(F.col("_in_l"), F.lit(False))
    in_t = F.coalesce(F.col("_in_t"), F.lit(False))
    unchanged = None
    for c in tracked:
        eq = F.col(f"_l_{c}").eqNullSafe(F.col(f"_t_{c}"))
        unchanged = eq if unchanged is None else (unchanged & eq)

    def rec(prefix: str, s: Column, e: Column) -> Column:
        return F.struct(*[F.col(f"{prefix}{c}").alias(c) for c in tracked], s.alias(start), e.alias(end))

    old = rec("_l_", F.col("_l_start"), F.col("_l_end"))
    records = (F.when(in_l & in_t & unchanged, F.array(rec("_t_", F.col("_l_start"), t)))
               .when(in_l & in_t, F.array(old, rec("_t_", t, t)))
               .when(in_t, F.array(rec("_t_", t, t)))
               .otherwise(F.array(old)))
    stepped = j.select(key, F.explode(records).alias("_r")).select(key, "_r.*")
    out = historical.unionByName(stepped)
    return out.withColumn(current, t.cast(snapshot.schema[period].dataType))


def scd2_replay(df: DataFrame, key: str, period: str, tracked: Sequence[str], *,
                as_of_periods: Sequence | None = None, start: str = "start_season",
                end: str = "end_season", as_of: str = "as_of_season") -> DataFrame:
    """The SCD table as it stood at every as-of period, keyed by (key, start, as_of).

    Set-based: spells are found once per entity, over one row per period, and keep the periods
    they were observed in. Then each spell is repeated for the as-of periods from its start on; it
    ends at the last observed period up to each.
    """
    last = df.select(F.max(period)).scalar() if as_of_periods is None else F.lit(max(as_of_periods))
    isl = change_islands(df.select(key, period, *tracked), [key], period, tracked, "_island")
    spells = isl.groupBy(key, "_island", *tracked).agg(F.collect_list(period).alias("_seen"))
    out = spells.withColumn(start, F.array_min("_seen"))
    out = out.withColumn(as_of, F.explode(F.sequence(F.col(start), last.cast(df.schema[period].dataType))))
    if as_of_periods is not None:
        out = out.where(F.col(as_of).isin(list(as_of_periods)))
    seen = F.array_max(F.filter("_seen", lambda p: p <= F.col(as_of)))
    return out.select(key, as_of, *tracked, start, seen.alias(end))


def state_changes(df: DataFrame, key: str, period: str, active: str = "is_active",
                  out: str = "status_change") -> DataFrame:
    """New / Retired / Continued Playing / Returned from Retirement / Stayed Retired."""
    w = Window.partitionBy(key).orderBy(period)
    prev = F.lag(active, 1).over(w)
    a = F.col(active)
    status = (F.when(prev.isNull(), "New")
              .when(a & ~prev, "Returned from Retirement")
              .when(a & prev, "Continued Playing")
              .when(~a & prev, "Retired")
              .otherwise("Stayed Retired"))
    return df.select(key, period, status.alias(out))
