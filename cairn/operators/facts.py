"""Fact modeling: deduplicated facts, reduced monthly array facts.

Monthly array facts store one element per day of the month. The step form
appends today's value to yesterday's array (padding a newcomer with the fill
value up to today's day index); the set-based form builds the same arrays
from a per-(key, day) aggregate with one partial aggregation and a per-row
``transform`` over the day positions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.functions.arrays import concat_safe, pad_array
from cairn.operators.core import dedupe


def _fill(fill, dtype: str = "bigint"):
    return F.lit(fill).cast(dtype)


def monthly_arrays(daily: DataFrame, keys: Sequence[str], metrics: Sequence[str], as_of, *,
                   fill=0, dtype: str = "bigint", first_found: bool = False) -> DataFrame:
    """Set-based month-to-date arrays at ``as_of``.

    ``daily``: keys..., date, one column per metric (one row per key and day).
    Output per key with activity this month: keys..., month_start, one array
    per metric of length (day of ``as_of``), element i = value on day i+1 or
    ``fill``; optionally first_found_date.
    """
    d = F.to_date(F.lit(as_of))
    ms = F.trunc(d, "month")
    rows = daily.where((F.col("date") >= ms) & (F.col("date") <= d))
    entry = F.struct(F.datediff("date", ms).alias("i"), *[F.col(m) for m in metrics])
    agg = [F.collect_list(entry).alias("_e")]
    if first_found:
        agg.append(F.min("date").alias("first_found_date"))
    g = rows.groupBy(*keys).agg(*agg)
    def entries(m):
        return F.map_from_entries(F.transform("_e", lambda e: F.struct(e["i"], e[m])))

    def by_day(m, n):
        return F.transform(F.sequence(F.lit(0), n - 1),
                           lambda i: F.coalesce(F.try_element_at(F.col(f"_m_{m}"), i), _fill(fill, dtype)))

    g = g.select(*keys, *(["first_found_date"] if first_found else []),
                 *[entries(m).alias(f"_m_{m}") for m in metrics])
    n = F.datediff(d, ms) + 1
    out = g.select(*keys, ms.alias("month_start"), *[by_day(m, n).alias(m) for m in metrics],
                   *(["first_found_date"] if first_found else []))
    return out


def monthly_arrays_step(yesterday: DataFrame | None, daily: DataFrame, keys: Sequence[str],
                        metrics: Sequence[str], day, *, fill=0, dtype: str = "bigint",
                        first_found: bool = False) -> DataFrame:
    """state(d) = state(d-1) FULL OUTER JOIN today's values; newcomers padded to d's index.

    ``yesterday`` is any earlier state of the month, None on its first day: days without a step in
    between are padded, and rows of another month are left out (a new month starts empty).
    """
    d = F.to_date(F.lit(day))
    ms = F.trunc(d, "month")
    t = daily.where(F.col("date") == d).select(*keys, *[F.col(m).alias(f"_t_{m}") for m in metrics],
                                                F.lit(True).alias("_t"))
    if yesterday is None:
        j = t
        for m in metrics:
            j = j.withColumn(f"_y_{m}", F.lit(None).cast(f"array<{dtype}>"))
        if first_found:
            j = j.withColumn("_y_first", F.lit(None).cast("date"))
    else:
        y = yesterday.where(F.col("month_start") == ms).select(*keys, *[F.col(m).alias(f"_y_{m}") for m in metrics],
                             *([F.col("first_found_date").alias("_y_first")] if first_found else []))
        j = y.join(t, list(keys), "full_outer")
    idx = F.datediff(d, ms)
    cols = []
    for m in metrics:
        today_val = F.coalesce(F.col(f"_t_{m}").cast(dtype), _fill(fill, dtype)) if fill is not None \
            else F.col(f"_t_{m}").cast(dtype)
        known = F.coalesce(F.col(f"_y_{m}"), F.array().cast(f"array<{dtype}>"))
        prefix = F.concat(known, pad_array(idx - F.size(known), _fill(fill, dtype)))
        cols.append(concat_safe(prefix, F.array(today_val)).alias(m))
    extra = []
    if first_found:
        extra = [F.least(F.col("_y_first"), F.when(F.col("_t"), d)).alias("first_found_date")]
    return j.select(*keys, ms.alias("month_start"), *cols, *extra)


def sum_by_position(arrays: DataFrame, group: Sequence[str], array_col: str, *, start: str = "month_start",
                    out: str = "value") -> DataFrame:
    """Element-wise sum of arrays per group, back to dated rows (posexplode -> sum -> date_add)."""
    ex = arrays.select(*group, F.posexplode(array_col).alias("_pos", "_v"))
    return (ex.groupBy(*group, "_pos").agg(F.sum("_v").cast("bigint").alias(out))
            .select(*[g for g in group if g != start], F.date_add(F.col(start), F.col("_pos")).alias("date"), out))


def first_positions(arrays: DataFrame, group: Sequence[str], array_col: str,
                    names: Sequence[str] = ("num_hits_first_day", "num_hits_second_day", "num_hits_third_day")
                    ) -> DataFrame:
    """Sum of the first len(names) positions per group; short arrays count as 0 (``get`` is ANSI-safe)."""
    return arrays.groupBy(*group).agg(
        *[F.sum(F.coalesce(F.get(F.col(array_col), F.lit(i)), F.lit(0))).cast("bigint").alias(n)
          for i, n in enumerate(names)])


# ------------------------------------------------------------- game facts ---

GAME_DETAIL_KEY = ("game_id", "team_id", "player_id")


def dedupe_game_details(details: DataFrame, keys: Sequence[str] = GAME_DETAIL_KEY) -> DataFrame:
    """No duplicate per (game, team, player); the survivor is the greatest row (total order)."""
    return dedupe(details, keys)


def fct_game_details(details: DataFrame, games: DataFrame) -> DataFrame:
    """Deduplicated player-game fact with dim_ / m_ columns."""
    dd = dedupe_game_details(details)
    g = games.select("game_id", "game_date_est", "season", "home_team_id")
    j = dd.join(g, "game_id")
    mm = F.split_part(F.col("min"), F.lit(":"), F.lit(1)).try_cast("double")
    ss = F.split_part(F.col("min"), F.lit(":"), F.lit(2)).try_cast("double")

    def has(code):
        return F.coalesce(F.instr(F.col("comment"), code), F.lit(0)) > 0
    return j.select(
        F.col("game_date_est").alias("dim_game_date"),
        F.col("season").alias("dim_season"),
        F.col("team_id").alias("dim_team_id"),
        F.col("player_id").alias("dim_player_id"),
        F.col("player_name").alias("dim_player_name"),
        F.col("start_position").alias("dim_start_position"),
        (F.col("team_id") == F.col("home_team_id")).alias("dim_is_playing_at_home"),
        has("DNP").alias("dim_did_not_play"),
        has("DND").alias("dim_did_not_dress"),
        has("NWT").alias("dim_not_with_team"),
        (mm + F.coalesce(ss, F.lit(0.0)) / 60).alias("m_minutes"),
        F.col("pts").alias("m_pts"), F.col("reb").alias("m_reb"), F.col("ast").alias("m_ast"),
        F.col("plus_minus").alias("m_plus_minus"),
        F.col("game_id").alias("dim_game_id"))
