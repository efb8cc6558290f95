"""Cumulative entity tables: today's state = yesterday's state (+) today's facts.

Two equal forms of every table:
* the daily / yearly **step** (full outer join of yesterday's state with
  today's facts on the entity key: one shuffle), with a **loop** driver that
  writes each period to the shared checkpoint folder (which cuts lineage);
* the set-based **backfill**: the entity's per-period facts are collected once
  (one shuffle, partial aggregation; the list per entity is bounded by the
  number of periods because facts are pre-aggregated per (entity, period)),
  then every as-of period is produced by ``explode(sequence(...))`` and a
  ``filter`` over the history array. No join, no window, no cross join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions.arrays import append_history, concat_safe, first_elem, last_elem
from cairn.functions.classify import threshold_class

# Scoring-class thresholds on points and quality-class thresholds
# on mean rating, first match wins.
SCORING_THRESHOLDS = ((20, "star"), (15, "good"), (10, "average"))
QUALITY_THRESHOLDS = ((8, "star"), (7, "good"), (6, "average"))


# ---------------------------------------------------------------- players ---

def players_backfill(seasons: DataFrame, *, key: str = "player_name", period: str = "season",
                     attrs: Sequence[str] = ("college", "country"),
                     stats: Sequence[str] = ("gp", "pts"), metric: str = "pts",
                     thresholds=SCORING_THRESHOLDS, end_period=None, as_of=None) -> DataFrame:
    """players(t) for every t from each player's first season to ``end_period``
    (or only ``t = as_of`` when given: one row per player seen by then).

    Columns: key, attrs..., seasons (array of struct(season, stats...)),
    scoring_class, years_since_last_active, is_active, current_season.
    """
    if as_of is not None:
        seasons = seasons.where(F.col(period) <= F.lit(as_of))
    item = F.struct(F.col(period).alias("season"), *[F.col(s) for s in stats])
    # an attribute is the first value the step would have met, and unknown before that period
    known = [F.min(F.when(F.col(a).isNotNull(), F.struct(F.col(period).alias("since"), F.col(a).alias("value")))).alias(a)
             for a in attrs]
    per = (seasons.groupBy(key)
           .agg(F.sort_array(F.collect_list(item)).alias("_hist"),
                F.min(period).alias("_first"), *known))
    dtype = seasons.schema[period].dataType
    if as_of is not None:
        spine = per.select(key, *attrs, "_hist", F.lit(as_of).cast(dtype).alias("current_season"))
    else:
        end = F.lit(end_period) if end_period is not None else seasons.select(F.max(period)).scalar()
        spine = per.select(key, *attrs, "_hist",
                           F.explode(F.sequence(F.col("_first"), end.cast(dtype))).alias("current_season"))
    hist = F.filter("_hist", lambda s: s["season"] <= F.col("current_season"))
    out = spine.withColumn("seasons", hist).drop("_hist").withColumns(
        {a: F.when(F.col(f"{a}.since") <= F.col("current_season"), F.col(f"{a}.value")) for a in attrs})
    last = F.element_at("seasons", -1)
    return out.select(
        key, *attrs, "seasons",
        threshold_class(last[metric], thresholds, "bad").alias("scoring_class"),
        (F.col("current_season") - last["season"]).alias("years_since_last_active"),
        (last["season"] == F.col("current_season")).alias("is_active"),
        "current_season")


def players_step(prev: DataFrame | None, today: DataFrame, period_value: int, *,
                 key: str = "player_name", period: str = "season",
                 attrs: Sequence[str] = ("college", "country"), stats: Sequence[str] = ("gp", "pts"),
                 metric: str = "pts", thresholds=SCORING_THRESHOLDS) -> DataFrame:
    """players(t) = players(t-1) FULL OUTER JOIN player_seasons(t)."""
    ts = today.where(F.col(period) == F.lit(period_value)).select(
        key, *[F.col(a).alias(f"_t_{a}") for a in attrs], F.col(period).alias("_t_season"),
        *[F.col(s).alias(f"_t_{s}") for s in stats])
    if prev is None:
        spark = today.sparkSession
        prev = spark.createDataFrame([], players_schema(today, key, period, attrs, stats))
    ls = prev.select(key, *[F.col(a).alias(f"_l_{a}") for a in attrs], F.col("seasons").alias("_l_seasons"),
                     F.col("scoring_class").alias("_l_class"),
                     F.col("years_since_last_active").alias("_l_years"))
    j = ls.join(ts, key, "full_outer")
    active = F.col("_t_season").isNotNull()
    item = F.struct(F.col("_t_season").alias("season"), *[F.col(f"_t_{s}").alias(s) for s in stats])
    return j.select(
        key,
        *[F.coalesce(F.col(f"_l_{a}"), F.col(f"_t_{a}")).alias(a) for a in attrs],
        append_history(F.col("_l_seasons"), item, active).alias("seasons"),
        F.when(active, threshold_class(F.col(f"_t_{metric}"), thresholds, "bad"))
         .otherwise(F.col("_l_class")).alias("scoring_class"),
        F.when(active, F.lit(0)).otherwise(F.col("_l_years") + 1).cast("bigint").alias("years_since_last_active"),
        active.alias("is_active"),
        F.lit(period_value).cast(today.schema[period].dataType).alias("current_season"))


def players_schema(today: DataFrame, key, period, attrs, stats):
    from pyspark.sql import types as T
    s = today.schema
    item = T.StructType([T.StructField("season", s[period].dataType)] + [T.StructField(x, s[x].dataType) for x in stats])
    return T.StructType(
        [T.StructField(key, s[key].dataType)] + [T.StructField(a, s[a].dataType) for a in attrs]
        + [T.StructField("seasons", T.ArrayType(item)), T.StructField("scoring_class", T.StringType()),
           T.StructField("years_since_last_active", T.LongType()), T.StructField("is_active", T.BooleanType()),
           T.StructField("current_season", s[period].dataType)])


def players_loop(spark: SparkSession, seasons, periods: Sequence[int], **kw) -> DataFrame:
    """Run ``players_step`` for every period in order; each state is checkpointed
    to the shared checkpoint folder, so lineage stays one step long.

    ``seasons`` is a DataFrame, or a function ``period -> DataFrame`` returning
    only that period's facts (so each step reads one period)."""
    state = None
    for t in periods:
        today = seasons(t) if callable(seasons) else seasons
        state = players_step(state, today, t, **kw).checkpoint(eager=True)
    return state


def first_last_ratio(players: DataFrame, key: str = "player_name", metric: str = "pts") -> DataFrame:
    """Latest season's metric over the first season's; a zero first value divides by 1."""
    first = first_elem("seasons")[metric]
    last = last_elem("seasons")[metric]
    den = F.when(first == 0, F.lit(1)).otherwise(first)
    return players.select(key, "current_season", (last.cast("double") / den).alias("ratio_most_recent_to_first"))


def unnest_history(players: DataFrame, key: str = "player_name", history: str = "seasons") -> DataFrame:
    """History array back to one row per element (UNNEST ... s.*)."""
    return players.select(key, "current_season", F.explode(history).alias("_s")).select(key, "current_season", "_s.*")


# ----------------------------------------------------------------- actors ---

def actor_year_facts(films: DataFrame, key: str = "actorid", period: str = "year") -> DataFrame:
    """Per (actor, year): the year's films as an array and the mean rating."""
    film = F.struct("film", "votes", "rating", "filmid", F.col(period).alias("year"))
    return (films.groupBy(key, period)
            .agg(F.sort_array(F.collect_list(film)).alias("films"),
                 F.avg("rating").alias("avg_rating")))


def actors_step(prev: DataFrame | None, films: DataFrame, year: int, *, key: str = "actorid",
                thresholds=QUALITY_THRESHOLDS) -> DataFrame:
    """actors(y) = actors(y-1) FULL OUTER JOIN films of year y; class carried forward when inactive."""
    t = actor_year_facts(films.where(F.col("year") == F.lit(year)), key)
    t = t.select(key, F.col("films").alias("_t_films"), F.col("avg_rating").alias("_t_avg"), F.lit(True).alias("_t"))
    if prev is None:
        j = t.withColumn("_l_films", F.lit(None).cast(t.schema["_t_films"].dataType)) \
             .withColumn("_l_class", F.lit(None).cast("string"))
    else:
        ls = prev.select(key, F.col("films").alias("_l_films"), F.col("quality_class").alias("_l_class"))
        j = ls.join(t, key, "full_outer")
    active = F.coalesce(F.col("_t"), F.lit(False))
    return j.select(
        key,
        concat_safe(F.col("_l_films"), F.col("_t_films")).alias("films"),
        F.when(active, threshold_class(F.col("_t_avg"), thresholds, "bad")).otherwise(F.col("_l_class"))
         .alias("quality_class"),
        F.lit(year).cast("bigint").alias("current_year"),
        active.alias("is_active"))


def actors_backfill(films: DataFrame, *, key: str = "actorid", thresholds=QUALITY_THRESHOLDS,
                    end_year=None, as_of=None, with_films: bool = True) -> DataFrame:
    """actors(y) for every y from the actor's first film year to ``end_year``
    (or only ``y = as_of``). ``with_films=False`` keeps only class and activity
    (what an SCD needs), so no film arrays are collected. Films after the last
    year asked for are left out before anything is collected."""
    if as_of is not None:
        films = films.where(F.col("year") <= F.lit(as_of))
    elif isinstance(end_year, int):
        films = films.where(F.col("year") <= F.lit(end_year))
    if with_films:
        per = actor_year_facts(films, key)
        item = F.struct(F.col("year"), F.col("avg_rating"), F.col("films"))
    else:
        per = films.groupBy(key, "year").agg(F.avg("rating").alias("avg_rating"))
        item = F.struct(F.col("year"), F.col("avg_rating"))
    agg = per.groupBy(key).agg(F.sort_array(F.collect_list(item)).alias("_hist"), F.min("year").alias("_first"))
    if as_of is not None:
        spine = agg.select(key, "_hist", F.lit(as_of).cast("bigint").alias("current_year"))
    else:
        end = F.lit(end_year) if end_year is not None else films.select(F.max("year")).scalar()
        spine = agg.select(key, "_hist", F.explode(F.sequence("_first", end.cast("bigint"))).alias("current_year"))
    h = F.filter("_hist", lambda s: s["year"] <= F.col("current_year"))
    spine = spine.withColumn("_h", h)
    last = F.element_at("_h", -1)
    films_col = [F.flatten(F.transform("_h", lambda s: s["films"])).alias("films")] if with_films else []
    return spine.select(
        key, *films_col,
        threshold_class(last["avg_rating"], thresholds, "bad").alias("quality_class"),
        "current_year",
        (last["year"] == F.col("current_year")).alias("is_active"))


# ------------------------------------------------------- activity date lists ---

def daily_activity(events: DataFrame, keys: Sequence[str], ts: str = "event_time") -> DataFrame:
    """Distinct (keys..., date) with an event; NULL keys dropped."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else (cond & c)
    return events.where(cond).select(*keys, F.to_date(ts).alias("date")).distinct()


def dates_cumulated(activity: DataFrame, keys: Sequence[str], as_of, *, name: str = "dates_active") -> DataFrame:
    """Set-based state at ``as_of``: the ascending list of active dates up to it, per key."""
    d = F.lit(as_of).cast("date")
    return (activity.where(F.col("date") <= d)
            .groupBy(*keys).agg(F.sort_array(F.collect_set("date")).alias(name))
            .withColumn("date", d))


def dates_cumulated_step(yesterday: DataFrame | None, activity: DataFrame, keys: Sequence[str], day, *,
                         name: str = "dates_active") -> DataFrame:
    """state(d) = state(d-1) FULL OUTER JOIN activity(d): the date is appended (ascending)."""
    d = F.lit(day).cast("date")
    t = activity.where(F.col("date") == d).select(*keys, F.lit(True).alias("_t")).distinct()
    if yesterday is None:
        j = t.withColumn("_y", F.lit(None).cast("array<date>"))
    else:
        j = yesterday.select(*keys, F.col(name).alias("_y")).join(t, list(keys), "full_outer")
    return j.select(*keys, append_history(F.col("_y"), d, F.col("_t").isNotNull()).alias(name), d.alias("date"))


def date_list_bits(states: DataFrame, *, name: str = "dates_active", as_of: Column | None = None) -> DataFrame:
    """32-bit activity mask per row of a date-list state (bit 31 = as-of day) plus
    the monthly / weekly / previous-week flags and L7 / L32 counts. A per-row
    higher-order fold: no explode, no shuffle."""
    from cairn.functions.dates import LAST_7_DAYS_MASK, PREVIOUS_WEEK_MASK, date_bit
    as_of = as_of if as_of is not None else F.col("date")
    bits = F.aggregate(name, F.lit(0).cast("bigint"), lambda acc, x: acc.bitwiseOR(date_bit(as_of, x)))
    out = states.withColumn("datelist_int", bits)
    dl = F.col("datelist_int")
    l7 = F.bit_count(dl.bitwiseAND(F.lit(LAST_7_DAYS_MASK))).cast("bigint")
    prev7 = F.bit_count(dl.bitwiseAND(F.lit(PREVIOUS_WEEK_MASK))).cast("bigint")
    return out.select(
        *[c for c in states.columns if c != name], "datelist_int",
        (F.bit_count(dl) > 0).alias("monthly_active"),
        F.bit_count(dl).cast("bigint").alias("l32"),
        (l7 > 0).alias("weekly_active"), l7.alias("l7"),
        (prev7 > 0).alias("weekly_active_previous_week"))


def device_activity_map(activity: DataFrame, user: str = "user_id", browser: str = "browser_type",
                        name: str = "device_activity_datelist") -> DataFrame:
    """MAP<browser, ARRAY<date>> per user from the long form (user, browser, dates)."""
    entry = F.struct(F.col(browser).alias("key"), F.col("dates").alias("value"))
    return (activity.groupBy(user, "date")
            .agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias(name)))


def device_activity_step(yesterday: DataFrame | None, today_map: DataFrame, day, user: str = "user_id",
                         name: str = "device_activity_datelist") -> DataFrame:
    """Merge yesterday's browser->dates map with today's: dates of a browser are concatenated."""
    d = F.lit(day).cast("date")
    t = today_map.select(user, F.col(name).alias("_t"))
    if yesterday is None:
        j = t.withColumn("_y", F.lit(None).cast(t.schema["_t"].dataType))
    else:
        j = yesterday.select(user, F.col(name).alias("_y")).join(t, user, "full_outer")
    merged = F.map_zip_with(F.coalesce("_y", F.create_map().cast(t.schema["_t"].dataType)),
                            F.coalesce("_t", F.create_map().cast(t.schema["_t"].dataType)),
                            lambda k, a, b: concat_safe(a, b))
    return j.select(user, merged.alias(name), d.alias("date"))


def catch_up(spark: SparkSession, path: str, step, facts_for, until, *, first=None,
             period_col: str = "current_season", next_period=lambda t: t + 1) -> list:
    """Bring a stored cumulative table up to ``until``: next period = stored max + 1.

    ``path`` is a Parquet table partitioned by ``period_col`` in a shared folder;
    ``step(prev, facts, t)`` is a cumulative step and ``facts_for(t)`` returns only
    period t's facts. Every step reads partition t-1, writes partition t with
    dynamic partition overwrite (a rerun replaces only that period) and never
    rewrites the partition it reads. Returns the periods run.
    """
    from pyspark.errors import AnalysisException
    try:
        last = spark.read.parquet(path).agg(F.max(period_col)).first()[0]
    except AnalysisException:
        last = None
    t = next_period(last) if last is not None else first
    if t is None:
        raise ValueError("empty table: give the first period")
    done, prev_t = [], last
    while t <= until:
        prev = None if prev_t is None else spark.read.parquet(path).where(F.col(period_col) == prev_t)
        state = step(prev, facts_for(t), t)
        (state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(period_col).parquet(path))
        done.append(t)
        prev_t, t = t, next_period(t)
    return done


def players_catch_up(spark: SparkSession, path: str, seasons_for, until: int, *, first: int | None = None,
                     **kw) -> list[int]:
    """``catch_up`` for the players table (yearly ``players_step``)."""
    return catch_up(spark, path, lambda prev, facts, t: players_step(prev, facts, t, **kw), seasons_for, until,
                    first=first)


def actors_catch_up(spark: SparkSession, path: str, films, until: int, *, first: int | None = None,
                    **kw) -> list[int]:
    """``catch_up`` for the actors table (yearly ``actors_step``; films are filtered per year inside)."""
    return catch_up(spark, path, lambda prev, facts, t: actors_step(prev, facts, t, **kw), lambda t: films, until,
                    first=first, period_col="current_year")
