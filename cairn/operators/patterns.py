"""Analytical patterns: growth accounting, retention, funnels, grouping sets,
rolling traffic windows, state changes, streaks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairn.functions.arrays import append_history
from cairn.functions.classify import classify_referrer


# --------------------------------------------------------- growth accounting ---

def _states(y_exists, y_last, y_date, t_day, today_active):
    """Daily and weekly state expressions; branch order is part of the definition."""
    daily = (F.when(~y_exists, "New")
             .when(today_active & (y_last == F.date_sub(t_day, 1)), "Retained")
             .when(today_active & (y_last < F.date_sub(t_day, 1)), "Resurrected")
             .when(~today_active & (y_last == y_date), "Churned")
             .otherwise("Stale"))
    last = F.when(today_active, t_day).otherwise(y_last)
    weekly = (F.when(~y_exists, "New")
              .when(today_active & (y_last < F.date_sub(t_day, 7)), "Resurrected")
              .when(~today_active & (y_last == F.date_sub(y_date, 7)), "Churned")
              .when(F.date_add(last, 7) >= y_date, "Retained")
              .otherwise("Stale"))
    return daily, weekly


def growth_accounting(activity: DataFrame, day, *, user: str = "user_id") -> DataFrame:
    """State of every user seen up to ``day``, set-based.

    ``activity``: distinct (user, date). Yesterday's row exists iff the user was
    active before ``day``; its last_active_date is the last active date before
    ``day`` and its date is ``day - 1``: one partial aggregate per user.
    """
    d = F.lit(day).cast("date")
    per = (activity.where(F.col("date") <= d)
           .groupBy(user)
           .agg(F.min("date").alias("first_active_date"),
                F.max(F.when(F.col("date") < d, F.col("date"))).alias("_y_last"),
                F.max(F.col("date") == d).alias("_t"),
                F.sort_array(F.collect_list("date")).alias("dates_active")))
    y_exists = F.col("_y_last").isNotNull()
    t = F.coalesce(F.col("_t"), F.lit(False))
    daily, weekly = _states(y_exists, F.col("_y_last"), F.date_sub(d, 1), d, t)
    return per.select(user, "first_active_date",
                      F.when(t, d).otherwise(F.col("_y_last")).alias("last_active_date"),
                      daily.alias("daily_active_state"), weekly.alias("weekly_active_state"),
                      "dates_active", d.alias("date"))


def growth_accounting_step(yesterday: DataFrame | None, activity: DataFrame, day, *,
                           user: str = "user_id") -> DataFrame:
    """state(d) = state(d-1) FULL OUTER JOIN today's active users."""
    d = F.lit(day).cast("date")
    t = activity.where(F.col("date") == d).select(user, F.lit(True).alias("_t")).distinct()
    if yesterday is None:
        j = t.select(user, "_t", *[F.lit(None).cast(c).alias(n) for n, c in
                                   (("_y_first", "date"), ("_y_last", "date"), ("_y_date", "date"),
                                    ("_y_dates", "array<date>"))])
    else:
        y = yesterday.select(user, F.col("first_active_date").alias("_y_first"),
                             F.col("last_active_date").alias("_y_last"), F.col("date").alias("_y_date"),
                             F.col("dates_active").alias("_y_dates"))
        j = y.join(t, user, "full_outer")
    y_exists = F.col("_y_date").isNotNull()
    today = F.coalesce(F.col("_t"), F.lit(False))
    daily, weekly = _states(y_exists, F.col("_y_last"), F.col("_y_date"), d, today)
    return j.select(user, F.coalesce("_y_first", F.when(today, d)).alias("first_active_date"),
                    F.when(today, d).otherwise(F.col("_y_last")).alias("last_active_date"),
                    daily.alias("daily_active_state"), weekly.alias("weekly_active_state"),
                    append_history(F.col("_y_dates"), d, today).alias("dates_active"),
                    F.coalesce(F.when(today, d), F.date_add("_y_date", 1)).alias("date"))


def retention_curve(activity: DataFrame, *, user: str = "user_id", end=None) -> DataFrame:
    """Share of users active k days after their first active day (the J curve).

    Numerator: active user-days by offset (partial aggregate). Denominator: users
    whose history reaches offset k, i.e. a suffix sum over the histogram of
    (end - first day); that histogram has one row per calendar day, so its
    ordered window is bounded by the date span, not by the data.
    """
    first = activity.groupBy(user).agg(F.min("date").alias("_first"))
    end_c = F.lit(end).cast("date") if end is not None else activity.select(F.max("date")).scalar()
    num = (activity.join(first, user)
           .groupBy(F.datediff("date", "_first").alias("days_since_first_active"))
           .agg(F.count(F.lit(1)).alias("_active")))
    span = first.groupBy(F.datediff(end_c, "_first").alias("_span")).agg(F.count(F.lit(1)).alias("_n"))
    every = span.agg(F.max("_span").alias("_m")).select(
        F.explode(F.sequence(F.lit(0), F.col("_m"))).alias("_span"), F.lit(0).cast("bigint").alias("_n"))
    hist = every.unionByName(span).groupBy("_span").agg(F.sum("_n").alias("_n"))
    w = Window.orderBy(F.col("_span").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    den = hist.select(F.col("_span").alias("days_since_first_active"), F.sum("_n").over(w).alias("n_users"))
    return (den.join(num, "days_since_first_active", "left")
            .select(F.col("days_since_first_active").cast("bigint").alias("days_since_first_active"),
                    (F.coalesce("_active", F.lit(0)).cast("double") / F.col("n_users")).alias("pct_active"),
                    F.col("n_users").cast("bigint").alias("n_users")))


# ------------------------------------------------------------------ funnel ---

def funnel_conversion(events: DataFrame, target: str, *, min_count: int = 100, user: str = "user_id",
                      url: str = "url", ts: str = "event_time") -> DataFrame:
    """Per url: events followed later the same day (same user) by any event, and the
    share of those followed by ``target``.

    The self join of every event with all later events of its user-day becomes
    two aggregates per user-day (last event time, last target time) joined back:
    linear work, and a hot user-day is reduced map-side before the shuffle.
    Maxima need no distinct rows, so they are taken from the raw events.
    """
    raw = events.where(F.col(user).isNotNull()).select(user, ts, url).withColumn("_day", F.to_date(ts))
    e = raw.distinct()
    last = (raw.groupBy(user, "_day")
            .agg(F.max(ts).alias("_last"), F.max(F.when(F.col(url) == target, F.col(ts))).alias("_last_t")))
    j = e.join(last, [user, "_day"]).where(F.col(ts) < F.col("_last"))
    conv = F.when(F.col(ts) < F.col("_last_t"), 1).otherwise(0)
    out = j.groupBy(url).agg(F.count(F.lit(1)).alias("n_events"), F.sum(conv).alias("_conv"))
    rate = F.col("_conv").cast("double") / F.col("n_events")
    return out.select(url, "n_events", rate.alias("conversion_rate")).where(
        (F.col("conversion_rate") > 0) & (F.col("n_events") > min_count))


# ----------------------------------------------------------- grouping sets ---

def device_hits_grouping_sets(events: DataFrame, devices: DataFrame) -> DataFrame:
    """Hits by (os, device, browser) and by each alone, one pass (Expand), labelled."""
    aug = events.join(devices, "device_id").select(
        F.coalesce("os_type", F.lit("unknown")).alias("os_type"),
        F.coalesce("device_type", F.lit("unknown")).alias("device_type"),
        F.coalesce("browser_type", F.lit("unknown")).alias("browser_type"))
    g = aug.groupingSets([["browser_type", "device_type", "os_type"], ["browser_type"], ["os_type"],
                          ["device_type"]], "os_type", "device_type", "browser_type")
    res = g.agg(F.count(F.lit(1)).alias("number_of_hits"),
                F.grouping("os_type").alias("_go"), F.grouping("device_type").alias("_gd"),
                F.grouping("browser_type").alias("_gb"),
                F.grouping_id("os_type", "device_type", "browser_type").alias("grouping_id"))
    level = (F.when((F.col("_go") == 0) & (F.col("_gd") == 0) & (F.col("_gb") == 0), "os_type__device_type__browser")
             .when(F.col("_gb") == 0, "browser_type").when(F.col("_gd") == 0, "device_type")
             .when(F.col("_go") == 0, "os_type"))
    return res.select(level.alias("aggregation_level"),
                      F.coalesce("os_type", F.lit("(overall)")).alias("os_type"),
                      F.coalesce("device_type", F.lit("(overall)")).alias("device_type"),
                      F.coalesce("browser_type", F.lit("(overall)")).alias("browser_type"),
                      "number_of_hits", F.col("grouping_id").cast("bigint").alias("grouping_id"))


def game_grouping_sets(details: DataFrame, games: DataFrame) -> DataFrame:
    """Points, games and mean rebounds by (player, team), (player, season), (team)."""
    g = games.select("game_id", "season")
    d = details.where(F.col("min").isNotNull()).join(g, "game_id")
    gs = d.groupingSets([["player_name", "team_abbreviation"], ["player_name", "season"], ["team_abbreviation"]],
                        "player_name", "team_abbreviation", "season")
    res = gs.agg(F.sum("pts").cast("bigint").alias("total_points"),
                 F.count_distinct("game_id").alias("games_played"),
                 F.avg("reb").alias("avg_rebounds"),
                 F.grouping_id("player_name", "team_abbreviation", "season").cast("bigint").alias("grouping_id"))
    return res.select(F.coalesce("player_name", F.lit("All Players")).alias("player"),
                      F.coalesce("team_abbreviation", F.lit("All Teams")).alias("team"),
                      F.coalesce(F.col("season").cast("string"), F.lit("All Seasons")).alias("season"),
                      "total_points", "games_played", "avg_rebounds", "grouping_id")


# ---------------------------------------------------------- traffic windows ---

def traffic_windows(events: DataFrame, devices: DataFrame, *, min_total: int = 500,
                    prev_week: tuple[int, int] = (-13, -6), frame: str = "rows",
                    referrer_match: str = "like") -> DataFrame:
    """Per (referrer, url, day): weekly rolling count, previous-week count, share of
    month and of total.

    ``frame='rows'`` counts rows (days with traffic), as in the original;
    ``frame='range'`` uses calendar days (a day without traffic still takes its
    place in the week). ``prev_week=(-13, -7)`` gives a non-overlapping previous
    week. ``referrer_match='host'`` classifies by the referrer's host instead of a
    substring anywhere in the URL."""
    label = classify_referrer(F.col("referrer"), match=referrer_match)
    hits = (events.join(devices, "device_id").where(label.isNotNull())
            .groupBy(label.alias("referrer"), "url", F.to_date("event_time").alias("event_date"))
            .agg(F.count(F.lit(1)).alias("count")))
    page = Window.partitionBy("referrer", "url")
    place = F.unix_date("event_date")
    days = page.orderBy(place)

    def stretch(first: int, last: int):
        return days.rangeBetween(first, last) if frame == "range" else days.rowsBetween(first, last)

    def hits_in(window):
        return F.sum("count").over(window)

    measured = hits.select(
        "*", hits_in(days.rowsBetween(Window.unboundedPreceding, 0)).alias("rolling_cumulative_sum"),
        hits_in(stretch(-6, 0)).alias("weekly_rolling_count"), hits_in(stretch(*prev_week)).alias("previous_weekly_rolling_count"),
        (F.col("count") / hits_in(Window.partitionBy("referrer", "url", F.trunc("event_date", "month")))).alias("pct_of_month"),
        (F.col("count") / hits_in(page)).alias("pct_of_total"), hits_in(page).alias("_whole"))
    return measured.where(F.col("_whole") > min_total).drop("_whole")


# ------------------------------------------------------------ team records ---

def team_games(games: DataFrame) -> DataFrame:
    """One row per (team, game): home and visitor sides, win taken from the game result."""
    home = games.select(F.col("home_team_id").alias("team_id"), "game_id", "game_date_est",
                        F.col("home_team_wins").cast("bigint").alias("win"))
    away = games.select(F.col("visitor_team_id").alias("team_id"), "game_id", "game_date_est",
                        (1 - F.col("home_team_wins")).cast("bigint").alias("win"))
    return home.unionByName(away)


def max_wins_in_stretch(games: DataFrame, width: int = 90, *, partitions: int | None = None) -> DataFrame:
    """Most wins in any ``width``-game stretch per team (rows, so the first stretches are partial)."""
    from cairn.operators.sequence import rolling_sum
    tg = team_games(games)
    r = rolling_sum(tg, "team_id", ["game_date_est", "game_id"], "win", width, out="wins", partitions=partitions)
    return r.groupBy("team_id").agg(F.count(F.lit(1)).alias("games"),
                                    F.max("wins").cast("bigint").alias(f"max_wins_{width}"))


def longest_scoring_streak(details: DataFrame, games: DataFrame, threshold: int = 10, *,
                           partitions: int | None = None) -> DataFrame:
    """Longest run of consecutive games with more than ``threshold`` points, per player."""
    from cairn.operators.sequence import longest_run
    g = games.select("game_id", "game_date_est")
    d = details.select("player_id", "game_id", "pts").join(g, "game_id") \
        .withColumn("_over", F.col("pts") > F.lit(threshold))
    return longest_run(d, "player_id", ["game_date_est", "game_id"], "_over", partitions=partitions)
