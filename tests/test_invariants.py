"""Equalities between the step, loop and set-based forms, and semantic edge cases."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from cairn.operators import cumulative as cu
from cairn.operators import facts, patterns, scd
from cairn.sources import testdata as td
from tests.conftest import SF_SMALL

PT = ((300000, "star"), (250000, "good"), (200000, "average"))


def _canon(df):
    return df.select([F.to_json(F.col(c)).alias(c) if str(df.schema[c].dataType).startswith(("Array", "Map", "Struct"))
                      else F.col(c) for c in df.columns])


def test_players_loop_equals_backfill(spark):
    ps = td.player_seasons(spark, SF_SMALL)
    loop = cu.players_loop(spark, ps, list(range(1995, 1999)), thresholds=PT)
    back = cu.players_backfill(ps, thresholds=PT).where("current_season = 1998")
    assertDataFrameEqual(_canon(loop), _canon(back.select(loop.columns)))


def test_actors_step_equals_backfill(spark):
    films = td.actor_films(spark, SF_SMALL)
    state = None
    for y in range(1995, 1999):
        state = cu.actors_step(state, films, y)
    back = cu.actors_backfill(films, as_of=1998).select(state.columns)
    assertDataFrameEqual(_canon(state), _canon(back))


def test_scd_increment_equals_backfill(spark):
    snaps = cu.players_backfill(td.player_seasons(spark, SF_SMALL), thresholds=PT).select(
        "player_name", "current_season", "scoring_class", "is_active")
    prev = scd.scd2_backfill(snaps, "player_name", "current_season", ["scoring_class", "is_active"], as_of=1999)
    inc = scd.scd2_incremental(prev, snaps, "player_name", "current_season", ["scoring_class", "is_active"], 2000)
    back = scd.scd2_backfill(snaps, "player_name", "current_season", ["scoring_class", "is_active"], as_of=2000)
    assertDataFrameEqual(inc, back.select(inc.columns))


def test_scd_edge_cases(spark):
    rows = [("a", 1, "x"), ("a", 2, None), ("a", 3, "x"), ("a", 5, "x"), ("b", 2, "y")]
    src = spark.createDataFrame(rows, "k string, p long, c string")
    out = {(r.k, r.c, r.s, r.e) for r in
           scd.scd2_backfill(src, "k", "p", ["c"], start="s", end="e", current=None).collect()}
    # NULL is a value change in both directions; two separate 'x' spells stay two rows; a gap does not split
    assert out == {("a", "x", 1, 1), ("a", None, 2, 2), ("a", "x", 3, 5), ("b", "y", 2, 2)}


def test_scd_incremental_cases(spark):
    prev = spark.createDataFrame([("old", "x", 1, 1), ("same", "x", 1, 2), ("chg", "x", 2, 2), ("gone", "x", 1, 2)],
                                 "k string, c string, s long, e long")
    snap = spark.createDataFrame([("same", 3, "x"), ("chg", 3, "y"), ("new", 3, "z")], "k string, p long, c string")
    out = {(r.k, r.c, r.s, r.e) for r in
           scd.scd2_incremental(prev, snap, "k", "p", ["c"], 3, start="s", end="e", current="cur").collect()}
    assert out == {("old", "x", 1, 1), ("same", "x", 1, 3), ("chg", "x", 2, 2), ("chg", "y", 3, 3),
                   ("new", "z", 3, 3), ("gone", "x", 1, 2)}


def test_dates_step_equals_set_based(spark):
    act = cu.daily_activity(td.web_events(spark, SF_SMALL), ["user_id"])
    state = None
    for d in range(1, 11):
        state = cu.dates_cumulated_step(state, act, ["user_id"], f"2024-01-{d:02d}")
    back = cu.dates_cumulated(act, ["user_id"], "2024-01-10")
    assertDataFrameEqual(_canon(state.where(F.size("dates_active") > 0)), _canon(back.select(state.columns)))


def test_growth_step_equals_set_based(spark):
    act = cu.daily_activity(td.web_events(spark, SF_SMALL), ["user_id"])
    state = None
    for d in range(1, 11):
        state = patterns.growth_accounting_step(state, act, f"2024-01-{d:02d}")
    back = patterns.growth_accounting(act, "2024-01-10")
    assertDataFrameEqual(_canon(state), _canon(back.select(state.columns)))


def test_month_array_step_equals_set_based(spark):
    e = td.web_events(spark, SF_SMALL)
    daily = e.groupBy("user_id", F.to_date("event_time").alias("date")).agg(F.count(F.lit(1)).alias("hits"))
    for fill, ff in ((0, False), (None, True)):
        state = None
        for d in range(1, 8):
            state = facts.monthly_arrays_step(state, daily, ["user_id"], ["hits"], f"2024-01-{d:02d}",
                                              fill=fill, first_found=ff)
        back = facts.monthly_arrays(daily, ["user_id"], ["hits"], "2024-01-07", fill=fill, first_found=ff)
        assertDataFrameEqual(_canon(state), _canon(back.select(state.columns)))


def test_date_bits(spark):
    d = dt.date(2024, 1, 31)
    rows = [(1, [d], d), (2, [d - dt.timedelta(days=31)], d), (3, [d - dt.timedelta(days=x) for x in range(7, 14)], d)]
    df = spark.createDataFrame(rows, "user_id long, dates_active array<date>, date date")
    got = {r.user_id: r for r in cu.date_list_bits(df).collect()}
    assert got[1].datelist_int == 1 << 31 and got[1].l7 == 1 and got[1].weekly_active
    assert got[2].datelist_int == 1 and got[2].l32 == 1 and not got[2].weekly_active
    assert got[3].l7 == 0 and got[3].weekly_active_previous_week and got[3].l32 == 7


def test_first_last_ratio_zero_guard(spark):
    df = spark.createDataFrame([("p", [(1, 0), (2, 10)], 2)],
                               "player_name string, seasons array<struct<season:long,pts:long>>, current_season long")
    assert cu.first_last_ratio(df).first().ratio_most_recent_to_first == 10.0


def test_traffic_window_options(spark):
    import datetime as dt
    d0 = dt.datetime(2024, 1, 1, 12)
    # one url/referrer with traffic on days 0, 1 and 9: rows vs calendar frames differ
    ev = spark.createDataFrame([("/a", "https://www.pinterest.com/x", 1, d0),
                                ("/a", "https://www.pinterest.com/x", 1, d0 + dt.timedelta(days=1)),
                                ("/a", "https://www.pinterest.com/x", 1, d0 + dt.timedelta(days=9))],
                               "url string, referrer string, device_id long, event_time timestamp_ntz")
    dev = spark.createDataFrame([(1, "x")], "device_id long, os_type string")
    rows = {r.event_date.day: r for r in patterns.traffic_windows(ev, dev, min_total=0).collect()}
    assert rows[10].weekly_rolling_count == 3 and rows[10].referrer == "Twitter"     # LIKE '%t.co%' quirk
    cal = {r.event_date.day: r for r in patterns.traffic_windows(ev, dev, min_total=0, frame="range",
                                                                 referrer_match="host").collect()}
    assert cal[10].weekly_rolling_count == 1 and cal[10].previous_weekly_rolling_count == 2
    assert cal[10].referrer == "https://www.pinterest.com/x"                          # host match: no quirk


def test_events_enriched_dataframe_equals_sql(spark):
    from cairn.operators import events as ev
    e, d = td.web_events(spark, SF_SMALL), td.devices(spark, SF_SMALL)
    assertDataFrameEqual(ev.events_enriched(e, d), ev.events_enriched_sql(spark, e, d))


def test_rollups_from_one_cached_aggregate(spark):
    from cairn.operators import events as ev
    from cairn.plans.cache import cached
    counts = ev.user_device_counts(td.web_events(spark, SF_SMALL))
    with cached(counts) as c:
        per_user, per_device = ev.user_device_rollups(c, td.devices(spark, SF_SMALL))
        assert per_user.count() > 0 and per_device.count() > 0
        assert c.is_cached
    assert not counts.is_cached


def test_players_catch_up_continues_from_stored_max(spark):
    from cairn.session import scratch_path
    path = scratch_path(spark, "players")
    seasons = lambda y: td.player_seasons(spark, SF_SMALL, first=y, last=y)
    assert cu.players_catch_up(spark, path, seasons, 1996, first=1995, thresholds=PT) == [1995, 1996]
    assert cu.players_catch_up(spark, path, seasons, 1998, thresholds=PT) == [1997, 1998]
    assert cu.players_catch_up(spark, path, seasons, 1998, thresholds=PT) == []          # nothing left to do
    got = spark.read.parquet(path).where("current_season = 1998").withColumn(
        "current_season", F.col("current_season").cast("bigint"))      # partition values come back as int
    back = cu.players_backfill(td.player_seasons(spark, SF_SMALL), thresholds=PT).where("current_season = 1998")
    assertDataFrameEqual(_canon(got.select(back.columns)), _canon(back))


def test_actors_catch_up_equals_backfill(spark):
    from cairn.session import scratch_path
    path = scratch_path(spark, "actors")
    films = td.actor_films(spark, SF_SMALL)
    assert cu.actors_catch_up(spark, path, films, 1997, first=1995) == [1995, 1996, 1997]
    got = spark.read.parquet(path).where("current_year = 1997").withColumn(
        "current_year", F.col("current_year").cast("bigint"))
    back = cu.actors_backfill(films, as_of=1997)
    assertDataFrameEqual(_canon(got.select(back.columns)), _canon(back))


def test_scd_spells_are_disjoint_and_cover_all_periods(spark):
    import __spark_entry__ as E
    for name, key, start, end, cur in (("scd2_backfill", "player_name", "start_season", "end_season",
                                        "current_season"),
                                       ("actors_scd_backfill", "actorid", "start_year", "end_year", "current_year")):
        scd_df = E.queries()[name](spark, SF_SMALL)
        spells = {}
        for r in scd_df.collect():
            spells.setdefault(r[key], []).append((r[start], r[end], r[cur]))
        assert spells
        for k, ss in spells.items():
            ss.sort()
            assert all(s <= e for s, e, _ in ss)
            assert all(ss[i][1] + 1 == ss[i + 1][0] for i in range(len(ss) - 1)), (name, k, ss)   # no gap, no overlap
            assert ss[-1][1] == ss[-1][2]                                                            # open up to as-of


# ------------------------------------------------- step = backfill on uneven data

def test_players_backfill_equals_loop_when_attributes_change(spark):
    from cairn.operators import cumulative as cu
    rows = [("A", None, "US", 2000, 5, 10), ("A", "New", "CA", 2001, 6, 30), ("A", "Newer", "MX", 2003, 6, 12),
            ("B", "Col", "US", 2001, 1, 1)]
    df = spark.createDataFrame(rows, "player_name string, college string, country string, season long, gp long, pts long")
    for t in (2000, 2001, 2002, 2003):
        loop = cu.players_loop(spark, df, list(range(2000, t + 1)))
        back = cu.players_backfill(df, as_of=t).select(*loop.columns)
        assert sorted(map(str, loop.collect())) == sorted(map(str, back.collect()))
        whole = cu.players_backfill(df).where(F.col("current_season") == t).select(*loop.columns)
        assert sorted(map(str, whole.collect())) == sorted(map(str, loop.collect()))
    other = cu.players_backfill(df, stats=("gp",), metric="gp", as_of=2001)
    assert {r.player_name: r.scoring_class for r in other.collect()} == {"A": "bad", "B": "bad"}


def test_scd_forms_agree_over_a_missing_period(spark):
    from cairn.operators import scd
    rows = [("A", 1, "x"), ("A", 3, "x"), ("A", 4, "y"), ("B", 2, "x"), ("B", 3, "x")]
    df = spark.createDataFrame(rows, "k string, p long, c string")
    norm = lambda d: sorted((r.k, r.c, r.start_season, r.end_season) for r in d.collect())
    state = scd.scd2_backfill(df, "k", "p", ["c"], as_of=1)
    for t in (2, 3, 4):
        state = scd.scd2_incremental(state, df, "k", "p", ["c"], t)
        assert norm(state) == norm(scd.scd2_backfill(df, "k", "p", ["c"], as_of=t))
        replay = scd.scd2_replay(df, "k", "p", ["c"]).where(F.col("as_of_season") == t)
        assert norm(replay) == norm(state)
    assert ("A", "x", 1, 3) in norm(state) and ("A", "y", 4, 4) in norm(state)


def test_monthly_step_equals_backfill_over_missed_days_and_a_new_month(spark):
    import datetime as dt
    from cairn.operators import facts as fa
    daily = spark.createDataFrame(
        [(1, dt.date(2024, 1, 1), 3), (2, dt.date(2024, 1, 1), 4), (1, dt.date(2024, 1, 5), 7), (3, dt.date(2024, 1, 5), 1),
         (1, dt.date(2024, 2, 1), 9)], "user_id long, date date, hits long")
    norm = lambda d: sorted((r.user_id, str(r.month_start), list(r.hits)) for r in d.collect())
    first = fa.monthly_arrays(daily, ["user_id"], ["hits"], "2024-01-01")
    for fill in (0, None):
        step = fa.monthly_arrays_step(first, daily, ["user_id"], ["hits"], "2024-01-05", fill=fill)
        assert all(len(h) == 5 for _, _, h in norm(step))
        if fill == 0:
            assert norm(step) == norm(fa.monthly_arrays(daily.where("date < '2024-01-06'"), ["user_id"], ["hits"], "2024-01-05"))
    new_month = fa.monthly_arrays_step(step, daily, ["user_id"], ["hits"], "2024-02-01")
    assert norm(new_month) == [(1, "2024-02-01", [9])]
