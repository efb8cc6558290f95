"""The reference's own unit tests, re-expressed against our operators."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from cairn.operators import facts, graph, scd


def test_scd_generation(spark):
    src = spark.createDataFrame(
        [("Michael Jordan", 2001, "Good"), ("Michael Jordan", 2002, "Good"), ("Michael Jordan", 2003, "Bad"),
         ("Someone Else", 2003, "Bad")], "player_name string, current_season long, scoring_class string")
    out = scd.scd2_backfill(src, "player_name", "current_season", ["scoring_class"], start="start_date",
                            end="end_date", current=None)
    expected = spark.createDataFrame(
        [("Michael Jordan", "Good", 2001, 2002), ("Michael Jordan", "Bad", 2003, 2003),
         ("Someone Else", "Bad", 2003, 2003)],
        "player_name string, scoring_class string, start_date long, end_date long")
    assertDataFrameEqual(out, expected)


def test_monthly_site_hits(spark):
    ds = "2023-03-01"
    rows = [(ds, [0, 1, 3], ds), (ds, [1, 2, 3], ds), ("2023-04-01", [], ds), ("2023-04-01", [], "")]
    src = spark.createDataFrame(rows, "month_start string, hit_array array<long>, date_partition string")
    out = facts.first_positions(src.where(F.col("date_partition") == ds), ["month_start"], "hit_array")
    expected = spark.createDataFrame([(ds, 1, 3, 6), ("2023-04-01", 0, 0, 0)],
                                     "month_start string, num_hits_first_day long, num_hits_second_day long, "
                                     "num_hits_third_day long")
    assertDataFrameEqual(out, expected)


def test_team_vertex_dedupe(spark):
    teams = spark.createDataFrame(
        [(1, "GSW", "Warriors", "San Francisco", "Chase Center", 1900),
         (1, "GSW", "Bad Warriors", "San Francisco", "Chase Center", 1900)],
        "team_id long, abbreviation string, nickname string, city string, arena string, yearfounded long")
    out = graph.team_vertices(teams).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.identifier, r.type) == (1, "team")
    assert r.properties == {"abbreviation": "GSW", "nickname": "Warriors", "city": "San Francisco",
                            "arena": "Chase Center", "year_founded": "1900"}


def test_month_arrays_handle_empty_and_missing_days(spark):
    daily = spark.createDataFrame([(1, dt.date(2023, 3, 1), 2), (1, dt.date(2023, 3, 3), 5),
                                   (2, dt.date(2023, 3, 3), 1)], "user_id long, date date, hits long")
    zero = {r.user_id: r.hits for r in facts.monthly_arrays(daily, ["user_id"], ["hits"], "2023-03-03").collect()}
    assert zero == {1: [2, 0, 5], 2: [0, 0, 1]}
    nul = {r.user_id: (r.hits, r.first_found_date) for r in
           facts.monthly_arrays(daily, ["user_id"], ["hits"], "2023-03-03", fill=None, first_found=True).collect()}
    assert nul == {1: ([2, None, 5], dt.date(2023, 3, 1)), 2: ([None, None, 1], dt.date(2023, 3, 3))}
