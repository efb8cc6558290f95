"""Physical-plan assertions: pushdown, pruning, shuffle counts, bucketing."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from cairn.operators import core, sequence
from cairn.plans.joins import count_exchanges, plan_text
from cairn.sources import testdata as td
from tests.conftest import SF_SMALL


def test_day_filter_reaches_scan(spark):
    from cairn.plans.queries import day_range
    df = td.web_events(spark, SF_SMALL).where(day_range("event_time", "2024-01-15")).select("user_id")
    txt = plan_text(df)
    assert "PushedFilters" in txt and "GreaterThanOrEqual(ts" in txt
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in txt


def test_dedupe_is_one_partial_aggregate(spark):
    gd = td.game_details(spark, SF_SMALL)
    d = core.dedupe(gd, ["game_id", "team_id", "player_id"])
    txt = plan_text(d)
    assert "Window" not in txt
    assert "partial_max" in txt


def test_scd_backfill_single_shuffle_on_key(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("k"), F.col("id").alias("p"),
                                  (F.col("id") % 3).alias("c"))
    from cairn.operators import scd
    out = scd.scd2_backfill(df, "k", "p", ["c"], current=None)
    assert count_exchanges(out) == 1


@pytest.mark.parametrize("name", ["match_avg_kills", "stream_geo_enrich", "events_enriched", "fct_game_details",
                                  "growth_accounting"])
def test_no_size_probe_while_planning(spark, name):
    """Building a plan starts no job that counts a join side (streams run their batches)."""
    for t in td.TABLES:
        td.table(spark, SF_SMALL, t)                       # footers are read once a session
    group = f"plan-{name}"
    spark.sparkContext.setJobGroup(group, group)
    E.queries()[name](spark, SF_SMALL)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setJobGroup("", "")
    assert len(jobs) == 0 or name.startswith("stream_")


def test_bucketed_join_has_no_exchange(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = E.queries()["match_joined"](spark, SF_SMALL)
        txt = df._jdf.queryExecution().executedPlan().toString()
        scans = txt.count("SelectedBucketsCount")
        assert scans >= 3
        assert "Exchange hashpartitioning(match_id" not in txt
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))


def test_bucket_pruning_on_filter(spark):
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        df = E.queries()["bucket_filter_avg"](spark, SF_SMALL)
        assert "SelectedBucketsCount: 1 out of 16" in plan_text(df)
    finally:
        spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "true")


def test_running_totals_split_hot_key(spark):
    # one key holds every row: positions and sums must still be exact across partitions
    df = spark.range(5000).select(F.lit(1).alias("k"), F.col("id").alias("t"), (F.col("id") % 2).alias("v"))
    rt = sequence.running_totals(df, "k", ["t"], ["v"], partitions=8)
    got = {r.t: (r.pos, r.cum_v) for r in rt.collect()}
    assert got[0] == (1, 0) and got[4999] == (5000, 2500) and got[2500] == (2501, 1250)


def test_rolling_and_streak_match_window(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"),
                                  (F.hash("id") % 2 == 0).cast("long").alias("v"))
    r = sequence.rolling_sum(df, "k", ["t"], "v", 90, out="w", partitions=6)
    from pyspark.sql import Window
    w = Window.partitionBy("k").orderBy("t").rowsBetween(-89, 0)
    ref = df.withColumn("w", F.sum("v").over(w))
    assert r.select("k", "t", "w").exceptAll(ref.select("k", "t", "w")).count() == 0
    streak = sequence.longest_run(df.withColumn("f", F.col("v") == 1), "k", ["t"], "f", partitions=6)
    assert streak.count() == 3


def test_rolling_sum_over_ranges_shorter_than_its_width(spark):
    """A hot key over 40 ranges of about 10 rows: a sum of 60 rows needs the rows of several ranges before its own."""
    from pyspark.sql import Window
    df = spark.range(400).select(F.when(F.col("id") % 10 > 0, "hot").alias("k"), F.col("id").alias("t"),
                                 F.when(F.col("id") % 7 > 0, F.hash("id") % 9).cast("long").alias("v"))
    w = Window.partitionBy("k").orderBy("t")
    want = df.withColumns({"pos": F.row_number().over(w).cast("long"), "w": F.sum(F.coalesce("v", F.lit(0))).over(w.rowsBetween(-59, 0))})
    got = sequence.rolling_sum(df, "k", ["t"], "v", 60, out="w", partitions=40)
    assert got.schema.names == ["k", "t", "v", "pos", "w"] and got.count() == 400
    assert got.exceptAll(want).count() == 0
    assert sequence.rolling_sum(df.limit(0), "k", ["t"], "v", 60, out="w").count() == 0
    alone = sequence.rolling_sum(df, "k", ["t"], "v", 1, out="w", partitions=40)
    assert alone.where("w <> coalesce(v, 0)").count() == 0


def test_rolling_sum_joins_rows_with_broadcasts_only(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"), F.col("id").alias("v"))
    plan = sequence.rolling_sum(df, "k", ["t"], "v", 90, out="w", partitions=6)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan and plan.count("BroadcastHashJoin") == 2


def test_sessions_by_gap_equals_session_window_on_hot_key(spark):
    import datetime as dt
    from cairn.streaming import windows
    off = F.col("id") * 200 + F.when(F.col("id") % 5 == 0, 150).otherwise(0) + \
        F.when(F.col("id") % 7 == 0, 100).otherwise(0)          # gaps of 350 s, 300 s (no split) and less
    df = spark.range(6000).select(
        F.when(F.col("id") < 5500, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 3).cast("string"))).alias("ip"),
        F.lit("h").alias("host"),
        (F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_interval(secs=off.cast("double"))).alias("t"))

    def norm(x):
        return x.select("ip", "host", F.col("session_start").cast("timestamp_ntz").alias("s"),
                        F.col("session_end").cast("timestamp_ntz").alias("e"), "num_events")
    a = norm(sequence.sessions_by_gap(df, ["ip", "host"], "t", 300, partitions=5))
    b = norm(windows.sessions(windows.event_time(df, "t"), ["ip", "host"]))
    assert a.count() == b.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_daily_step_reads_only_its_day(spark):
    df = E.queries()["array_metrics_step"](spark, SF_SMALL)
    txt = plan_text(df)
    assert "GreaterThanOrEqual(ts,2024-01-30T00:00)" in txt and "LessThan(ts,2024-01-31T00:00)" in txt


def test_yearly_step_reads_only_its_year(spark):
    txt = plan_text(E.queries()["cumulative_entity_step"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(o_orderdate,1998-01-01T00:00)" in txt


def test_bucketed_write_has_one_file_per_bucket(spark, tmp_path):
    from cairn.operators.matches import write_bucketed
    path = str(tmp_path / "b")
    write_bucketed(spark.range(5000).repartition(12).withColumnRenamed("id", "match_id"), "t_bucket_files", path)
    assert 1 <= spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).count() <= 16


def test_global_rank(spark):
    df = spark.range(2000).select((F.col("id") % 7).alias("a"), "id").repartition(5)
    got = sequence.global_rank(df, [F.col("a").desc(), F.col("id")]).collect()
    want = sorted(((i % 7, i) for i in range(2000)), key=lambda x: (-x[0], x[1]))
    assert [(r.a, r.id) for r in sorted(got, key=lambda r: r["rank"])] == want
    assert sorted(r["rank"] for r in got) == list(range(1, 2001))


def test_running_totals_without_exchange_reuse(spark):
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        df = spark.range(6000).select(F.lit(1).alias("k"), F.col("id").alias("t"), (F.col("id") % 2).alias("v"))
        rt = sequence.running_totals(df.repartition(5), "k", ["t"], ["v"], partitions=6)
        bad = rt.where((F.col("pos") != F.col("t") + 1) | (F.col("cum_v") != F.floor((F.col("t") + 1) / 2)))
        assert bad.count() == 0
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")


@pytest.mark.parametrize("block", [1, 2, 3])
def test_pairs_block_by_block_are_exact(spark, block):
    from cairn.operators import facts, graph
    dd = facts.dedupe_game_details(td.game_details(spark, SF_SMALL))
    plain, cut = graph.player_pair_stats(dd), graph.player_pair_stats(dd, block=block)
    assert plain.count() > 0
    assert plain.exceptAll(cut).count() == 0 and cut.exceptAll(plain).count() == 0


def test_large_game_is_spread_and_small_games_are_not_repeated(spark):
    from cairn.operators import graph
    big = spark.range(20_000).select(F.lit(1).cast("long").alias("game_id"), F.col("id").alias("player_id"))
    small = spark.range(30_000).select((F.col("id") / 10 + 2).cast("long").alias("game_id"), F.col("id").alias("player_id"))
    side = big.unionByName(small)
    low, high = graph.pair_cells(side, 1000)
    for cells in (low, high):
        sizes = cells.groupBy("game_id", "i", "j").count()
        assert sizes.where("game_id = 1").count() == 20 * 21 // 2
        assert sizes.agg(F.max("count")).first()[0] <= 1200              # 1000 a block, dealt by a hash
        assert cells.where("game_id <> 1").count() == 30_000


def test_pairs_without_players_in_common(spark):
    from cairn.operators import graph
    none = spark.createDataFrame([], "game_id long, player_id long, player_name string, team_abbreviation string, pts long")
    assert graph.player_pair_stats(none).count() == 0


def test_players_of_one_name_make_pairs(spark):
    from cairn.operators import graph
    dd = spark.createDataFrame([(1, 1, "A", "x", 1), (1, 2, "A", "x", 2), (1, 3, "B", "y", 3)],
                               "game_id long, player_id long, player_name string, team_abbreviation string, pts long")
    assert graph.player_pair_stats(dd).count() == 3


def test_bucket_of_matches_writer_buckets(spark):
    from cairn.functions.hashing import bucket_of
    from cairn.operators.matches import write_bucketed
    from cairn.session import scratch_path
    scores = td.match_scores(spark, SF_SMALL)
    name = "t_bucket_check_" + scratch_path(spark, "x")[-6:]
    write_bucketed(scores, name, scratch_path(spark, "bucket-check"), buckets=16)
    got = (spark.table(name)
           .select(F.regexp_extract(F.input_file_name(), r"_(\d{5})\.c000", 1).cast("int").alias("file_bucket"),
                   bucket_of(F.col("match_id"), 16).alias("computed")))
    assert got.where(F.col("file_bucket") != F.col("computed")).count() == 0
    assert got.select("file_bucket").distinct().count() > 1


def test_matchups_compute_the_details_once_and_read_a_vertex_once(spark):
    df = E.queries()["graph_matchups"](spark, SF_SMALL)
    assert not [f for f in df.inputFiles() if "lineitem" in f]
    above_join = df._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    assert "get_json_object" not in above_join
    text = "identifier string, type string, properties string"
    v = spark.createDataFrame([("1", "player", '{"player_name":"a","number_of_games":3,"total_points":0}')], text)
    e = spark.createDataFrame([("1", "player", "2", "player", '{"num_games":2,"subject_points":null,"object_points":4}')],
                              "subject_identifier string, subject_type string, object_identifier string, object_type string, properties string")
    from cairn.operators import graph
    assert [tuple(r) for r in graph.matchups(v, e).collect()] == [("a", "2", 3.0, None, "2")]
