"""Upsert by key: one join decides, untouched buckets stay, replays change nothing."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cairn.operators import uniques
from cairn.session import scratch_path
from cairn.sinks.keyed import VERSION, KeyedTable

SCHEMA = "k long, name string, n long"


def table(spark, rows, buckets=8, key=("k",)):
    t = KeyedTable(spark, scratch_path(spark, "t-keyed"), key, buckets)
    t.create(spark.createDataFrame(rows, SCHEMA))
    return t


def told(df):
    return {(r.k, r.name): (r.n, r[VERSION]) for r in df.collect()}


def files(t):
    return {r.path for r in t.spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet").load(f"{t.path}/data").select("path").collect()}


def folders(t):
    return {r.bucket: r.folder for r in t.manifest().collect()}


def test_insert_update_keep_delete_against_a_dict(spark):
    rng = random.Random(1)
    model = {k: (f"n{k}", k) for k in range(200)}
    t = table(spark, [(k, *v) for k, v in model.items()])
    versions = {k: 1 for k in model}
    for step in range(2, 6):
        change = {rng.randint(0, 260): (rng.choice(["a", None, "n7"]), rng.choice([1, None])) for _ in range(rng.choice([1, 3, 40]))}
        dead = {k for k in change if rng.random() < 0.3}
        rows = [(k, *v, k in dead) for k, v in change.items()]
        df = spark.createDataFrame(rows, SCHEMA + ", gone boolean")
        assert t.merge(df, delete=F.col("gone")) == step
        for k, v in change.items():
            if k in dead:
                model.pop(k, None), versions.pop(k, None)
            elif model.get(k) != v:
                model[k], versions[k] = v, step
        got = {r.k: ((r.name, r.n), r[VERSION]) for r in t.read().collect()}
        assert got == {k: (v, versions[k]) for k, v in model.items()}
    assert t.read(1).count() == 200                                      # older versions stay readable
    assert {r.k for r in t.changes_since(3).collect()} == {k for k, v in versions.items() if v > 3}


def test_untouched_buckets_are_not_rewritten(spark):
    t = table(spark, [(k, "x", k) for k in range(500)])
    before, were = files(t), folders(t)
    t.merge(spark.createDataFrame([(7, "new", 1)], SCHEMA), "m1")
    now = folders(t)
    assert before <= files(t)
    assert sum(now[b] != were[b] for b in now) == 1
    assert told(t.read())[7, "new"] == (1, 2) and t.read().count() == 500


def test_replay_and_equal_rows_change_nothing(spark):
    t = table(spark, [(k, "x", k) for k in range(50)])
    change = spark.createDataFrame([(7, "new", 1), (60, "in", 2)], SCHEMA)
    assert t.merge(change, "m1") == 2 and t.merge(change, "m1") == 2     # a replayed batch
    rows, were = told(t.read()), folders(t)
    assert t.merge(change, "m2") == 3                                    # other id, same rows
    assert told(t.read()) == rows and folders(t) == were
    assert t.changes_since(2).count() == 0


def test_merge_that_dies_before_its_commit_leaves_the_table(spark, monkeypatch):
    t = table(spark, [(k, "x", k) for k in range(50)])
    change = spark.createDataFrame([(7, "new", 1)], SCHEMA)
    monkeypatch.setattr(KeyedTable, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        t.merge(change, "m1")
    monkeypatch.undo()
    assert t.version() == 1 and (7, "x") in told(t.read())
    assert t.merge(change, "m1") == 2 and told(t.read())[7, "new"] == (1, 2)
    assert len(t.vacuum()) == 1 and t.read().count() == 50


def test_repeated_and_null_keys_and_empty_changes(spark):
    t = table(spark, [(1, "a", 1), (1, "b", 0), (None, "null", 1), (2, "c", 1)])
    assert set(told(t.read())) == {(1, "b"), (None, "null"), (2, "c")}
    t.merge(spark.createDataFrame([(None, "null again", 5), (3, "x", 1), (3, "x", 9)], SCHEMA), prefer=["n"])
    assert told(t.read()) == {(1, "b"): (0, 1), (None, "null again"): (5, 2), (3, "x"): (9, 2), (2, "c"): (1, 1)}
    assert t.merge(spark.createDataFrame([], SCHEMA)) == 3 and t.read().count() == 4
    empty = table(spark, [])
    assert empty.read().count() == 0 and empty.merge(spark.createDataFrame([(1, "a", 1)], SCHEMA)) == 2
    assert told(empty.read()) == {(1, "a"): (1, 2)}


def test_two_writers(spark, monkeypatch):
    t = table(spark, [(1, "a", 1)])
    change = spark.createDataFrame([(1, "b", 1)], SCHEMA)
    real = KeyedTable._write

    def slow(self, rows, folder):
        real(self, rows, folder)
        monkeypatch.undo()
        t.merge(spark.createDataFrame([(2, "other", 1)], SCHEMA), "other")
    monkeypatch.setattr(KeyedTable, "_write", slow)
    with pytest.raises(RuntimeError, match="another writer"):
        t.merge(change, "mine")
    assert set(told(t.read())) == {(1, "a"), (2, "other")}


def test_merge_deals_each_side_once(spark):
    from cairn.plans.joins import count_exchanges
    t = table(spark, [(k, "x", k) for k in range(50)])
    told_ = spark.createDataFrame([(1, "b", 1)], SCHEMA).select("*", F.lit(False).alias("_gone"), t._bucket().alias("_bucket"))
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = t._merged(t.read().withColumn("_bucket", t._bucket()), told_, ["k", "name", "n"], 2, 4)
        assert count_exchanges(plan) == 2
    finally:
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))


# ---- distinct users -----------------------------------------------------------------------------

def visits(spark):
    rng = random.Random(3)
    t0 = dt.datetime(2024, 2, 20)
    data = [(rng.choice(["a", "b", None]), rng.choice([None, 0, 5, 32_767, 32_768, 32_769, -1, -40_000, 10**12, rng.randint(0, 99_999)]),
             t0 + dt.timedelta(hours=rng.randint(0, 24 * 20))) for _ in range(3000)]
    return spark.createDataFrame(data, "host string, user_id long, t timestamp_ntz"), data


def test_bitmaps_of_any_span_equal_distinct_counts(spark):
    df, data = visits(spark)
    days = uniques.daily_bitmaps(df, ["host"], "user_id", "t")
    got = {(r.host, r.span, r.span_start): r.unique_users for r in uniques.distinct_by_span(days, ["host"], 3).collect()}
    seen, last = {}, max(t.date() for _, u, t in data if u is not None)
    for host, user, t in data:
        if user is None:
            continue
        d = t.date()
        keys = [("day", d), ("week", d - dt.timedelta(days=d.weekday())), ("month", d.replace(day=1))]
        keys += [("rolling_3", d - dt.timedelta(days=i)) for i in range(3) if d - dt.timedelta(days=i) <= last - dt.timedelta(days=2)]
        for k in keys:
            seen.setdefault((host, *k), set()).add(user)
    assert got == {k: len(v) for k, v in seen.items()}


def test_sketches_merge_and_stay_within_their_bound(spark):
    df = spark.range(200_000).select(F.lit("h").alias("host"), (F.col("id") % 60_000).alias("user_id"),
                                     (F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_interval(days=(F.col("id") % 9).cast("int"))).alias("t"))
    days = uniques.daily_sketches(df, ["host"], "user_id", "t")
    assert days.count() == 9
    r = uniques.estimated_in(days, ["host"]).select(uniques.within_bound(F.col("estimated_users"), F.lit(60_000)).alias("ok"),
                                                    uniques.within_bound(F.col("estimated_users"), F.lit(90_000)).alias("far")).first()
    assert r.ok and not r.far
