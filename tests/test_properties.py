"""Property tests: distributed prefix sums and gap sessions against a brute-force pandas model."""

import datetime as dt

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cairn.operators import sequence

KEYS = st.one_of(st.none(), st.integers(0, 3))        # key None = a NULL key, which is a key like any other
ROWS = st.lists(st.tuples(KEYS, st.integers(0, 400), st.integers(0, 1)), min_size=1, max_size=120)
SIGNED = st.lists(st.tuples(KEYS, st.integers(0, 400), st.one_of(st.none(), st.integers(-5, 5))), min_size=1, max_size=120)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def _frame(spark, rows):
    # (key, time, value); time made unique within key by a row-number tiebreak column
    data = [(k, t, i, v) for i, (k, t, v) in enumerate(rows)]
    return spark.createDataFrame(data, "k long, t long, i long, v long")


@SETTINGS
@given(rows=SIGNED, parts=st.integers(1, 7), width=st.integers(1, 10))
def test_rolling_sum_matches_brute_force(spark, rows, parts, width):
    df = _frame(spark, rows)
    got = {(r.k, r.t, r.i): r.w for r in
           sequence.rolling_sum(df, "k", ["t", "i"], "v", width, out="w", partitions=parts).collect()}
    pdf = pd.DataFrame([(k, t, i, v or 0) for i, (k, t, v) in enumerate(rows)], columns=["k", "t", "i", "v"])
    pdf["k"] = pdf["k"].astype("float").fillna(-1)
    pdf = pdf.sort_values(["k", "t", "i"])
    pdf["w"] = pdf.groupby("k")["v"].transform(lambda s: s.rolling(width, min_periods=1).sum()).astype(int)
    want = {(None if r.k == -1 else int(r.k), r.t, r.i): r.w for r in pdf.itertuples()}
    assert got == want


@SETTINGS
@given(rows=ROWS, parts=st.integers(1, 7))
def test_longest_run_matches_brute_force(spark, rows, parts):
    df = _frame(spark, rows).withColumn("f", F.col("v") == 1)
    got = {r.k: r.longest_streak for r in
           sequence.longest_run(df, "k", ["t", "i"], "f", partitions=parts).collect()}
    pdf = pd.DataFrame([(k, t, i, v) for i, (k, t, v) in enumerate(rows)], columns=["k", "t", "i", "v"])
    pdf["k"] = pdf["k"].astype("float").fillna(-1)
    want = {}
    for k, g in pdf.sort_values(["k", "t", "i"]).groupby("k"):
        k = None if k == -1 else int(k)
        best = cur = 0
        for v in g["v"]:
            cur = cur + 1 if v == 1 else 0
            best = max(best, cur)
        want[k] = best
    assert got == want


@SETTINGS
@given(rows=ROWS, parts=st.integers(1, 7), gap=st.integers(1, 60))
def test_sessions_match_brute_force(spark, rows, parts, gap):
    t0 = dt.datetime(2024, 1, 1)
    data = [(None if k is None else str(k), t0 + dt.timedelta(seconds=t)) for k, t, _ in rows]
    df = spark.createDataFrame(data, "ip string, ts timestamp_ntz")
    got = sorted((r.ip or "", r.session_start, r.num_events) for r in
                 sequence.sessions_by_gap(df, ["ip"], "ts", gap, partitions=parts).collect())
    want = []
    pdf = pd.DataFrame(data, columns=["ip", "ts"])
    pdf["ip"] = pdf["ip"].fillna("")
    for ip, g in pdf.sort_values(["ip", "ts"]).groupby("ip"):
        start, prev, n = None, None, 0
        for ts in g["ts"]:
            if prev is not None and (ts - prev).total_seconds() > gap:
                want.append((ip, start, n))
                start, n = None, 0
            start = ts if start is None else start
            prev, n = ts, n + 1
        want.append((ip, start, n))
    assert got == sorted((ip, s.to_pydatetime(), n) for ip, s, n in want)


def test_big_keys_beside_a_null_key(spark):
    big = 2 ** 53 + 1
    df = spark.createDataFrame([(big, 1, -1), (None, 1, -1), (big, 2, None), (None, 2, 5)], "k long, t long, v long")
    got = {(r.k, r.t): (r.pos, r.cum_v) for r in sequence.running_totals(df, "k", ["t"], ["v"], partitions=3).collect()}
    assert got == {(big, 1): (1, -1), (big, 2): (2, -1), (None, 1): (1, -1), (None, 2): (2, 4)}


def test_sessions_leave_out_null_times(spark):
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", t0), ("a", None), ("a", t0 + dt.timedelta(seconds=5)), ("b", None)], "ip string, ts timestamp_ntz")
    assert [(r.ip, r.num_events) for r in sequence.sessions_by_gap(df, ["ip"], "ts", 60, partitions=2).collect()] == [("a", 2)]
