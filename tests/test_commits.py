"""Two outputs of one stream: committed together, judged late as a watermark does, replayable."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from cairn.operators import experiments as ex
from cairn.plans import queries as q
from cairn.session import scratch_path
from cairn.streaming import commits, sinks, sources, windows

T0 = dt.datetime(2024, 1, 1)
KEYS = {"user": ["user_id"], "both": ["user_id", "event_type"]}


def _schema(keys):
    return f"event_hour timestamp, {', '.join(f'{k} {'long' if k == 'user_id' else 'string'}' for k in keys)}, num_hits long"


def _struct(spark, keys):
    return spark.createDataFrame([], _schema(keys)).schema


def _store(spark):
    store = commits.BatchStore(spark, scratch_path(spark, "t-batches"))
    made = {n: commits.partial_counts(k, ts="event_timestamp", count_col="event_type") for n, k in KEYS.items()}
    return store, made


def _write(spark, path, rows):
    spark.createDataFrame(rows, sources.EVENTS_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def _event(i, minutes, user=1, kind="view"):
    t = None if minutes is None else T0 + dt.timedelta(minutes=minutes)
    return (i, t, user, kind, 1.0, '{"k": 1}')


def _run(spark, src, store, made, ckpt):
    s = windows.event_time(spark.readStream.schema(sources.EVENTS_SCHEMA).option("maxFilesPerTrigger", "1").parquet(src), "ts")
    sink = store.writer(made, ts="event_timestamp", window_seconds=300, delay_seconds=15)
    sinks.run_available_now(s, sink, ckpt)


def _totals(spark, store):
    return {n: {tuple(r) for r in commits.added_up(k)(store.read(n, _struct(spark, k))).collect()} for n, k in KEYS.items()}


def test_dies_between_two_outputs_and_is_replayed(spark, tmp_path):
    src, ckpt = str(tmp_path / "in"), scratch_path(spark, "t-ck")
    _write(spark, src, [_event(i, i % 13, i % 3, "view" if i % 2 else "buy") for i in range(100)])
    store, made = _store(spark)

    def lost(rows):
        raise RuntimeError("executor lost")
    with pytest.raises(Exception, match="executor lost"):
        _run(spark, src, store, {"user": made["user"], "both": lost}, ckpt)
    assert store.batches() == [] and _totals(spark, store) == {"user": set(), "both": set()}     # half a batch is not seen
    _run(spark, src, store, made, ckpt)
    got = _totals(spark, store)
    assert sum(r[-1] for r in got["user"]) == sum(r[-1] for r in got["both"]) == 100
    write = store.writer(made, ts="event_timestamp", window_seconds=300, delay_seconds=15)
    write(windows.event_time(spark.read.schema(sources.EVENTS_SCHEMA).parquet(src), "ts"), 0)  # replay of a committed batch
    assert _totals(spark, store) == got


def test_late_rows_are_judged_against_earlier_batches(spark, tmp_path):
    rng, src, arrivals = random.Random(2), str(tmp_path / "in"), []
    for b in range(6):
        rows = [_event(100 * b + i, b * 10 + rng.choice([-25, -9, -4, -0.2, 0, 1, 3, 9]) + rng.random(), rng.randint(0, 2)) for i in range(60)]
        arrivals.append([*rows, _event(100 * b + 99, b * 10 + 9.99), _event(100 * b + 98, 10 * b - 5)])       # the last on a window's edge
        _write(spark, src, arrivals[-1])
    store, made = _store(spark)
    _run(spark, src, store, made, scratch_path(spark, "t-ck"))
    top, counts, audit = None, {}, []
    for b, rows in enumerate(arrivals):
        edge = top and top - dt.timedelta(seconds=15)
        told = [b, 0, 0, 0]
        for _, t, user, *_ in rows:
            start = T0 + (t - T0) // dt.timedelta(minutes=5) * dt.timedelta(minutes=5)
            state = 3 if edge and start + dt.timedelta(minutes=5) <= edge else 2 if edge and t < edge else 1
            told[state] += 1
            if state < 3:
                counts[start, user] = counts.get((start, user), 0) + 1
        top = max([t for _, t, *_ in rows] + ([top] if top else []))
        audit.append(tuple(told))
    rows = commits.added_up(["user_id"])(store.read("user", _struct(spark, KEYS["user"])))
    got = {(r.t, r.user_id): r.num_hits for r in rows.select(F.col("event_hour").cast("timestamp_ntz").alias("t"), "user_id", "num_hits").collect()}
    assert got == counts
    assert [(r.batch, r.in_time, r.late, r.dropped) for r in store.audit().orderBy("batch").collect()] == audit
    assert sum(a[2] for a in audit) > 0 and sum(a[3] for a in audit) > 0
    dropped = spark.read.schema(sources.EVENTS_SCHEMA).parquet(*[f"{store.path}/out/{commits.LATE}/n={b}" for b in store.batches()])
    assert dropped.count() == sum(a[3] for a in audit)


def test_compaction_keeps_the_result_and_later_batches(spark, tmp_path):
    src, ckpt = str(tmp_path / "in"), scratch_path(spark, "t-ck")
    store, made = _store(spark)
    for b in range(3):
        _write(spark, src, [_event(100 * b + i, 10 * b + i % 9, i % 2) for i in range(30)])
    _run(spark, src, store, made, ckpt)
    before = _totals(spark, store)
    assert store.compact("user", _struct(spark, KEYS["user"]), commits.added_up(KEYS["user"])) == 2
    assert store.compact("user", _struct(spark, KEYS["user"]), commits.added_up(KEYS["user"])) == 2
    assert _totals(spark, store) == before
    paths = store.read("user", _struct(spark, KEYS["user"])).inputFiles()
    assert paths and all("/compact/" in p for p in paths)
    _write(spark, src, [_event(999, 31)])
    _run(spark, src, store, made, ckpt)
    assert sum(r[-1] for r in _totals(spark, store)["user"]) == 91


def test_rows_without_a_time_and_no_rows(spark, tmp_path):
    src = str(tmp_path / "in")
    _write(spark, src, [_event(1, None), _event(2, 1)])
    store, made = _store(spark)
    _run(spark, src, store, made, scratch_path(spark, "t-ck"))
    assert [(r.in_time, r.late, r.dropped) for r in store.audit().collect()] == [(1, 0, 1)]
    write = store.writer(made, ts="event_timestamp", window_seconds=300, delay_seconds=15)
    empty = windows.event_time(spark.createDataFrame([], sources.EVENTS_SCHEMA), "ts")
    write(empty, 1)
    assert store.batches() == [0, 1] and store.audit().where("batch = 1").first().bound_us is not None


# ---- metrics of an experiment ---------------------------------------------------------------------

def test_mean_and_ratio_metrics_against_plain_formulas(spark):
    rng = random.Random(4)
    users = [(u, "control" if u % 3 else "test") for u in range(400)]
    facts = {u: (rng.randint(0, 9), rng.randint(1, 20)) for u, _ in users if rng.random() < 0.9}
    per = spark.createDataFrame([(u, *v) for u, v in facts.items()], "user_id long, x long, y long")
    assigned = spark.createDataFrame(users, "user_id long, cell string")
    moments = ex.cell_moments(assigned, per, [("mean", "leading", "x", None), ("rate", "lagging", "x", "y")])
    got = {(r.metric, r.cell): r for r in ex.metric_readout(moments).collect()}

    def stats(metric, cell):
        xy = [facts.get(u, (0, 0)) for u, c in users if c == cell]
        n, r = len(xy), sum(x for x, _ in xy) / (len(xy) if metric == "mean" else sum(y for _, y in xy))
        my = 1 if metric == "mean" else sum(y for _, y in xy) / n
        lin = [(x - r * (1 if metric == "mean" else y)) / my for x, y in xy]
        return n, r, sum(v * v for v in lin) / (n - 1) / n
    for metric in ("mean", "rate"):
        (n, v, e), (cn, cv, ce) = stats(metric, "test"), stats(metric, "control")
        r = got[metric, "test"]
        assert (r.users, r.value, r.std_error, r.difference) == (n, round(v, 6), round(math.sqrt(e), 6), round(v - cv, 6))
        assert abs(r.t_score - (v - cv) / math.sqrt(e + ce)) < 1e-4
        assert abs(r.degrees - (e + ce) ** 2 / (e * e / (n - 1) + ce * ce / (cn - 1))) < 1e-2
        assert got[metric, "control"].t_score is None
    halves = ex.merged_moments(ex.cell_moments(assigned.where("user_id < 150"), per, [("mean", "leading", "x", None)])
                               .unionByName(ex.cell_moments(assigned.where("user_id >= 150"), per, [("mean", "leading", "x", None)])))
    whole = moments.where("metric = 'mean'")
    assert halves.exceptAll(whole.select(*halves.columns)).isEmpty()


def test_metrics_of_tiny_cells(spark):
    assigned = spark.createDataFrame([(1, "control"), (2, "test")], "user_id long, cell string")
    per = spark.createDataFrame([(1, 0, 0)], "user_id long, x long, y long")
    out = ex.metric_readout(ex.cell_moments(assigned, per, [("rate", "lagging", "x", "y"), ("mean", "leading", "x", None)])).collect()
    assert len(out) == 4 and all(r.t_score is None and r.std_error is None for r in out)


def test_audit_adds_up_to_the_input(spark):
    from tests.conftest import SF_SMALL
    rows = q.QUERIES["stream_late_audit"](spark, SF_SMALL).collect()
    assert sum(r.in_time + r.late + r.dropped for r in rows) == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    assert sum(r.dropped for r in rows) > 0
