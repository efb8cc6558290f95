"""Streaming: batch = stream, late rows dropped after the watermark, session gaps."""

import datetime as dt

from pyspark.sql import functions as F

from cairn.session import scratch_path
from cairn.streaming import sinks, sources, windows


def _write_events(spark, path, rows):
    df = spark.createDataFrame(rows, sources.EVENTS_SCHEMA)
    df.coalesce(1).write.mode("append").parquet(path)


def _ev(i, t, user=1, kind="view"):
    return (i, t, user, kind, 1.0, '{"k": 1}')


def test_late_row_does_not_reopen_window(spark, tmp_path):
    src = str(tmp_path / "in")
    out = scratch_path(spark, "t-out")
    ck = scratch_path(spark, "t-ck")
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    _write_events(spark, src, [_ev(1, t0), _ev(2, t0 + dt.timedelta(minutes=11))])

    def run():
        s = windows.event_time(spark.readStream.schema(sources.EVENTS_SCHEMA).parquet(src), "ts")
        agg = windows.tumbling_counts(s, ["user_id"], count_col="event_type")
        sinks.run_available_now(agg, sinks.parquet_batch_writer(out), ck, mode="update")
    run()
    # a row for the first window arrives after the watermark has passed it
    _write_events(spark, src, [_ev(3, t0 + dt.timedelta(minutes=1))])
    run()
    res = {r.event_hour: r.num_hits for r in sinks.latest_by_key(spark, out, ["event_hour", "user_id"]).collect()}
    assert res[min(res)] == 1


def test_session_gap_boundaries(spark):
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    rows = [_ev(1, t0), _ev(2, t0 + dt.timedelta(minutes=4, seconds=59)),
            _ev(3, t0 + dt.timedelta(minutes=10)), _ev(4, t0 + dt.timedelta(minutes=20, seconds=1)),
            _ev(5, t0 + dt.timedelta(minutes=25, seconds=1))]
    df = windows.event_time(spark.createDataFrame(rows, sources.EVENTS_SCHEMA), "ts")
    s = windows.sessions(df, ["user_id"]).orderBy("session_start").collect()
    assert [r.num_events for r in s] == [2, 1, 2]   # exactly 5 minutes apart stays one session


def test_stream_equals_batch(spark):
    from cairn.plans.queries import QUERIES
    from cairn.sources import testdata as td
    from tests.conftest import SF_SMALL
    streamed = QUERIES["stream_tumbling_host"](spark, SF_SMALL)
    e = windows.event_time(td.web_events(spark, SF_SMALL))
    batch = windows.tumbling_counts(e, ["host"]).select(
        F.col("event_hour").cast("timestamp_ntz").alias("event_hour"), "host", "num_hits")
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_kafka_options():
    o = sources.kafka_options("b:9092", "t", group_id="g", sasl_username="u", sasl_password="p")
    assert o["kafka.security.protocol"] == "SASL_SSL" and 'username="u"' in o["kafka.sasl.jaas.config"]
    assert o["startingOffsets"] == "latest" and o["subscribe"] == "t"


def test_two_sinks_one_source_and_stream_sessions(spark):
    from cairn.sources import testdata as td
    from tests.conftest import SF_SMALL
    src = td.web_events_from(sources.file_stream(spark, SF_SMALL, "events"))
    s = windows.event_time(src)
    by_host = windows.tumbling_counts(s, ["host"])
    by_ref = windows.tumbling_counts(s, ["host", "referrer"])
    out1, out2 = scratch_path(spark, "s1"), scratch_path(spark, "s2")
    sinks.run_all_available_now([(by_host, sinks.parquet_batch_writer(out1), scratch_path(spark, "c1"), "update"),
                                 (by_ref, sinks.parquet_batch_writer(out2), scratch_path(spark, "c2"), "update")])
    a = sinks.latest_by_key(spark, out1, ["event_hour", "host"]).agg(F.sum("num_hits")).first()[0]
    b = sinks.latest_by_key(spark, out2, ["event_hour", "host", "referrer"]).agg(F.sum("num_hits")).first()[0]
    n = td.web_events(spark, SF_SMALL).count()
    assert a == n and b == n
    # sessions in append mode: every closed session is emitted once; the still-open ones are held back
    sess = windows.sessions(windows.event_time(td.web_events_from(sources.file_stream(spark, SF_SMALL, "events"))),
                            ["ip", "host"], watermark="15 seconds")
    out3 = scratch_path(spark, "s3")
    sinks.run_available_now(sess, sinks.parquet_batch_writer(out3), scratch_path(spark, "c3"), mode="append")
    streamed = spark.read.parquet(out3).count() if __import__("os").path.exists(out3) else 0
    batch = windows.sessions(windows.event_time(td.web_events(spark, SF_SMALL)), ["ip", "host"]).count()
    assert streamed <= batch


def test_empty_stream_reads_as_empty(spark, tmp_path):
    src = str(tmp_path / "empty")
    import os
    os.makedirs(src)
    s = windows.event_time(spark.readStream.schema(sources.EVENTS_SCHEMA).parquet(src), "ts")
    agg = windows.tumbling_counts(s, ["user_id"], count_col="event_type")
    out = scratch_path(spark, "e-out")
    sinks.run_available_now(agg, sinks.parquet_batch_writer(out), scratch_path(spark, "e-ck"), mode="update")
    assert sinks.latest_by_key(spark, out, ["event_hour", "user_id"], schema=agg.schema).count() == 0


def test_streams_read_a_folder_of_part_files(spark, tmp_path):
    from cairn.plans.queries import QUERIES
    from tests.conftest import SF_SMALL
    spark.read.parquet(f"{SF_SMALL}/events.parquet").repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    for t in ("customer", "nation", "region", "supplier", "part", "orders", "lineitem"):
        (tmp_path / f"{t}.parquet").symlink_to(f"{SF_SMALL}/{t}.parquet")
    for name in ("stream_tumbling_host", "stream_tumbling_host_referrer", "stream_geo_enrich", "stream_sessions"):
        one, many = QUERIES[name](spark, SF_SMALL), QUERIES[name](spark, str(tmp_path))
        assert one.count() > 0
        assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0


def test_unreadable_output_raises(spark, tmp_path):
    import pytest
    (tmp_path / "batch_id=0").mkdir()
    (tmp_path / "batch_id=0" / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        sinks.read_batches(spark, str(tmp_path), sources.EVENTS_SCHEMA).count()


def test_string_event_time_in_a_stream(spark, tmp_path):
    src, out = str(tmp_path / "text"), scratch_path(spark, "txt")
    spark.createDataFrame([("h", "2024-01-01T00:00:01.500Z"), ("h", "2024-01-01T00:04:59.000Z"), ("h", "broken")],
                          "host string, event_time string").write.parquet(src)
    s = sources.parse_event_time(spark.readStream.schema("host string, event_time string").parquet(src))
    counts = windows.tumbling_counts(s, ["host"])
    sinks.run_available_now(counts, sinks.parquet_batch_writer(out), scratch_path(spark, "txt-ck"), mode="update")
    assert [r.num_hits for r in sinks.latest_by_key(spark, out, ["event_hour", "host"]).collect()] == [2]


def test_jdbc_writer_appends_a_replayed_batch_once(spark):
    table, done = [], []

    def write_table(frame, name, mode):
        assert mode == "append" and name == "t"
        table.extend(tuple(r) for r in frame.collect())
        done.append(max(r[-1] for r in table))
    write = sinks.jdbc_batch_writer("t", write_table, lambda: done[-1] if done else -1)
    batch = spark.createDataFrame([(1,), (2,)], "x long")
    write(batch, 0)
    write(batch, 0)
    write(batch, 1)
    assert sorted(table) == [(1, 0), (1, 1), (2, 0), (2, 1)]


def test_kafka_sink_frame(spark):
    import json
    df = spark.createDataFrame([("h", 3)], "host string, num_hits long")
    r = sinks.kafka_sink_frame(df, key="host").first()
    assert r["key"] == "h" and json.loads(r["value"]) == {"host": "h", "num_hits": 3}
