"""Footers, pruning by derived columns and joins, bucket counts, stale input."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cairn.operators import matches as mt
from cairn.plans import queries as q
from cairn.plans.joins import plan_text
from cairn.session import scratch_path
from cairn.sinks import tables
from cairn.sources import footers as ft
from cairn.sources import testdata as td
from tests.conftest import SF_SMALL


def test_footers_equal_what_the_files_say(spark, tmp_path):
    df = spark.range(10_000).select("id", (F.col("id") % 7).cast("string").alias("s"), F.lit(None).cast("int").alias("none"),
                                    F.timestamp_seconds("id").cast("timestamp_ntz").alias("t"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 100).cast("int")).alias("d"))
    path = str(tmp_path / "f")
    df.repartition(3).write.option("parquet.block.size", "16384").parquet(path)
    rows = ft.footers(spark, path).collect()
    want = 0
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        want += meta.num_row_groups * meta.num_columns
    assert len(rows) == want and sum(r.n_rows for r in rows if r.column == "id") == 10_000
    ids = [r for r in rows if r.column == "id"]
    assert min(r.low_number for r in ids) == 0 and max(r.high_number for r in ids) == 9_999
    assert max(r.high_number for r in rows if r.column == "t") == 9_999 * 10**6
    assert min(r.low_number for r in rows if r.column == "d") == 19_723
    assert all(r.low is None and r.nulls == r.n_rows for r in rows if r.column == "none")
    assert {r.low for r in rows if r.column == "s"} == {"0"}


def test_row_groups_a_filter_reads(spark, tmp_path):
    path = str(tmp_path / "r")
    spark.range(0, 8000, 1, 4).write.parquet(path)
    groups = ft.row_groups(ft.footers(spark, path), "id", 2500, 4001, ["id"])
    assert sorted(r.n_rows for r in groups.where("read").collect()) == [2000, 2000]
    facts = ft.layout_facts(groups).first()
    assert (facts.n_files, facts.n_row_groups, facts.n_rows, facts.rows_read) == (4, 4, 8000, 4000)
    assert facts.of_bytes == facts.stored_bytes > 0
    assert ft.layout_facts(ft.row_groups(ft.footers(spark, path), "unknown", 0, 1)).first().groups_read == 4


def test_footers_of_a_store_only_spark_reads(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "s")
    spark.range(0, 100, 1, 2).write.parquet(path)
    want = sorted(map(tuple, ft.footers(spark, path).collect()))
    monkeypatch.setattr(ft, "_OPENED", ("s3",))                       # file contents then come through Spark
    assert sorted(map(tuple, ft.footers(spark, path).collect())) == want


def test_dynamic_pruning_by_a_filtered_calendar(spark):
    df = q.QUERIES["staged_days_pruned"](spark, SF_SMALL)
    assert "dynamicpruning" in plan_text(df).lower()
    df.collect()
    read = [int(x) for x in _metric(df, "numPartitions")]
    days = td.web_events(spark, SF_SMALL).select(F.to_date("event_time").alias("d")).distinct()
    assert read and max(read) == days.where("weekday(d) >= 5").count() < days.count()


def _metric(df, name):
    """Values of a scan metric in the executed plan."""
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        p = todo.pop()
        m = p.metrics().get(name)
        if m.isDefined():
            found.append(m.get().value())
        kids = p.children()
        todo += [kids.apply(i) for i in range(kids.size())]
        for child in ("executedPlan", "plan"):
            if p.getClass().getSimpleName() in ("AdaptiveSparkPlanExec", "ShuffleQueryStageExec", "BroadcastQueryStageExec", "ResultQueryStageExec"):
                try:
                    todo.append(getattr(p, child)())
                except Exception:  # noqa: BLE001  (the other one of the two names)
                    pass
    return found


def test_filters_on_derived_columns_prune_folders(spark):
    rows = td.order_revenue(spark, SF_SMALL)
    laid = tables.with_partition_transforms(rows, "order_date", "customer_id", 16)
    path = scratch_path(spark, "t-transforms")
    laid.write.partitionBy("order_date_year", "customer_id_bucket").parquet(path)
    t = spark.read.schema(laid.schema).parquet(path)
    ranged = t.where(tables.in_date_range("order_date", "1998-06-15", "2000-01-01"))
    txt = plan_text(ranged)
    assert "PartitionFilters" in txt and "order_date_year" in txt.split("PartitionFilters")[1].split("\n")[0]
    years = {r.y for r in ranged.select(F.year("order_date").alias("y")).distinct().collect()}
    assert years == {1998, 1999}                                         # the open end prunes 2000 itself
    folders = {r[0] for r in ranged.select(F.regexp_extract("_metadata.file_path", r"order_date_year=(\d+)", 1)).distinct().collect()}
    assert folders == {"1998", "1999"}
    one = t.where(tables.of_key("customer_id", 7))
    assert one.count() == rows.where("customer_id = 7").count() > 0
    buckets = [f for f in one.inputFiles()]
    assert "customer_id_bucket" in plan_text(one).split("PartitionFilters")[1].split("\n")[0] and buckets


@pytest.mark.parametrize("small,large", [(4, 16), (4, 64), (8, 8)])
def test_join_of_unequal_bucket_counts_has_no_exchange(spark, small, large):
    tag = scratch_path(spark, "x")[-6:]
    a = spark.range(3000).select((F.col("id") % 500).alias("k"), "id")
    b = spark.range(600).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for name, df, n in (("a", a, small), ("b", b, large)):
        mt.write_bucketed(df, f"t_un_{name}_{tag}", scratch_path(spark, "un"), key="k", buckets=n)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = mt.unequal_bucket_join(spark, f"t_un_a_{tag}", f"t_un_b_{tag}", "k")
        assert "Exchange" not in j._jdf.queryExecution().executedPlan().toString()
        assert j.exceptAll(a.join(b, "k").select(*j.columns)).isEmpty() and j.count() == 3000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))


def test_bucket_count_follows_the_size(spark):
    df = spark.range(1_000_000)
    assert mt.bucket_count(df) == 16
    assert mt.bucket_count(df, bucket_bytes=100_000) == 128            # 8 MB
    assert mt.bucket_count(df, bucket_bytes=1) == 1 << 17


def test_bucket_count_of_a_join_follows_its_tables(spark):
    """Not the product of their sizes, which asks for more buckets than Spark allows."""
    rows = spark.range(1_000_000).join(spark.range(100_000), "id").groupBy("id").count()
    assert mt.bucket_count(rows, bucket_bytes=100_000) == 128          # 8.8 MB


def test_more_buckets_than_the_session_allows_are_written(spark):
    key = "spark.sql.sources.bucketing.maxBuckets"
    before = spark.conf.get(key)
    spark.conf.set(key, "8")
    try:
        name = f"t_most_{scratch_path(spark, 'x')[-6:]}"
        mt.write_bucketed(spark.range(500).withColumnRenamed("id", "match_id"), name, scratch_path(spark, "most"), buckets=16)
        assert spark.table(name).count() == 500 and len(spark.table(name).inputFiles()) == 16
    finally:
        spark.conf.set(key, before)


def test_new_input_is_not_served_from_older_tables(spark, tmp_path):
    for t in td.TABLES:
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    first = q.QUERIES["bucket_filter_avg"](spark, str(tmp_path)).first().n_rows
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    li.union(li).coalesce(2).write.mode("append").parquet(str(tmp_path / "lineitem.parquet"))
    assert td.table(spark, str(tmp_path), "lineitem").count() == 3 * li.count()
    assert q.QUERIES["bucket_filter_avg"](spark, str(tmp_path)).first().n_rows == 3 * first
