"""Sources and sinks: declared schemas, typed contract, idempotent period writes."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.session import scratch_path
from cairn.sinks import tables
from cairn.sources import files
from cairn.sources import testdata as td
from tests.conftest import SF_SMALL


def test_csv_roundtrip_with_schema(spark):
    path = scratch_path(spark, "maps-csv")
    maps = td.maps(spark, SF_SMALL).withColumn("description", F.when(F.col("mapid") % 3 == 0, F.lit(None))
                                                .otherwise(F.concat(F.lit("map "), F.col("map_name"))))
    maps.coalesce(1).write.option("header", "true").csv(path)
    schema = T.StructType([T.StructField("mapid", T.LongType()), T.StructField("map_name", T.StringType()),
                           T.StructField("description", T.StringType())])
    back = files.read_csv(spark, path, schema, not_null=["description"])
    assert back.count() == maps.where(F.col("description").isNotNull()).count()
    typed = files.read_csv_as_strings(spark, path, {"id": ("mapid", "bigint"), "name": ("map_name", "string")})
    assert typed.schema["id"].dataType == T.LongType() and typed.count() == 25


def test_typed_contract_fails_on_null(spark):
    schema = T.StructType([T.StructField("user_id", T.LongType(), False), T.StructField("x", T.StringType())])
    ok = spark.createDataFrame([(1, "a")], "user_id long, x string")
    assert files.read_typed(ok, schema).count() == 1
    bad = spark.createDataFrame([(None, "a")], "user_id long, x string")
    with pytest.raises(Exception):
        files.read_typed(bad, schema).collect()


def test_spines_and_synthetic(spark):
    assert files.date_spine(spark, "2024-01-01", "2024-01-31").count() == 31
    s = files.synthetic_scores(spark, 10_000, matches=100)
    assert s.count() == 10_000 and s.select("match_id").distinct().count() <= 100


def test_period_overwrite_is_idempotent(spark):
    name = "t_users_cumulated_" + scratch_path(spark, "x")[-6:]
    path = scratch_path(spark, "uc")
    spark.sql(f"CREATE TABLE {name} (user_id BIGINT, n BIGINT, date DATE) USING parquet PARTITIONED BY (date) "
              f"LOCATION '{path}'")
    day1 = spark.createDataFrame([(1, 1)], "user_id long, n long").withColumn("date", F.to_date(F.lit("2024-01-01")))
    day2 = spark.createDataFrame([(1, 2), (2, 1)], "user_id long, n long").withColumn("date",
                                                                                      F.to_date(F.lit("2024-01-02")))
    tables.overwrite_partitions(day1.select("n", "date", "user_id"), spark, name)   # by name, any order
    tables.overwrite_partitions(day2, spark, name)
    tables.overwrite_partitions(day2, spark, name)                                   # rerun of the same day
    assert spark.table(name).count() == 3
    assert spark.table(name).where("date = '2024-01-01'").first().n == 1


def test_catalog_reads_views_and_spines(spark):
    from cairn.operators.matches import write_bucketed
    from cairn.sources import files
    name = "t_read_" + scratch_path(spark, "x")[-6:]
    rows = spark.createDataFrame([("M1", 5), ("M2", 6), ("M1", 7)], "match_id string, score long")
    write_bucketed(rows, name, scratch_path(spark, "rb"))
    assert files.read_table(spark, name).count() == 3
    one = files.read_bucket(spark, name, "match_id", "M1")
    assert sorted(r.score for r in one.collect()) == [5, 7]
    files.register_view(rows, "t_scores_view")
    assert spark.sql("SELECT sum(score) AS s FROM t_scores_view").first().s == 18
    assert [r.season for r in files.season_spine(spark, 1996, 1999).orderBy("season").collect()] == [1996, 1997, 1998, 1999]


def test_partitioned_table_append_and_upsert(spark):
    name = "t_state_" + scratch_path(spark, "x")[-6:]
    day1 = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string").withColumn("ds", F.lit("2024-01-01"))
    tables.create_partitioned(day1, name, ["ds"], scratch_path(spark, "state"), sort_within=["id"])
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    day2 = spark.createDataFrame([(1, "c")], "id long, v string").withColumn("ds", F.lit("2024-01-02"))
    tables.append(day2, spark, name)
    tables.upsert_period(day2.unionByName(spark.createDataFrame([(3, "d", "2024-01-02")], day2.schema)), spark, name)
    assert sorted((r.ds, r.id, r.v) for r in spark.table(name).collect()) == [
        ("2024-01-01", 1, "a"), ("2024-01-01", 2, "b"), ("2024-01-02", 1, "c"), ("2024-01-02", 3, "d")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_partition_transforms(spark):
    from cairn.functions.hashing import bucket_of
    df = spark.createDataFrame([(1, "2024-03-01"), (2, "2023-01-01")], "id long, d string").withColumn("d", F.to_date("d"))
    out = tables.with_partition_transforms(df, "d", "id", 16).withColumn("want", bucket_of(F.col("id"), 16))
    assert sorted((r.id, r.d_year, r.id_bucket == r.want) for r in out.collect()) == [(1, 2024, True), (2, 2023, True)]
