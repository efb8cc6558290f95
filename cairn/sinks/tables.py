"""Table writers.

All writes are by column name (never by position). A daily or yearly step
writes exactly its own partition with dynamic partition overwrite, so a rerun
of a period replaces that period and nothing else.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions.hashing import bucket_of


def align_to(df: DataFrame, spark: SparkSession, table: str) -> DataFrame:
    """Columns of ``df`` reordered (and cast) to the target table's schema, by name."""
    target = spark.table(table).schema
    missing = [f.name for f in target.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing for {table}: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.fields])


def overwrite_partitions(df: DataFrame, spark: SparkSession, table: str) -> None:
    """INSERT OVERWRITE of only the partitions present in ``df`` (dynamic mode)."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")                 # read when the write is planned, so only for this one
    try:
        align_to(df, spark, table).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(key, before)


def append(df: DataFrame, spark: SparkSession, table: str) -> None:
    align_to(df, spark, table).write.insertInto(table, overwrite=False)


def create_partitioned(df: DataFrame, table: str, partition_by: Sequence[str], path: str | None = None,
                       *, sort_within: Sequence[str] = ()) -> None:
    """CREATE TABLE AS SELECT partitioned by ``partition_by`` (optionally sorted in each file)."""
    out = df.sortWithinPartitions(*sort_within) if sort_within else df
    w = out.write.mode("overwrite").format("parquet").partitionBy(*partition_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)


def upsert_period(state: DataFrame, spark: SparkSession, table: str) -> None:
    """Upsert of a cumulative step: the full-outer-join result already is the merged state of
    its period, so replacing that period's partition is the upsert (MERGE is not available
    on plain Parquet tables)."""
    overwrite_partitions(state, spark, table)


def with_partition_transforms(df: DataFrame, date_col: str, bucket_col: str | None = None, buckets: int = 16) -> DataFrame:
    """Derived layout columns: year of a date (``years(d)``) and, with ``bucket_col``, its bucket
    (``bucket(16, k)``)."""
    df = df.withColumn(f"{date_col}_year", F.year(date_col))
    if bucket_col is not None:
        df = df.withColumn(f"{bucket_col}_bucket", bucket_of(bucket_col, buckets))
    return df


def in_date_range(date_col: str, low: str, high: str) -> Column:
    """``low <= date_col < high`` for a table laid out by ``with_partition_transforms``: the same range
    on the derived year, which prunes partitions, and on the date itself, which prunes row groups."""
    day, year = F.col(date_col), F.col(f"{date_col}_year")
    last = F.year(F.date_sub(F.lit(high).cast("date"), 1))
    return (year >= F.year(F.lit(low).cast("date"))) & (year <= last) & (day >= F.lit(low).cast("date")) & (day < F.lit(high).cast("date"))


def of_key(bucket_col: str, value, buckets: int = 16, kind: str = "bigint") -> Column:
    """``bucket_col = value`` for such a table: reads the folder of the value's bucket only."""
    v = F.lit(value).cast(kind)
    return (F.col(f"{bucket_col}_bucket") == bucket_of(v, buckets)) & (F.col(bucket_col) == v)

