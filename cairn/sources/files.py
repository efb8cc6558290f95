"""Readers with declared schemas (no inference in library code), catalog reads,
generated rows and date spines."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.operators.quality import assert_not_null


def read_csv(spark: SparkSession, path: str, schema: T.StructType, *, header: bool = True,
             not_null: Sequence[str] = ()) -> DataFrame:
    """CSV with a declared schema; rows with NULL in ``not_null`` columns are dropped."""
    df = spark.read.schema(schema).option("header", str(header).lower()).option("mode", "PERMISSIVE").csv(path)
    for c in not_null:
        df = df.where(F.col(c).isNotNull())
    return df


def read_csv_as_strings(spark: SparkSession, path: str, casts: Mapping[str, tuple[str, str]], *,
                        header: bool = True) -> DataFrame:
    """CSV read as text, then ``select`` of ``{out_name: (source_column, type)}`` with ``try_cast``
    (a malformed value becomes NULL instead of failing the job)."""
    raw = spark.read.option("header", str(header).lower()).csv(path)
    return raw.select(*[F.col(src).try_cast(typ).alias(out) for out, (src, typ) in casts.items()])


def read_typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed-dataset contract: columns cast to the declared types in declared order, and
    a NULL in a field declared non-nullable fails the job (``assert_true``)."""
    out = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    required = [f.name for f in schema.fields if not f.nullable]
    return assert_not_null(out, required)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_bucket(spark: SparkSession, table: str, key: str, value) -> DataFrame:
    """Rows of one key value from a bucketed table: the equality filter on the bucket
    column lets the scan read one bucket's files only."""
    return spark.table(table).where(F.col(key) == F.lit(value))


def synthetic_scores(spark: SparkSession, n: int, *, matches: int = 100, seed: int = 7,
                     partitions: int | None = None) -> DataFrame:
    """``n`` rows (match_id, player, score) generated on the executors (no driver loop)."""
    r = spark.range(0, n, numPartitions=partitions) if partitions else spark.range(0, n)
    return r.select(F.concat(F.lit("M"), (F.floor(F.rand(seed) * matches) + 1).cast("int").cast("string")).alias("match_id"),
                    F.concat(F.lit("player_"), F.col("id").cast("string")).alias("player"),
                    F.floor(F.rand(seed + 1) * 101).cast("int").alias("score"))


def date_spine(spark: SparkSession, start: str, end: str, step: str = "1 day", name: str = "date") -> DataFrame:
    """One row per date in [start, end] (GENERATE_SERIES)."""
    return spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)),
                                                      F.expr(f"INTERVAL {step}"))).alias(name))


def season_spine(spark: SparkSession, first: int, last: int, name: str = "season") -> DataFrame:
    return spark.range(first, last + 1).select(F.col("id").alias(name))


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def path_version(spark: SparkSession, path: str) -> str:
    """A digest of the names, sizes and change times of the file or folder at ``path`` (metadata only)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    listed = [(f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(p)]
    return hashlib.md5(repr(sorted(listed)).encode()).hexdigest()[:12]
