"""Parquet footers as a table: what every row group holds, without reading its rows.

Files are listed by Spark and their footers read in tasks, one row per (file, row group, column).
A layout's stored size, its files and row groups, and the share of them that a range filter would
read are then plain aggregates.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Stores whose files pyarrow opens itself; others are read through Spark.
_OPENED = ("file", "s3", "s3a", "gs", "hdfs")
_SCHEMA = ("path string, file_bytes long, row_group int, n_rows long, column string, stored_bytes long, "
           "plain_bytes long, nulls long, low string, high string, low_number long, high_number long")
_EPOCH = dt.datetime(1970, 1, 1)


def _number(v) -> int | None:
    """A bound as an integer where its type has an order of integers: dates in days, times in microseconds."""
    if isinstance(v, bool) or v is None:
        return None
    if isinstance(v, int):
        return v
    if isinstance(v, dt.datetime):
        return (v.replace(tzinfo=None) - _EPOCH) // dt.timedelta(microseconds=1)
    if isinstance(v, dt.date):
        return (v - _EPOCH.date()).days
    return None


def _text(v) -> str | None:
    return None if v is None else v.decode("utf-8", "replace") if isinstance(v, bytes) else str(v)


def _opened(path: str, content: bytes | None):
    if content is not None:
        return pa.BufferReader(content)
    from pyarrow import fs
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem().open_input_file(re.sub(r"^/+", "/", rest))
    store, inner = fs.FileSystem.from_uri(path.replace("s3a:", "s3:", 1))
    return store.open_input_file(inner)


def footers(spark: SparkSession, path: str) -> DataFrame:
    """One row per file, row group and column below ``path``: rows, bytes stored and plain, nulls and
    bounds (as text, and as an integer for integers, dates and times). Bounds are NULL where the
    file has no statistics."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path))
    scheme = F.substring_index("path", ":", 1)
    opened = files.where(scheme.isin(*_OPENED)).select("path", "length", F.lit(None).cast("binary").alias("content"))
    through = files.where(~scheme.isin(*_OPENED)).select("path", "length", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq
        for b in batches:
            for name, size, content in zip(*(b.column(c).to_pylist() for c in ("path", "length", "content"))):
                rows = []
                with _opened(name, content) as source:
                    meta = pq.ParquetFile(source).metadata
                    for g in range(meta.num_row_groups):
                        group = meta.row_group(g)
                        for c in range(group.num_columns):
                            col = group.column(c)
                            s = col.statistics
                            low, high = (s.min, s.max) if s is not None and s.has_min_max else (None, None)
                            rows.append((name, size, g, group.num_rows, col.path_in_schema, col.total_compressed_size,
                                         col.total_uncompressed_size, s.null_count if s is not None and s.has_null_count else None,
                                         _text(low), _text(high), _number(low), _number(high)))
                if rows:
                    yield pa.record_batch([pa.array(v, t) for v, t in zip(zip(*rows), kinds)], names)

    names = [c.split()[0] for c in _SCHEMA.split(", ")]
    kinds = [{"string": pa.string(), "long": pa.int64(), "int": pa.int32()}[c.split()[1]] for c in _SCHEMA.split(", ")]
    # the content column is empty for files opened in place, so dealing the list out moves names only
    return opened.repartition("path").mapInArrow(run, _SCHEMA).unionByName(through.mapInArrow(run, _SCHEMA))


def row_groups(bounds: DataFrame, column: str, low: int, high: int, of: Sequence[str] = ()) -> DataFrame:
    """One row per row group of ``footers``: path, file_name, row_group, n_rows, stored_bytes, of_bytes (of
    the columns ``of``) and ``read``: whether a filter ``low <= column < high``, in the integers of
    ``footers``, has to read it. Without bounds it has to."""
    mine = F.col("column") == column
    groups = bounds.groupBy("path", "row_group").agg(
        F.max("n_rows").alias("n_rows"), F.sum("stored_bytes").cast("bigint").alias("stored_bytes"),
        F.sum(F.when(F.col("column").isin(*of), F.col("stored_bytes")).otherwise(0)).cast("bigint").alias("of_bytes"),
        F.max(F.when(mine, F.col("low_number"))).alias("_low"), F.max(F.when(mine, F.col("high_number"))).alias("_high"))
    apart = (F.col("_high") < low) | (F.col("_low") >= high)
    return groups.select("path", F.substring_index("path", "/", -1).alias("file_name"), "row_group", "n_rows", "stored_bytes", "of_bytes",
                         (~F.coalesce(apart, F.lit(False))).alias("read"))


def layout_facts(groups: DataFrame) -> DataFrame:
    """One row about ``row_groups``: n_files, n_row_groups, n_rows, stored_bytes, of_bytes, groups_read, rows_read."""
    total = [F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("n_rows", "stored_bytes", "of_bytes")]
    return groups.agg(F.count_distinct("path").alias("n_files"), F.count(F.lit(1)).alias("n_row_groups"), *total,
                      F.count_if("read").alias("groups_read"),
                      F.coalesce(F.sum(F.when(F.col("read"), F.col("n_rows"))), F.lit(0)).cast("bigint").alias("rows_read"))


def micros(moment: str) -> int:
    """A time (ISO text, UTC) in the integers of ``footers``."""
    return _number(dt.datetime.fromisoformat(moment))
