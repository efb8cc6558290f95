"""Stream sinks: micro-batch writes (parquet / JDBC) and Kafka."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parquet_batch_writer(path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch function: each micro-batch goes to its own ``batch_id=<n>`` folder, so a
    replayed batch (after a failure) overwrites exactly what it wrote before."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return write


def jdbc_batch_writer(table: str, write_table: Callable[[DataFrame, str, str], None],
                      committed: Callable[[], int]) -> Callable[[DataFrame, int], None]:
    """foreachBatch function appending each micro-batch to a table once, replays included.

    Rows carry their ``batch_id``; a batch at or below ``committed()`` (the largest id the table
    holds) is skipped. ``write_table(frame, table, mode)`` writes, e.g. ``jdbc_write``; the rows of a
    batch must become visible together, as they do in one database transaction."""
    def write(batch: DataFrame, batch_id: int) -> None:
        if batch_id > committed():
            write_table(batch.withColumn("batch_id", F.lit(batch_id)), table, "append")
    return write


def jdbc_write(url: str, properties: dict[str, str]) -> Callable[[DataFrame, str, str], None]:
    """The JDBC form of ``write_table`` (needs the database's driver jar). One partition, so that a
    batch is one transaction."""
    def write(frame: DataFrame, table: str, mode: str) -> None:
        frame.coalesce(1).write.jdbc(url, table, mode=mode, properties=properties)
    return write


def kafka_sink_frame(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows as JSON values (and optional key) for ``writeStream.format('kafka')``."""
    cols = [F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value")]
    if key:
        cols.insert(0, F.col(key).cast("string").alias("key"))
    return df.select(*cols)


def run_available_now(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str,
                      mode: str = "append", trigger_available_now: bool = True) -> None:
    """Process everything available now through ``sink`` and stop; progress is in ``checkpoint``
    so a rerun resumes where the last one ended."""
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(sink)
    w = w.trigger(availableNow=True) if trigger_available_now else w
    q = w.start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def read_batches(spark: SparkSession, path: str, schema) -> DataFrame:
    """Everything a ``parquet_batch_writer`` wrote (with its batch_id), or an empty frame of
    ``schema`` (plus batch_id) when the stream ran no micro-batch, so that the folder does not
    exist. Anything else that cannot be read raises."""
    from pyspark.sql import types as T
    if not folder_exists(spark, path):
        return spark.createDataFrame([], T.StructType(list(schema.fields) + [T.StructField("batch_id", T.IntegerType())]))
    return spark.read.parquet(path)


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists in its file system (metadata only)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def latest_by_key(spark: SparkSession, path: str, keys: Sequence[str], schema=None) -> DataFrame:
    """Final value per key of an update-mode output: the row of the latest micro-batch
    (a partial aggregate: max over (batch id, row))."""
    df = read_batches(spark, path, schema) if schema is not None else spark.read.parquet(path)
    vals = [c for c in df.columns if c not in keys and c != "batch_id"]
    packed = F.max(F.struct(F.col("batch_id"), *[F.col(c) for c in vals])).alias("_r")
    return df.groupBy(*keys).agg(packed).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in vals])


def run_all_available_now(queries: list[tuple[DataFrame, Callable[[DataFrame, int], None], str, str]]) -> None:
    """Several sinks fed from one source: one streaming query per sink, each with its own
    checkpoint (``(frame, sink, checkpoint, mode)``), all started, then all awaited."""
    started = []
    for df, sink, ckpt, mode in queries:
        w = df.writeStream.outputMode(mode).option("checkpointLocation", ckpt).foreachBatch(sink)
        started.append(w.trigger(availableNow=True).start())
    for q in started:
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
