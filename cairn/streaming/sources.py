"""Stream sources: a file stream over parquet (offline runs and tests) and Kafka."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

# Fixed value: the event-time text format of the JSON stream (ISO-8601, milliseconds, UTC 'Z').
EVENT_TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSX"


def file_stream(spark: SparkSession, directory: str, name: str, schema: T.StructType = EVENTS_SCHEMA,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream the table ``<directory>/<name>.parquet``, a folder of part files or a single file (new
    files are picked up as they land). The path is written as a pattern because Spark streams a
    single file only from a pattern."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(f"{directory.rstrip('/')}/{{{name}}}.parquet")


def kafka_options(servers: str, topic: str, *, group_id: str | None = None, starting_offsets: str = "latest",
                  sasl_username: str | None = None, sasl_password: str | None = None) -> dict[str, str]:
    """Options for ``readStream.format('kafka')``; SASL_SSL/PLAIN when credentials are given."""
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting_offsets,
            "failOnDataLoss": "false"}
    if group_id:
        opts["kafka.group.id"] = group_id
    if sasl_username is not None:
        jaas = ("org.apache.kafka.common.security.plain.PlainLoginModule required "
                f'username="{sasl_username}" password="{sasl_password or ""}";')
        opts.update({"kafka.security.protocol": "SASL_SSL", "kafka.sasl.mechanism": "PLAIN",
                     "kafka.sasl.jaas.config": jaas})
    return opts


def kafka_json_stream(spark: SparkSession, schema: T.StructType, **kw) -> DataFrame:
    """JSON records from a Kafka topic, parsed with a declared schema (needs the Kafka connector jar)."""
    raw = spark.readStream.format("kafka").options(**kafka_options(**kw)).load()
    return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("r")).select("r.*")


def parse_event_time(df: DataFrame, text_col: str = "event_time", out: str = "event_timestamp",
                     pattern: str = EVENT_TIME_PATTERN) -> DataFrame:
    """Event time from its text form; unparseable text becomes NULL (not a failure)."""
    return df.withColumn(out, F.try_to_timestamp(F.col(text_col), F.lit(pattern)))
