"""Event enrichment and (user, device) rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def events_enriched(events: DataFrame, devices: DataFrame) -> DataFrame:
    """Events with both ids present, joined to their device; browser upper-cased,
    missing referrer as 'unknown' (DataFrame form)."""
    e = events.where(F.col("user_id").isNotNull() & F.col("device_id").isNotNull())
    j = e.join(devices, "device_id")
    return j.select("user_id", "device_id", F.upper("browser_type").alias("browser_type"), "os_type",
                    "device_type", F.coalesce("referrer", F.lit("unknown")).alias("referrer"), "host", "url",
                    "event_time")


def events_enriched_sql(spark: SparkSession, events: DataFrame, devices: DataFrame) -> DataFrame:
    """The same result through Spark SQL (same optimised plan)."""
    return spark.sql("""
        SELECT e.user_id, d.device_id, upper(d.browser_type) AS browser_type, d.os_type, d.device_type,
               coalesce(e.referrer, 'unknown') AS referrer, e.host, e.url, e.event_time
        FROM {events} e JOIN {devices} d ON e.device_id = d.device_id
        WHERE e.user_id IS NOT NULL AND e.device_id IS NOT NULL""", events=events, devices=devices)


def user_device_counts(events: DataFrame) -> DataFrame:
    """(user, device) -> event_counts and the sorted distinct hosts."""
    return (events.where(F.col("user_id").isNotNull())
            .groupBy("user_id", "device_id")
            .agg(F.count(F.lit(1)).alias("event_counts"), F.array_sort(F.collect_set("host")).alias("host_array")))


def user_device_rollups(counts: DataFrame, devices: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From one (user, device) aggregate: devices per user and users per device.

    Both rollups read ``counts``; Spark reuses its shuffle exchange when both are
    in one plan, or the caller persists it (see ``cairn.plans.cache.cached``).
    """
    per_user = counts.groupBy("user_id").agg(F.max("event_counts").alias("total_hits"),
                                             F.array_sort(F.collect_list("device_id")).alias("devices"))
    per_device = (devices.select("device_id", "device_type").join(counts, "device_id")
                  .groupBy("device_id", "device_type")
                  .agg(F.array_sort(F.collect_list("user_id")).alias("users")))
    return per_user, per_device
