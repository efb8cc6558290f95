"""Scoped persistence: a shared sub-plan is cached for a block and always released."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()
