"""Reading the text tables and writing intermediate tables to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from cairn.session import written  # noqa: F401  (the operators take it from here)

# The white space that separates words and that line keys are stripped of.
SPACE = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def schema_with(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    """The schema of ``df`` followed by one more column."""
    return T.StructType([*df.schema.fields, T.StructField(name, kind)])
