"""Data checks that replace the server-side PRIMARY KEY / NOT NULL / ENUM declarations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_audit(df: DataFrame, keys: Sequence[str], *, not_null: Sequence[str] = (),
              enums: Mapping[str, Sequence[str]] | None = None, table: str = "table") -> DataFrame:
    """One row per check: (table, check_name, n_violations).

    * ``pk_duplicate_keys``: keys occurring more than once; ``pk_excess_rows``:
      rows beyond the first per key (one partial aggregate on the key);
    * ``not_null:<col>``: NULL count; ``enum:<col>``: non-NULL values outside
      the allowed set (one pass over the table for all of them).
    """
    enums = enums or {}
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    pk = per_key.agg(F.count(F.lit(1)).alias("pk_duplicate_keys"),
                     F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("pk_excess_rows"))
    checks = [F.count_if(F.col(c).isNull()).alias(f"not_null:{c}") for c in not_null]
    checks += [F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(list(v))).alias(f"enum:{c}")
               for c, v in enums.items()]
    parts = [pk.select(F.lit(table).alias("table"), F.lit("pk_duplicate_keys").alias("check_name"),
                       F.col("pk_duplicate_keys").cast("bigint").alias("n_violations")),
             pk.select(F.lit(table).alias("table"), F.lit("pk_excess_rows").alias("check_name"),
                       F.col("pk_excess_rows").alias("n_violations"))]
    if checks:
        row = df.agg(*checks)
        stacked = row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("check_name"),
                                                           F.col(f"`{c}`").cast("bigint").alias("n_violations"))
                                                 for c in row.columns])).alias("_c"))
        parts.append(stacked.select(F.lit(table).alias("table"), "_c.check_name", "_c.n_violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def assert_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Typed-read nullability contract: fails the job on the first NULL in ``cols``.

    The check sits in a filter (``assert_true`` returns NULL when it holds), so
    column pruning cannot remove it."""
    if not cols:
        return df
    cond = None
    for c in cols:
        chk = F.assert_true(F.col(c).isNotNull(), F.lit(f"NULL in non-nullable column {c}"))
        cond = chk.isNull() if cond is None else (cond & chk.isNull())
    return df.where(cond)
