"""Building blocks shared by the pipelines.

* ``dedupe`` keeps one row per key through a partial aggregate (map-side
  combine), not a window: a key holding a third of all rows is reduced in every
  map task before the shuffle, instead of being sorted in one task.
* ``change_islands`` numbers runs of equal tracked values per entity (gaps and
  islands). It windows over rows already reduced to one per (entity, period),
  so a window partition holds at most one row per period.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(cs) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def dedupe(df: DataFrame, keys: Sequence[str], prefer: Sequence[str] = (), pick: str = "max") -> DataFrame:
    """One row per ``keys``: the row whose (prefer..., other columns...) is largest (``pick='max'``)
    or smallest (``'min'``). The order is total, so the survivor is deterministic."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c not in prefer]
    ordered = list(prefer) + rest
    if not ordered:
        return df.dropDuplicates(keys)
    agg = F.max if pick == "max" else F.min
    packed = F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(ordered)])
    out = df.groupBy(*keys).agg(agg(packed).alias("_row"))
    return out.select(*keys, *[F.col(f"_row._{i}").alias(c) for i, c in enumerate(ordered)]).select(*df.columns)


def change_flag(w, tracked: Sequence[str], first_is_change: bool = True) -> Column:
    """TRUE where any tracked value differs (null-safe) from the previous row of ``w``."""
    flag = None
    for c in tracked:
        diff = ~F.col(c).eqNullSafe(F.lag(c, 1).over(w))
        flag = diff if flag is None else (flag | diff)
    if first_is_change:
        flag = flag | F.lag(F.lit(1), 1).over(w).isNull()
    return flag


def change_islands(df: DataFrame, keys: Sequence[str], order: str, tracked: Sequence[str],
                   name: str = "island_id") -> DataFrame:
    """Add ``name``: running count of changes per entity, constant within a spell."""
    w = Window.partitionBy(*keys).orderBy(order)
    flag = change_flag(w, tracked).cast("int")
    return (df.withColumn("_chg", flag)
            .withColumn(name, F.sum("_chg").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
            .drop("_chg"))
