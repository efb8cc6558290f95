"""Ordered-sequence operators that stay parallel when one key owns most rows.

A window ``PARTITION BY key ORDER BY t`` sends every row of a key to one task;
with 25 teams (or one hot key holding a third of the data) that is the whole
job in a handful of tasks. ``running_totals`` computes the same positions and
running sums with a distributed prefix sum instead:

1. range-partition on (key, order...): a hot key is split over several
   partitions by its order columns;
2. per range, local positions and running sums (a window over (range, key), so
   no window partition is larger than a range);
3. per (partition, key) totals; only keys that span more than one partition
   need an offset, and at most one key can straddle each partition boundary,
   so the offsets table has at most 2 x partitions rows (broadcast). The ranges
   are written once, so the totals and the rows agree on range numbers;
4. position = local position + offset.

Runs of a flag are then groups of equal "zeros so far". Rolling N-row sums use the
same ranges, each with the N - 1 rows before it lent by the ranges it follows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairn.session import written



def _join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on ``keys`` where NULL matches NULL; the right side's key columns are dropped."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = c if cond is None else (cond & c)
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def running_totals(df: DataFrame, key: str, order: Sequence[str], values: Sequence[str], *,
                   partitions: int | None = None, idx: str = "pos") -> DataFrame:
    """Add ``pos`` (1-based position within key by ``order``) and ``cum_<v>`` (inclusive
    running sum of each integral value column; NULL counts as 0). ``order`` must be a total order
    within key; a NULL key is a key of its own."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cols = [key, *order, *values]
    df = df.select(key, *order, *[F.col(v).cast("bigint").alias(v) for v in values])
    # The ranges are written once: totals and rows are read back with the same range number,
    # whatever a lost executor makes Spark compute again.
    ranged = written(df.repartitionByRange(n, key, *order).withColumn("_pid", F.spark_partition_id()), "ranges")
    # A hot key is spread over its ranges, so a window partition is at most one range.
    w = Window.partitionBy("_pid", key).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.withColumns({"_lidx": F.row_number().over(w),
                                **{f"_lcum_{v}": F.sum(F.coalesce(v, F.lit(0))).over(upto) for v in values}})
    tot = ranged.groupBy("_pid", key).agg(F.count(F.lit(1)).alias("_n"),
                                          *[F.sum(F.coalesce(v, F.lit(0))).alias(f"_s_{v}") for v in values])
    wk = Window.partitionBy(key)
    wo = wk.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = (tot.withColumn("_parts", F.count(F.lit(1)).over(wk)).where(F.col("_parts") > 1)
            .select("_pid", key, F.coalesce(F.sum("_n").over(wo), F.lit(0)).alias("_on"),
                    *[F.coalesce(F.sum(f"_s_{v}").over(wo), F.lit(0)).alias(f"_os_{v}") for v in values]))
    # Bounded by construction: a key appears here only if it straddles a range
    # boundary, and each of the n-1 boundaries splits at most one key, so the
    # table holds at most 2(n-1) rows. No size probe (it would run the pipeline twice).
    offs = F.broadcast(offs)
    j = _join_null_safe(local, offs, ["_pid", key])
    return j.select(*cols,
                    (F.col("_lidx") + F.coalesce("_on", F.lit(0))).cast("bigint").alias(idx),
                    *[(F.col(f"_lcum_{v}") + F.coalesce(f"_os_{v}", F.lit(0))).cast("bigint").alias(f"cum_{v}")
                      for v in values])


def global_rank(df: DataFrame, order: Sequence, out: str = "rank") -> DataFrame:
    """Number all rows from 1 in ``order`` (a total order) without a single-task window: a
    distributed sort, then each row's place in its range plus the sizes of the ranges before."""
    sorted_rows = written(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()), "ranked")
    part, place = F.shiftright("_id", 33), F.col("_id").bitwiseAND((1 << 33) - 1)
    sizes = sorted_rows.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offs = F.broadcast(sizes.select("_p", before.alias("_before")))      # one row per sort range
    return (sorted_rows.withColumn("_p", part).join(offs, "_p")
            .withColumn(out, (F.col("_before") + place + 1).cast("bigint")).select(*df.columns, out))


def rolling_sum(df: DataFrame, key: str, order: Sequence[str], value: str, width: int, *,
                out: str | None = None, partitions: int | None = None) -> DataFrame:
    """Sum of ``value`` (integral, NULL counts as 0) over the current row and the ``width - 1`` rows
    before it, per key, and each row's ``pos`` in its key. ``order`` must be a total order within key;
    a NULL key is a key of its own.

    Rows are sorted into ranges and written once. A key that goes on in a later range lends it its
    last ``width - 1`` rows, from several ranges where these are shorter than that; so one window
    over (range, key) sees every row it needs, and lent rows are at most ranges x (width - 1).
    """
    out = out or f"rolling_{value}"
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = written(df.select(key, *order, F.col(value).cast("bigint").alias(value))
                   .repartitionByRange(n, key, *order).sortWithinPartitions(key, *order)
                   .withColumn("_id", F.monotonically_increasing_id()), "ranges")
    rows = rows.withColumn("_pid", F.shiftright("_id", 33))
    # At most 2(n - 1) rows, as only a key on both sides of one of the n - 1 boundaries is in several
    # ranges; written, as they are read twice and the rows need not be counted again.
    wk = Window.partitionBy(key)
    wo = wk.orderBy("_pid")
    parts = written(
        rows.groupBy("_pid", key).agg(F.count(F.lit(1)).alias("_n"), F.max("_id").alias("_last"))
        .withColumn("_parts", F.count(F.lit(1)).over(wk)).where("_parts > 1")
        .withColumn("_before", F.coalesce(F.sum("_n").over(wo.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))),
        "range-parts")
    # A range of at least one row lends to at most the width - 1 next ones.
    later = F.collect_list(F.struct("_pid", "_before")).over(wo.rowsBetween(1, max(1, width - 1)))
    lends = (parts.withColumn("_later", later).withColumn("_to", F.explode("_later"))
             .withColumn("_take", width - 1 - (F.col("_to._before") - F.col("_before") - F.col("_n")))
             .where("_take > 0").select("_pid", key, F.col("_to._pid").alias("_for"), "_last", "_take"))
    lent = (_join_null_safe(rows, F.broadcast(lends), ["_pid", key], "inner")
            .where(F.col("_id") > F.col("_last") - F.col("_take"))
            .select(key, *order, value, "_id", F.col("_for").alias("_pid"), F.lit(1).alias("_lent")))
    w = Window.partitionBy("_pid", key).orderBy("_id")
    summed = (rows.withColumn("_lent", F.lit(0)).unionByName(lent)
              .withColumns({out: F.sum(F.coalesce(value, F.lit(0))).over(w.rowsBetween(1 - width, Window.currentRow)),
                            "_place": F.sum(1 - F.col("_lent")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))})
              .where("_lent = 0"))
    return (_join_null_safe(summed, F.broadcast(parts.select("_pid", key, "_before")), ["_pid", key])
            .select(key, *order, value, (F.col("_place") + F.coalesce("_before", F.lit(0))).cast("bigint").alias("pos"), out))


def longest_run(df: DataFrame, key: str, order: Sequence[str], flag: str, *, out: str = "longest_streak",
                partitions: int | None = None) -> DataFrame:
    """Longest run of consecutive rows with ``flag`` true, per key (0 when never true).

    Rows of one run share the count of false rows seen so far; runs are then
    plain partial aggregates, however long a run is.
    """
    f = df.withColumn("_miss", F.when(F.col(flag), 0).otherwise(1).cast("bigint"))
    rt = running_totals(f, key, order, ["_miss"], partitions=partitions)
    # one pass: runs, then per key the longest run and the number of rows
    runs = rt.groupBy(key, "cum__miss").agg(F.count(F.lit(1)).alias("_rows"),
                                            F.sum(1 - F.col("_miss")).alias("_len"))
    return runs.groupBy(key).agg(F.sum("_rows").alias("games"), F.max("_len").cast("bigint").alias(out))


# ------------------------------------------------------------------ sessions ---

def sessions_by_gap(df: DataFrame, keys: Sequence[str], ts: str, gap_seconds: int = 300, *,
                    partitions: int | None = None) -> DataFrame:
    """Sessions per keys (a gap longer than ``gap_seconds`` starts a new one): keys...,
    session_start, session_end (last event + gap), num_events.

    Rows with a NULL time belong to no session. Same result as grouping by ``session_window``, but a key holding most of the
    events is split over several range partitions instead of one task.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    gap_us = int(gap_seconds) * 1_000_000
    tcol = F.col(ts).cast("timestamp")
    ranged = written(df.where(F.col(ts).isNotNull())
                     .select(*keys, F.col(ts).alias("_ts"), F.unix_micros(tcol).alias("_us"))
                     .repartitionByRange(n, *keys, "_us").withColumn("_pid", F.spark_partition_id()), "ranges")
    wl = Window.partitionBy("_pid", *keys).orderBy("_us")
    before = F.lag("_us").over(wl)
    # a range's first row of a key starts a session provisionally
    new = F.when(before.isNull() | (F.col("_us") - before > gap_us), 1).otherwise(0)
    local = (ranged.withColumn("_new", new)
             .withColumn("_lsid", F.sum("_new").over(wl.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    # per (partition, key): first/last event, sessions started inside (the first row counts provisionally)
    tot = local.groupBy("_pid", *keys).agg(F.min("_us").alias("_first"), F.max("_us").alias("_last"),
                                           F.max("_lsid").alias("_n"))
    wk = Window.partitionBy(*keys)
    wo = wk.orderBy("_pid")
    spanning = tot.withColumn("_parts", F.count(F.lit(1)).over(wk)).where(F.col("_parts") > 1)
    prev_last = F.lag("_last", 1).over(wo)
    # c = -1 when this partition's first event continues the previous partition's last session
    c = F.when(prev_last.isNull(), 0).when(F.col("_first") - prev_last > gap_us, 0).otherwise(-1)
    adj = spanning.withColumn("_c", c).withColumn("_adj", F.col("_n") + F.col("_c"))
    offs = adj.select("_pid", *keys, (F.coalesce(F.sum("_adj").over(wo.rowsBetween(Window.unboundedPreceding, -1)),
                                                 F.lit(0)) + F.col("_c")).alias("_off"))
    offs = F.broadcast(offs)          # at most 2(n-1) rows: only keys straddling a range boundary
    j = _join_null_safe(local, offs, ["_pid", *keys])
    sid = F.col("_lsid") + F.coalesce("_off", F.lit(0))
    g = j.groupBy(*keys, sid.alias("_sid")).agg(F.min("_ts").alias("session_start"),
                                                 F.max("_ts").alias("_end"), F.count(F.lit(1)).alias("num_events"))
    return g.select(*keys, "session_start", (F.col("_end") + F.expr(f"INTERVAL {int(gap_seconds)} SECONDS"))
                    .alias("session_end"), "num_events")
