"""Mixing sources to target weights by capped water-filling.

Each source has a weight and a size in words. Targets share the mix in proportion to the weights;
a source whose share would exceed ``max_epochs`` times its size is clamped there and its excess
goes to the others by weight, until no source is above its cap. That fixed point is
``min(cap, level * weight)``: sorting sources by cap / weight, ``level`` is what the words left
over by the clamped sources give per unit of the remaining weight. The tables here have one row
per source.

A source's rounded target is taken as whole repetitions of every document, plus a fractional
repetition: documents in seeded hash order until the rest of the words is reached. The cut is
found from sums, never by sorting a source: words per (source, leading 12 hash bits), then per
next 12 bits inside the cell that holds the cut, then per hash inside that cell. So a source with
a third of all rows is summed in map-side aggregates like any other. What comes out is one row per
source, ``cutoffs``; each document's share follows from its own hash.

Defined results: null text has 0 words; null is a source of its own; a null ``doc_id`` hashes as
the empty string. The document at the cut takes part of its words; rows that share its hash
(repeated ids) share these words in proportion to size, rounded down. A source with 0 words has
target 0 and takes nothing. Same seed and rows: same result. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .tables import WORD, written

MAX_EPOCHS = 3
SEED = 17
CELL_BITS = 12
HASH_BITS = 60


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def seeded_hash(doc_id: Column, seed: int) -> Column:
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def water_fill(sources: DataFrame, max_epochs: int) -> DataFrame:
    """Adds ``target`` to (source, weight, source_size); the targets share the sum of the sizes."""
    cap = (F.col("source_size") * max_epochs).cast("long")
    rows = sources.withColumns({"cap": cap, "ratio": cap / F.col("weight")})
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    rows = rows.withColumns({
        "mix": F.sum("source_size").over(everything),
        "clamped": F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "open_weight": F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))})
    rows = rows.withColumn("level", (F.col("mix") - F.col("clamped")).cast("double") / F.col("open_weight"))
    rows = rows.withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(everything))
    target = F.least(F.col("cap").cast("double"),
                     F.coalesce(F.col("level.level") * F.col("weight"), F.col("cap").cast("double")))
    return rows.select("source", "weight", "source_size", target.alias("target"))


def _find_cut(cells: DataFrame, key: str) -> DataFrame:
    """Of (source, rest, key, words): per source the key that holds the cut, and the rest within it."""
    before = F.coalesce(F.sum("words").over(
        Window.partitionBy("source").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (cells.withColumn("before", before)
            .filter((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words")))
            .select("source", F.col(key), (F.col("rest") - F.col("before")).alias("rest"), "words"))


def _same(a: DataFrame, b: DataFrame) -> Column:
    return a["source"].eqNullSafe(b["source"])


def cutoffs(slim: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per source: target, whole repetitions, and the hash where the fractional one ends.

    ``slim`` has (source, h, size). Rows with ``h < h_cut`` are taken once more; rows at ``h_cut``
    share ``rest`` of their ``unit`` words.
    """
    goal = F.floor(F.col("target") + 0.5)
    plan = targets.withColumn("whole", F.coalesce(F.expr("CAST(floor(target + 0.5) AS BIGINT) div nullif(source_size, 0)"), F.lit(0)))
    plan = written(plan.withColumn("rest", (goal - F.col("whole") * F.col("source_size")).cast("long")), "mix-plan")
    first, second = HASH_BITS - CELL_BITS, HASH_BITS - 2 * CELL_BITS
    cells = slim.groupBy("source", F.shiftright("h", first).alias("c1")).agg(F.sum("size").alias("words"))
    cells = cells.join(plan.select(F.col("source").alias("s"), "rest"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    cut = _find_cut(cells, "c1")
    for shift, key, last in ((second, "c2", "c1"), (0, "h_cut", "c2")):
        at = cut.select(F.col("source").alias("s"), F.col(last).alias("at"), "rest")
        up = {"c1": first, "c2": second}[last]
        inside = slim.join(at, F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("h", up) == F.col("at")))
        cells = inside.groupBy("source", "rest", F.shiftright("h", shift).alias(key)).agg(F.sum("size").alias("words"))
        cut = _find_cut(cells, key)
    cut = cut.select(F.col("source").alias("s"), "h_cut", F.col("rest").alias("cut_rest"), F.col("words").alias("unit"))
    return (plan.join(cut, F.col("source").eqNullSafe(F.col("s")), "left")
            .select("source", "source_size", "target", "whole", F.coalesce("h_cut", F.lit(-1)).alias("h_cut"),
                    F.coalesce("cut_rest", F.lit(0)).alias("rest"), F.coalesce("unit", F.lit(1)).alias("unit")))


def sizes(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """Slim rows (doc_id, source, size, h), written once: texts are counted a single time."""
    return written(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                               seeded_hash(F.col("doc_id"), seed).alias("h")), "mix-sizes")


def plan_mix(slim: DataFrame, weights: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``cutoffs`` for the sources of ``slim``; ``weights`` has (source, weight), one row each.

    A source without a weight, or with weight 0, takes no part.
    """
    named = weights.filter("weight > 0").select(F.col("source").alias("s"), F.col("weight").cast("double").alias("weight"))
    totals = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = totals.join(named, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    return written(cutoffs(slim, water_fill(sources, max_epochs)), "mix-cutoffs")


def _with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    renamed = plan.select(*[F.col(c).alias(f"__{c}") for c in plan.columns])
    return rows.join(renamed, rows["source"].eqNullSafe(renamed["__source"]), "left")


def taken_words(slim: DataFrame, plan: DataFrame) -> DataFrame:
    """Per row of ``slim``: doc_id, size, source_size, target, taken."""
    part = (F.when(F.col("h") < F.col("__h_cut"), F.col("size"))
            .when(F.col("h") == F.col("__h_cut"), F.expr("(size * __rest) div __unit")).otherwise(F.lit(0)))
    return _with_plan(slim, plan).select(
        "doc_id", "size", F.col("__source_size").alias("source_size"), F.col("__target").alias("target"),
        F.coalesce(F.col("__whole") * F.col("size") + part, F.lit(0)).cast("long").alias("taken"))


def mixed(docs: DataFrame, plan: DataFrame, seed: int = SEED) -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it, whole texts only: the rows at
    the cut are repeated once more if at least half of their words are due."""
    h = seeded_hash(F.col("doc_id"), seed)
    more = (h < F.col("__h_cut")) | ((h == F.col("__h_cut")) & (2 * F.col("__rest") >= F.col("__unit")))
    copies = F.coalesce(F.col("__whole") + F.when(more, 1).otherwise(0), F.lit(0)).cast("int")
    return (_with_plan(docs, plan).withColumn("__copy", F.explode(F.array_repeat(F.lit(1), copies)))
            .select(*[docs[c] for c in docs.columns]))


def ranked_weights(slim: DataFrame, cycle: tuple[int, ...]) -> DataFrame:
    """Weights that repeat ``cycle`` over the sources in code-point order, null last."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in cycle]), (place % len(cycle) + 1).cast("int"))
    return slim.select("source").distinct().select("source", pick.alias("weight"))
