"""Exact deduplication by deterministic block naming.

Every normalised text is cut into fixed-size blocks. Distinct blocks are sorted into integer
names; then adjacent pairs of names are named again, level by level, until each document has
one integer. Names are given by comparing contents, so equal identities mean equal texts:

* level 0: distinct blocks are grouped on (hash, content). Rows then look their name up by the
  hash alone, which is only done for hashes proven to stand for a single content; blocks whose
  hash has several contents are looked up by content.
* level k: distinct (left, right) name pairs are grouped on the integers themselves. A last name
  without a partner is paired with -1, so texts of different block counts never meet.

Copies collapse in the map-side aggregation of each naming step, so a text that a third of the
documents share is shuffled once per task, not once per copy; look-ups move integers only.

Defined results: null text counts as empty; an empty text has one empty block. Rows with null
``doc_id`` rank below all others. Of several rows with the same text and the same ``doc_id``
exactly one is kept. Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cairn.operators.lookups import lookup_join

from .tables import UPPER, written

BLOCK_BYTES = 8192


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def _named(distinct: DataFrame, keys: list[str]) -> DataFrame:
    """Sort distinct key rows into integer names (partition number, then place in sort order)."""
    return distinct.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id())


def _block_names(rows: DataFrame) -> DataFrame:
    """Rows (row_id, pos, n, h, block) with ``block`` and ``h`` replaced by ``name``."""
    contents = rows.groupBy("h", "block").agg(F.lit(1).alias("one"))
    by_hash = written(_named(contents.groupBy("h").agg(F.count("*").alias("k")), ["h"]), "block-names")
    slim = rows.select("row_id", "pos", "n", "h").join(by_hash, "h")
    plain = slim.filter("k = 1").select("row_id", "pos", "n", F.struct("name", F.lit(0).alias("sub")).alias("id"))
    if by_hash.filter("k > 1").isEmpty():
        return plain
    shared = by_hash.filter("k > 1").select("h", "name")
    sub = (contents.join(shared, "h").select("h", "block", "name")
           .withColumn("sub", F.dense_rank().over(Window.partitionBy("h").orderBy("block"))))
    told = (rows.join(sub, ["h", "block"])
            .select("row_id", "pos", "n", F.struct("name", "sub").alias("id")))
    return plain.unionByName(told)


def identities(docs: DataFrame, block_bytes: int = BLOCK_BYTES, block_hash=F.xxhash64) -> DataFrame:
    """One row per input row: row_id, doc_id, text_sha256, level, id (struct of integers).

    (level, id) is equal for two rows exactly if their normalised texts are equal.
    """
    text = written(
        docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id",
                    ascii_lower(F.coalesce("text", F.lit(""))).cast("binary").alias("norm"))
        .withColumn("text_sha256", F.sha2("norm", 256))
        .withColumn("n", F.greatest(F.lit(1), F.ceil(F.octet_length("norm") / block_bytes)).cast("int")),
        "normalised")
    step = F.transform(F.sequence(F.lit(0), F.col("n") - 1),
                       lambda i: F.substring(F.col("norm"), i * block_bytes + 1, F.lit(block_bytes)))
    rows = (text.select("row_id", "n", F.posexplode(step).alias("pos", "block"))
            .withColumn("h", block_hash("block")))
    ids = written(_block_names(rows), "names")
    most = text.agg(F.max("n")).first()[0] or 1
    done, level = ids.filter("n = 1").select("row_id", F.lit(0).alias("level"), "id"), 0
    while most > 1:
        level += 1
        half = F.col("pos").bitwiseAND(1)
        pairs = (ids.filter("n > 1").groupBy("row_id", F.shiftright("pos", 1).alias("pos"), "n")
                 .agg(F.max(F.when(half == 0, F.col("id"))).alias("l"), F.max(F.when(half == 1, F.col("id"))).alias("r"))
                 .withColumn("r", F.coalesce("r", F.struct(F.lit(-1).cast("long").alias("name"), F.lit(0).alias("sub"))))
                 .withColumn("n", F.ceil(F.col("n") / 2).cast("int")))
        pairs = written(pairs, "pairs")
        names = _named(pairs.select("l", "r").distinct(), ["l", "r"])
        ids = written(pairs.join(names, ["l", "r"])
                      .select("row_id", "pos", "n", F.struct("name", F.lit(0).alias("sub")).alias("id")), "names")
        done = done.unionByName(ids.filter("n = 1").select("row_id", F.lit(level).alias("level"), "id"))
        most = -(-most // 2)
    return text.select("row_id", "doc_id", "text_sha256").join(done, "row_id")


def exact_duplicates(docs: DataFrame, block_bytes: int = BLOCK_BYTES, block_hash=F.xxhash64) -> DataFrame:
    """Group equal texts (A-Z lower-cased): doc_id, keep_id, group_size, kept, text_sha256.

    One row per input row. ``keep_id`` is the largest doc_id of the group; the row that stays has
    ``kept`` true.
    """
    ids = written(identities(docs, block_bytes, block_hash), "identities")
    best = F.max(F.struct("doc_id", "row_id")).alias("best")
    groups = ids.groupBy("level", "id").agg(F.count("*").alias("group_size"), best)
    # a text that many rows share is looked up where its rows lie
    return lookup_join(ids, written(groups, "groups"), ["level", "id"]).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("best.row_id") == F.col("row_id")).alias("kept"), "text_sha256")
