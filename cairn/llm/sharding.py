"""Sharding by extendible hashing.

Every row gets a 60-bit hash of its ``doc_id``. The directory is indexed by leading hash bits; a
bucket larger than the byte limit is split on one more bit, and only such buckets are, until every
shard fits. A row's shard is therefore the shallowest hash prefix whose bytes fit the limit.

The directory is built from sums, never from rows gathered in one place: bytes are summed per
cell (a prefix a few bits deeper than the mean bucket needs), each cell adds its bytes to all its
prefixes of the round, and the shallowest prefix that fits becomes the cell's shard. Cells that
are still too large go on to the next round with more bits. Each round's directory is a table that
rows join by cell; Spark broadcasts it only where its measured size allows.

Rows that cannot be told apart by hash bits: when all bits are used up and a bucket is still too
large it holds rows of one ``doc_id`` (repeated rows, or null ids), or a single document above the
limit. Such a bucket becomes a chain of overflow pages; a row's page comes from a second hash of
its text and its row number in the written slim table, and pages split on bits of that hash in the
same way. Only a single row larger than the limit exceeds it, alone in its shard.

Defined results: null text has 0 bytes, null ``doc_id`` hashes as the empty string; an empty table
gives an empty directory and no rows. All input columns are returned, followed by ``shard``,
``shard_depth`` and ``shard_bytes``; an input column of one of these names is replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from .tables import written

SHARD_BYTES = 64 << 20
HASH_BITS = 60
ROUND_BITS = 4


def doc_hash(doc_id: Column) -> Column:
    """The first 60 bits of the MD5 digest of the id's text."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def _prefix(bits: Column, depth) -> Column:
    return F.call_function("shiftright", bits, F.lit(HASH_BITS) - depth)


def _round(slim: DataFrame, bits: str, lo: int, hi: int, limit: int) -> DataFrame:
    """Per cell of depth ``hi``: the shallowest prefix of depth lo..hi that fits (null: none)."""
    cells = (slim.groupBy(_prefix(F.col(bits), F.lit(hi)).alias("cell"))
             .agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")))
    depths = cells.withColumn("depth", F.explode(F.sequence(F.lit(lo), F.lit(hi))))
    depths = depths.withColumn("prefix", F.call_function("shiftright", F.col("cell"), F.lit(hi) - F.col("depth")))
    sums = (depths.groupBy("depth", "prefix").agg(F.sum("bytes").alias("shard_bytes"), F.sum("rows").alias("rows"))
            .filter((F.col("shard_bytes") <= limit) | (F.col("rows") == 1)))
    shallowest = F.min(F.struct("depth", "prefix", "shard_bytes")).alias("s")
    return (depths.select("cell", "depth", "prefix").join(sums, ["depth", "prefix"])
            .groupBy("cell").agg(shallowest)
            .select("cell", F.col("s.depth").alias("depth"), F.col("s.prefix").alias("prefix"), "s.shard_bytes"))


def directory(slim: DataFrame, bits: str, limit: int, round_bits: int = ROUND_BITS) -> list[tuple[int, DataFrame]]:
    """Rounds of (cell depth, cell -> shard); each round covers what the rounds before left over."""
    rounds, rest, lo = [], slim, 0
    total = slim.agg(F.sum("bytes")).first()[0] or 0
    hi = min(HASH_BITS, max(1, math.ceil(math.log2(max(2, total / limit)))) + round_bits)
    while True:
        cells = written(_round(rest, bits, lo, hi, limit), "shard-directory")
        rounds.append((hi, cells))
        rest = rest.join(cells, _prefix(F.col(bits), F.lit(hi)) == F.col("cell"), "left_anti")
        if hi == HASH_BITS or rest.isEmpty():
            return rounds
        lo, hi = hi + 1, min(HASH_BITS, hi + round_bits)


def _placed(rows: DataFrame, rounds: list[tuple[int, DataFrame]], bits: str) -> DataFrame:
    """Rows with columns depth, prefix, shard_bytes of their shard (null: not placed)."""
    rows = rows.withColumns({c: F.lit(None).cast(t) for c, t in
                             (("__depth", "int"), ("__prefix", "long"), ("__bytes", "long"))})
    for hi, cells in rounds:
        found = cells.select(F.col("cell").alias("__cell"), F.col("depth").alias("__d"),
                             F.col("prefix").alias("__p"), F.col("shard_bytes").alias("__b"))
        rows = (rows.join(found, (F.col("__depth").isNull()) & (_prefix(F.col(bits), F.lit(hi)) == F.col("__cell")), "left")
                .withColumns({"__depth": F.coalesce("__depth", "__d"), "__prefix": F.coalesce("__prefix", "__p"),
                              "__bytes": F.coalesce("__bytes", "__b")})
                .drop("__cell", "__d", "__p", "__b"))
    return rows


def _name(depth: Column, prefix: Column) -> Column:
    return F.when(depth == 0, F.lit("")).otherwise(F.lpad(F.bin(prefix), depth, F.lit("0")))


def shard(docs: DataFrame, limit_bytes: int = SHARD_BYTES, round_bits: int = ROUND_BITS) -> DataFrame:
    """``docs`` with shard (its bit prefix as text; overflow pages add ``/`` and page bits),
    shard_depth (bits used) and shard_bytes."""
    keep = [c for c in docs.columns if c not in ("shard", "shard_depth", "shard_bytes")]
    rows = docs.select(*keep).withColumns({
        "__bits": doc_hash(F.col("doc_id")), "__size": F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")})
    slim = written(rows.groupBy(F.col("__bits").alias("bits"))
                   .agg(F.sum("__size").alias("bytes"), F.count("*").alias("rows")), "shard-sizes")
    placed = _placed(rows, directory(slim, "bits", limit_bytes, round_bits), "__bits")
    out = [*keep, F.col("__name").alias("shard"), F.col("__depth").alias("shard_depth"), F.col("__bytes").alias("shard_bytes")]
    fits = placed.filter("__depth is not null").withColumn("__name", _name(F.col("__depth"), F.col("__prefix"))).select(*out)
    if slim.filter((F.col("bytes") > limit_bytes) & (F.col("rows") > 1)).isEmpty():
        return fits
    page = F.conv(F.substring(F.md5(F.concat_ws(":", F.monotonically_increasing_id(), F.xxhash64("text"))), 1, 15), 16, 10)
    over = written(placed.filter("__depth is null").withColumn("__page", page.cast("long")), "shard-overflow")
    return fits.unionByName(_pages(over, limit_bytes, round_bits).select(*out))


def _pages(over: DataFrame, limit: int, round_bits: int) -> DataFrame:
    """Overflow pages: within one full hash, split on bits of the page hash."""
    lo, parts, rest = 0, [], over
    hi = round_bits
    while True:
        cell = _prefix(F.col("__page"), F.lit(hi))
        sums = rest.groupBy("__bits", cell.alias("cell")).agg(F.sum("__size").alias("bytes"), F.count("*").alias("rows"))
        depths = (sums.withColumn("d", F.explode(F.sequence(F.lit(lo), F.lit(hi))))
                  .withColumn("p", F.call_function("shiftright", F.col("cell"), F.lit(hi) - F.col("d"))))
        fit = (depths.groupBy("__bits", "d", "p").agg(F.sum("bytes").alias("b"), F.sum("rows").alias("rows"))
               .filter((F.col("b") <= limit) | (F.col("rows") == 1)).drop("rows"))
        found = written(depths.select("__bits", "cell", "d", "p").join(fit, ["__bits", "d", "p"])
                        .groupBy("__bits", "cell").agg(F.min(F.struct("d", "p", "b")).alias("s")), "shard-pages")
        hit = rest.withColumn("cell", cell).join(found, ["__bits", "cell"])
        name = F.concat(_name(F.lit(HASH_BITS), F.col("__bits")), F.lit("/"), _name(F.col("s.d"), F.col("s.p")))
        parts.append(hit.withColumns({"__name": name, "__depth": F.lit(HASH_BITS) + F.col("s.d"), "__bytes": F.col("s.b")}))
        rest = rest.withColumn("cell", cell).join(found, ["__bits", "cell"], "left_anti").drop("cell")
        if hi == HASH_BITS or rest.isEmpty():
            break
        lo, hi = hi + 1, min(HASH_BITS, hi + round_bits)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
