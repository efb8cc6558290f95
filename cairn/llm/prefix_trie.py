"""Prefix trie of conversations that share heads, by composable monoid fingerprints.

Conversations come in blocks of ``block``; conversation c is rebuilt from the first h turns of its
block's base, the conversation c - c % block, followed by its own turns after its first h, with
h = crc32(c in decimal) % ``heads``. Every distinct sequence of the first d rebuilt turns is a node.

* A sequence of turns has an element (m, a) of a monoid, the affine map x -> m x + a modulo a prime
  of 127 bits: m is a fixed multiplier per turn, a the key of the turn. Elements are multiplied by
  composing the maps. A rebuilt prefix is head times own suffix, so its fingerprint comes from the
  base's head products (at most ``heads`` - 1 of them) and the running product of the own turns; no
  rebuilt conversation is put together and no text moves.
* One shuffle brings a block together, sorted with its base first; the products are streamed, so a
  conversation of any length needs memory for its heads only.
* Equality is proven, not assumed. Turns are stored once, with their texts; a prefix refers to its
  last turn in that table. Keys of turns are compared with the stored texts (one text per key), and
  within each group of prefixes of equal depth and fingerprint all last turns must have one key and
  all parents one fingerprint; by induction over the depth a group then is one sequence. If any
  check fails, everything is fingerprinted anew with other keys and another multiplier.

Sums over subtrees need no walk. Every node belongs to its smallest member, so the nodes of a
conversation c form a chain on its path, from some depth on. Node values are summed along chains, and
a node's subtree is its own chain from there on, plus the whole chains of its other members.

Groups that many conversations share are counted with partial aggregation. Parents with very many
children (at most 1000 can have that many) are looked up by a broadcast, the others by a join. The
ids that end at one node are joined to text in fixed ranges of ids, and only these streamed, in
order, into the node's digest.

Defined results: null roles and texts are empty; turns are ordered by turn (nulls first), then role,
then text, so repeated turns have one order and each counts. Rows without ``conv_id`` belong to no
conversation and are left out. c % block has the sign of c. An empty table has no conversations and
no nodes, not even the root. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .tables import WORD, written

BLOCK = 20
HEADS = 4
PRIME = (1 << 127) - 1
ATTEMPTS = 8
END_RANGE_BITS = 12
HOT_CHILDREN = 64
FLUSH_ROWS = 8192

_NODE = ["depth", "f1", "f2"]


def multiplier(attempt: int, prime: int) -> int:
    return int.from_bytes(hashlib.sha256(b"multiplier %d" % attempt).digest(), "big") % (prime - 2) + 2


def times(left: tuple[int, int], right: tuple[int, int], prime: int) -> tuple[int, int]:
    """The product of two elements: first ``left``, then ``right``."""
    return left[0] * right[0] % prime, (left[1] * right[0] + right[1]) % prime


def stored_turns(conversations: DataFrame, block: int, heads: int, attempt: int) -> DataFrame:
    """The turns, stored once: turn_id, conv, base, n_head, turn, role, text, key (k1, k2), words."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    conv = F.col("conv_id").cast("long")
    rows = conversations.select(conv.alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    return rows.filter("conv IS NOT NULL").select(
        F.monotonically_increasing_id().alias("turn_id"), "conv", (F.col("conv") - F.col("conv") % block).alias("base"),
        F.pmod(F.crc32(F.col("conv").cast("string")), F.lit(heads)).alias("n_head"), "turn", "role", "text",
        F.xxhash64(F.lit(2 * attempt), "role", "text").alias("k1"), F.xxhash64(F.lit(2 * attempt + 1), "text", "role").alias("k2"),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"))


def prefixes(turns: DataFrame, heads: int, attempt: int, prime: int) -> DataFrame:
    """One row per conversation and depth, the root included: conv, depth, fingerprint (f1, f2),
    parent's fingerprint (p1, p2), last turn (turn_id, k1, k2, words), ends (is it the whole)."""
    step, low = multiplier(attempt, prime), (1 << 64) - 1

    def signed(x: int) -> int:
        return x - (1 << 64) if x >> 63 else x

    def halves(x: int) -> tuple[int, int]:
        return x >> 64, signed(x & low)

    def paths(rows: Iterator[tuple]) -> Iterator[tuple]:
        conv = base = None
        head: list[tuple] = []          # the base's first turns: (product up to here, its turn)
        held: tuple = ()                # the latest prefix; whether it is the last is not known yet
        for c, b, n_head, turn_id, k1, k2, words in rows:
            turn = (turn_id, k1, k2, words)
            element = (step, ((k1 & low) << 64 | k2 & low) % prime)
            if c != conv:
                if conv is not None:
                    yield (*held, True)
                if b != base:
                    base, head = b, []
                conv, own, seen, depth = c, (1, 0), 0, 0
                held = (c, 0, 0, 0, None, None, None, None, None, 0)
                shared, at = (1, 0), (0, 0)
                for product, its in head[:n_head] if c != b else ():
                    yield (*held, False)
                    depth, shared, parent, at = depth + 1, product, at, halves(product[1])
                    held = (c, depth, *at, *parent, *its)
            seen += 1
            if c == b and len(head) < heads - 1:
                head.append((times(head[-1][0] if head else (1, 0), element, prime), turn))
            if c == b or seen > n_head:
                own = times(own, element, prime)
                yield (*held, False)
                depth, parent, at = depth + 1, at, halves(times(shared, own, prime)[1])
                held = (c, depth, *at, *parent, *turn)
        if conv is not None:
            yield (*held, True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(x.to_pylist() for x in b.columns)))
        out = []
        for r in paths(rows):
            out.append(r)
            if len(out) == FLUSH_ROWS:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                out = []
        if out:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    longs = ["conv", "depth", "f1", "f2", "p1", "p2", "turn_id", "k1", "k2", "words"]
    schema = pa.schema([*((c, pa.int64()) for c in longs), ("ends", pa.bool_())])
    sorted_in = (turns.repartition("base")
                 .sortWithinPartitions("base", F.col("conv") != F.col("base"), "conv", F.asc_nulls_first("turn"), "role", "text")
                 .select("conv", "base", "n_head", "turn_id", "k1", "k2", "words"))
    return sorted_in.mapInArrow(run, ", ".join(f"{c} long" for c in longs) + ", ends boolean")


def _grouped(paths: DataFrame) -> DataFrame:
    """Prefixes by depth and fingerprint: n_convs, conv (smallest), last turn, parent; same (proven)."""
    low, high = [F.min(c).alias(f"{c}_low") for c in ("p1", "p2", "k1", "k2")], [F.max(c).alias(f"{c}_high") for c in ("p1", "p2", "k1", "k2")]
    rows = paths.groupBy(*_NODE).agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv"), F.min("turn_id").alias("turn_id"),
                                     F.max("words").alias("words"), F.sum(F.col("ends").cast("long")).alias("n_ends"), *low, *high)
    same = F.lit(True)
    for c in ("p1", "p2", "k1", "k2"):
        same = same & F.col(f"{c}_low").eqNullSafe(F.col(f"{c}_high"))
    return rows.select(*_NODE, "n_convs", "conv", "turn_id", "words", "n_ends", F.col("p1_low").alias("p1"), F.col("p2_low").alias("p2"),
                       same.alias("same"))


def proven(conversations: DataFrame, block: int = BLOCK, heads: int = HEADS, primes: tuple[int, ...] = (PRIME,)) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored turns, prefixes and groups of prefixes, of which each is proven to be one sequence."""
    for attempt in range(ATTEMPTS):
        turns = written(stored_turns(conversations, block, heads, attempt), "trie-turns")
        texts = turns.select("k1", "k2", "role", "text").distinct().groupBy("k1", "k2").agg(F.count("*").alias("texts"))
        if not texts.filter("texts > 1").isEmpty():
            continue
        paths = written(prefixes(turns, heads, attempt, primes[min(attempt, len(primes) - 1)]), "trie-prefixes")
        groups = written(_grouped(paths), "trie-groups")
        if groups.filter(~F.col("same")).isEmpty():
            return turns, paths, groups
    raise RuntimeError(f"no collision-free fingerprints in {ATTEMPTS} attempts")


def _ends(paths: DataFrame) -> DataFrame:
    """Per node where conversations end: their ids' digest, from texts of fixed ranges of ids in order."""
    ranges = (paths.filter("ends").groupBy(*_NODE, F.shiftright("conv", END_RANGE_BITS).alias("part"))
              .agg(F.concat_ws(",", F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string"))).alias("ids")))
    ordered = ranges.repartition(*_NODE).sortWithinPartitions(*_NODE, "part").select(*_NODE, "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for b in batches:
            done = []
            for d, f1, f2, ids in zip(*(x.to_pylist() for x in b.columns)):
                if (d, f1, f2) == node:
                    digest.update(b",")
                else:
                    if node is not None:
                        done.append((*node, digest.hexdigest()))
                    node, digest = (d, f1, f2), hashlib.sha256()
                digest.update(ids.encode())
            if done:
                yield pa.record_batch([pa.array(c) for c in zip(*done)], names)
        if node is not None:
            yield pa.record_batch([pa.array([x]) for x in (*node, digest.hexdigest())], names)

    names = [*_NODE, "ends_sha256"]
    return ordered.mapInArrow(run, "depth long, f1 long, f2 long, ends_sha256 string")


def trie(conversations: DataFrame, block: int = BLOCK, heads: int = HEADS, primes: tuple[int, ...] = (PRIME,)) -> DataFrame:
    """Per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256, and turn_id and words of its last turn."""
    _, paths, groups = proven(conversations, block, heads, primes)
    children = (groups.filter("depth > 0")
                .groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("f1"), F.col("p2").alias("f2"))
                .agg(F.count("*").alias("n_children")))
    nodes = groups.drop("same").join(children, _NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    down = Window.partitionBy("conv").orderBy(F.desc("depth"))
    on_chain = down.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    chains = written(nodes.withColumns({
        "chain_leaves": F.sum((F.col("n_children") == 0).cast("long")).over(on_chain),
        "chain_saved": F.sum((F.col("n_convs") - 1) * F.col("words")).over(on_chain),
        "first": F.lead("depth").over(down).isNull()}), "trie-chains")

    heads_of = chains.filter("first").select("conv", F.col("depth").alias("from_depth"), "chain_leaves", "chain_saved")
    others = (paths.select("conv", *_NODE).join(heads_of, "conv").filter("depth < from_depth")
              .groupBy(*_NODE).agg(F.sum("chain_leaves").alias("other_leaves"), F.sum("chain_saved").alias("other_saved")))

    known = chains.select("depth", "f1", "f2", F.col("conv").alias("above"), "n_children")
    bound = max(HOT_CHILDREN, groups.count() // 1000)          # fewer than 1000 parents can have more children
    hot, cold = F.broadcast(known.filter(F.col("n_children") > bound)), known.filter(f"n_children BETWEEN 1 AND {bound}")
    lower = chains.filter("first AND depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("p1").alias("f1"),
                                                        F.col("p2").alias("f2"), F.col("f1").alias("c1"), F.col("f2").alias("c2"))
    found = (lower.join(hot.drop("n_children"), _NODE, "left"))
    above = (found.filter("above IS NOT NULL")
             .unionByName(found.filter("above IS NULL").drop("above").join(cold.drop("n_children"), _NODE))
             .select((F.col("depth") + 1).alias("depth"), F.col("c1").alias("f1"), F.col("c2").alias("f2"), "above"))

    none = hashlib.sha256(b"").hexdigest()
    out = (chains.join(others, _NODE, "left").join(above, _NODE, "left").join(_ends(paths), _NODE, "left"))
    zero = F.lit(0).cast("long")
    return out.select(
        F.col("conv").alias("conv_id"), "depth",
        F.when(F.col("depth") > 0, F.when(F.col("first"), F.col("above")).otherwise(F.col("conv"))).alias("parent_conv_id"),
        "n_convs", "n_children", (F.col("chain_leaves") + F.coalesce("other_leaves", zero)).alias("n_leaves"),
        (F.col("chain_saved") + F.coalesce("other_saved", zero)).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"), "turn_id", "words")
