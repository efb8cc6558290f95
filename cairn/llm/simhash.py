"""SimHash near-duplicates by a segment-popcount embedding.

Fingerprints: the 64-bit XXH64 hashes of a text's word shingles (repeats included) vote per bit.

Linking all fingerprints at ``max_bits`` = r or fewer differing bits:

* Distinct fingerprints only: copies collapse before anything is joined.
* Embedding: a fingerprint is cut into 32 segments of 2 bits and each segment mapped to its number
  of one bits. The Manhattan distance of two embeddings is a lower bound of the Hamming distance of
  the fingerprints. Counts are kept in unary (0: 00, 1: 01, 2: 11), so Manhattan distance is the
  number of differing bits of two 64-bit embeddings.
* Grid range-join: the segments are dealt to enough parts that two embeddings at distance r differ
  by at most 1 in one of them. Per part a fingerprint has a home cell (that part's counts). Two that
  link share a home cell, or the cell one count above the home of one is the home of the other; so
  each fingerprint also probes the cells one count above its own. Matching is an equi-join on
  (part, cell): it spreads by cell, and nothing is compared outside its cells.
* Candidates must pass the whole Manhattan distance, and are then verified on the exact bits.

Only groups matter, so links inside dense cells are not all emitted: a cell with more than
``DENSE_PAIRS`` candidate pairs is cut into blocks, each pair of blocks is compared in one task
with vector operations, and a spanning forest of the links found there is returned. Every link is
either returned or has its ends joined by returned links.

Components: rounds of large-star and small-star over the links, each a written table, until
nothing changes. Only fingerprints that have links take part; nothing is collected.

Defined results: null and empty texts have no words and fingerprint zero, which links like any
other; fewer words than a shingle form one shingle. ``component_id`` is the smallest doc_id of the
component, null ids aside (a component of null ids only has a null id). One row per input row,
repeated rows included; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .tables import schema_with, written

SHINGLE_WORDS = 3
MAX_BITS = 3
DENSE_PAIRS = 10_000
BLOCK = 512
SEGMENTS = 32


def fingerprint_batch(texts: list[bytes | None], shingle: int) -> np.ndarray:
    """64-bit fingerprints of UTF-8 texts."""
    from xxhash import xxh64_intdigest
    out = np.zeros(len(texts), np.uint64)
    hashes, where, sizes = [], [], []
    pending = 0

    def flush() -> None:
        if where:
            out[where] = _majority(np.array(hashes, np.uint64), np.array(sizes, np.int64))
        hashes.clear(), where.clear(), sizes.clear()

    for i, text in enumerate(texts):
        words = (text or b"").lower().split()
        if not words:
            continue
        line = b" ".join(words)
        if len(words) <= shingle:
            hashes.append(xxh64_intdigest(line, 42))
            n = 1
        else:
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            begins = np.concatenate([[0], ends[:-1] + 1])
            n = len(words) - shingle + 1
            hashes.extend([xxh64_intdigest(line[a:b], 42) for a, b in zip(begins[:n].tolist(), ends[shingle - 1:].tolist())])
        where.append(i)
        sizes.append(n)
        pending += n
        if pending > 200_000:
            flush()
            pending = 0
    flush()
    return out


def _majority(h: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per run of ``sizes`` hashes the bits that more than half of them have.

    Counts eight bits at a time in the bytes of 64-bit lanes, over runs of up to 255 hashes.
    """
    starts = np.cumsum(sizes) - sizes
    parts = -(-sizes // 255)
    run = np.repeat(np.arange(len(sizes)), parts)
    first = np.cumsum(parts) - parts
    at = starts[run] + (np.arange(len(run)) - first[run]) * 255
    one = np.uint64(0x0101010101010101)
    bits = np.zeros(len(sizes), np.uint64)
    for j in range(8):
        lanes = np.add.reduceat((h >> np.uint64(j)) & one, at)
        counts = np.add.reduceat(lanes.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
        for byte in range(8):
            bits |= (2 * counts[:, byte] > sizes).astype(np.uint64) << np.uint64(8 * byte + j)
    return bits


def with_fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """Adds ``__fp``, the fingerprint as a signed long, to all columns of ``docs``."""
    schema = schema_with(docs, "__fp", T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = fingerprint_batch(b.column("text").cast(pa.large_binary()).to_pylist(), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fp)], names=[*b.schema.names, "__fp"])

    return docs.mapInArrow(run, schema)


def _parts(max_bits: int) -> list[tuple[int, int, int]]:
    """(part, first segment, end segment): so many that one part differs by at most 1."""
    n = -(-(max_bits + 1) // 2)
    cut = [SEGMENTS * i // n for i in range(n + 1)]
    return [(p, cut[p], cut[p + 1]) for p in range(n)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _embedded(fps: DataFrame) -> DataFrame:
    low = _signed(int("01" * SEGMENTS, 2))
    both, either = "(fp & shiftrightunsigned(fp, 1))", "(fp | shiftrightunsigned(fp, 1))"
    return fps.withColumn("e", F.expr(f"({either} & {low}L) | shiftleft({both} & {low}L, 1)"))


def _cells(embedded: DataFrame, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """Home cells and probed cells: (part, cell, fp, e)."""
    homes, probes = [], []
    for part, lo, hi in _parts(max_bits):
        mask = _signed(((1 << 2 * (hi - lo)) - 1) << 2 * lo)
        home = embedded.select(F.lit(part).alias("part"), F.expr(f"e & {mask}L").alias("cell"), "fp", "e")
        homes.append(home)
        if max_bits > 0:
            up = (f"transform(sequence({lo}, {hi - 1}), i -> CASE WHEN getbit(e, 2 * i) = 0 THEN cell | shiftleft(1L, 2 * i) "
                  f"WHEN getbit(e, 2 * i + 1) = 0 THEN cell | shiftleft(1L, 2 * i + 1) END)")
            probes.append(home.select("part", F.explode(F.expr(f"filter({up}, x -> x IS NOT NULL)")).alias("cell"), "fp", "e"))
        else:
            probes.append(home.limit(0))
    return _union(homes), _union(probes)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def links(fps: DataFrame, max_bits: int = MAX_BITS, dense_pairs: int = DENSE_PAIRS, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between distinct fingerprints, enough to connect all that are within ``max_bits``."""
    homes, probes = _cells(_embedded(fps), max_bits)
    seekers = homes.withColumn("home", F.lit(True)).unionByName(probes.withColumn("home", F.lit(False)))
    counts = (seekers.groupBy("part", "cell")
              .agg(F.count("*").alias("n"), F.sum(F.col("home").cast("int")).alias("n_home")))
    dense = written(counts.filter((F.col("n_home") > 0) & (F.col("n") * F.col("n_home") > dense_pairs)), "simhash-dense")
    near = F.expr(f"bit_count(e ^ e2) <= {max_bits} AND bit_count(fp ^ fp2) <= {max_bits}")
    at_home = homes.withColumnsRenamed({"part": "part2", "cell": "cell2", "fp": "fp2", "e": "e2"})
    met = (F.col("part") == F.col("part2")) & (F.col("cell") == F.col("cell2"))
    once = (~F.col("home")) | (F.col("fp") < F.col("fp2"))
    if dense.isEmpty():
        return seekers.join(at_home, met & once & near).select(F.col("fp").alias("a"), F.col("fp2").alias("b")).distinct()
    light = seekers.join(dense, ["part", "cell"], "left_anti")
    found = light.join(at_home, met & once & near).select(F.col("fp").alias("a"), F.col("fp2").alias("b"))
    return found.unionByName(_dense_links(seekers, homes, dense, max_bits, block)).distinct()


def _dense_links(seekers: DataFrame, homes: DataFrame, dense: DataFrame, max_bits: int, block: int) -> DataFrame:
    blocks = dense.select("part", "cell", F.ceil(F.col("n") / block).cast("int").alias("nl"),
                          F.ceil(F.col("n_home") / block).cast("int").alias("nr"))
    deal = lambda salt, n: F.pmod(F.xxhash64("fp", F.lit(salt)), F.col(n)).cast("int")
    left = (seekers.join(blocks, ["part", "cell"])
            .select("part", "cell", deal(1, "nl").alias("i"), F.explode(F.sequence(F.lit(0), F.col("nr") - 1)).alias("j"), "fp", F.lit(0).alias("side")))
    right = (homes.join(blocks, ["part", "cell"])
             .select("part", "cell", F.explode(F.sequence(F.lit(0), F.col("nl") - 1)).alias("i"), deal(2, "nr").alias("j"), "fp", F.lit(1).alias("side")))

    def compare(group: pa.Table) -> pa.Table:
        fp, side = (np.array(group.column(c).to_numpy()) for c in ("fp", "side"))
        a, b = fp[side == 0].view(np.uint64), fp[side == 1].view(np.uint64)
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.setdefault(x, x) != x:
                root[x] = x = root[root[x]]
            return x

        out_a, out_b = [], []
        for x in a:
            for y in b[np.bitwise_count(b ^ x) <= max_bits].tolist():
                rx, ry = find(int(x)), find(y)
                if rx != ry:
                    root[rx] = ry
                    out_a.append(int(x)), out_b.append(y)
        return pa.table({"a": pa.array(np.array(out_a, np.uint64).view(np.int64), pa.int64()),
                         "b": pa.array(np.array(out_b, np.uint64).view(np.int64), pa.int64())})

    return (left.unionByName(right).groupBy("part", "cell", "i", "j").applyInArrow(compare, "a long, b long")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))


def connected(edges: DataFrame) -> DataFrame:
    """Connected components of links (a, b): (node, root), root the smallest node of its component."""
    edges = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .filter("u <> v").distinct(), "links")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.*").filter("u <> v").distinct()
        edges = written(small, "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now


def component_of(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Per distinct fingerprint of (fp, doc_id): fp, component_id (smallest doc_id of its component)."""
    lowest = written(fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-distinct")
    roots = connected(links(lowest.select("fp"), max_bits))
    placed = (lowest.join(roots, F.col("fp") == F.col("node"), "left")
              .select("fp", "low", F.coalesce("root", "fp").alias("root")))
    groups = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    return written(placed.join(groups, "root").select("fp", "component_id"), "simhash-components")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """Per input row: doc_id, fingerprint (16 hex digits), component_id."""
    marked = with_fingerprints(docs.select("doc_id", "text"), shingle)
    slim = written(marked.select("doc_id", F.col("__fp").alias("fp")), "simhash")
    return slim.join(component_of(slim, max_bits), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: its smallest doc_id (nulls last), and of
    repeated rows the first."""
    marked = written(with_fingerprints(docs, shingle).withColumn("__row", F.monotonically_increasing_id()), "simhash-docs")
    slim = marked.select(F.col("__fp").alias("fp"), "doc_id", "__row")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__row"))
    best = written(slim.groupBy("fp").agg(first.alias("best")), "simhash-best")
    roots = connected(links(best.select("fp"), max_bits))
    keep = (best.join(roots, F.col("fp") == F.col("node"), "left")
            .groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("best").alias("best"))
            .select(F.col("best.__row").alias("__row")))
    return marked.join(keep, "__row", "left_semi").select(*docs.columns)
