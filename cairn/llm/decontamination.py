"""Benchmark decontamination by latent semantic retrieval.

1. One pass over all documents counts hashed words: document frequencies give the IDF weights (at
   least ``LEAST_IDF``, so no word counts for nothing), token counts how surprising a word is.
2. Benchmark items are cut into passages of up to ``PASSAGE`` words, in blocks of at most ``RANK``
   passages. A randomised SVD of a block's TF-IDF passages (sketch, power iterations, orthonormal
   basis, rotation; the products with the passage matrix are Spark jobs) gives the latent space. With
   as many dimensions as passages, inner products with passages are kept.
3. Every document is read whole in overlapping windows of three halves of ``HALF`` words. A window's
   TF-IDF vector is projected on the latent space; candidates are the passages with a cosine of at
   least ``WEIGHT`` times the passage's norm over the window's, that is, whose words in the window
   carry ``WEIGHT`` of the passage's IDF (weights are square roots of the IDF, so that inner products
   are sums of it). The bound follows each passage's own norm, so short and common passages pass
   by the same rule as long and rare ones, whatever the size of the corpus.
4. A candidate of L words is compared with the 2 L words from every multiple of L on: the longest
   common subsequence (LCS) must cover ``VERBATIM`` of the passage, or ``PARAPHRASE`` of it and, if
   the item has one (column ``answer``), the answer, found near by to ``VERBATIM``. The words in common
   must carry ``WEIGHT`` of the passage's IDF, and must not be there by chance: with words drawn
   independently at their corpus frequencies, the expected number of such matches in the whole
   corpus, over all places, passages and ways to choose the words, must stay below ``CHANCE``. A word
   or two of common words can never prove a leak; such items match nothing.

Sent to the tasks at once: up to ``GROUP_BLOCKS`` blocks, each a basis of at most ``RANK`` columns over
at most ``RANK * PASSAGE`` words (8 MB), and two tables of 2**``SLOT_BITS`` floats. A larger benchmark is
a series of such groups, each one pass over the documents, whose result is written before the next.
Nothing about documents is collected but the tables of frequencies, whose size is fixed.

Defined results: null or empty texts and items match nothing; an empty benchmark or document table
gives no pairs. Repeated rows give one pair per (doc_id, item_id), the best. For items without an
answer the result's ``answer`` tells whether the last ``ANSWER_WORDS`` words occur near by. Other
columns are ignored, and kept by ``without_leaks``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .tables import written
from .words import hashed_words, in_parts

SLOT_BITS = 18
PASSAGE = 32
HALF = 32
RANK = 256
GROUP_BLOCKS = 8
LEAST_IDF = 0.25
WEIGHT = 0.4
VERBATIM = 0.8
PARAPHRASE = 0.6
CHANCE = 0.01
ANSWER_WORDS = 5
_MARKS = re.compile(rb"[!-/:-@\[-`{-~]+")


def _plain(text: bytes | None) -> bytes:
    """Lower-cased ASCII, punctuation as spaces, so words meet whatever surrounds them."""
    return _MARKS.sub(b" ", text or b"").lower()


def _slots(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _distinct(keys: np.ndarray) -> np.ndarray:
    keys = np.sort(keys)
    return keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys


def word_statistics(docs: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """IDF and surprise (-log frequency) by hashed word, and the number of words; from all documents."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 1 << SLOT_BITS
        for b in batches:
            texts, n, c = b.column("text").cast(pa.large_binary()).to_pylist(), np.zeros(size, np.int64), np.zeros(size, np.int64)
            for lo, hi in in_parts(texts):
                h, at = hashed_words([_plain(t) for t in texts[lo:hi]])
                slot = _slots(h)
                seen = _distinct((np.repeat(np.arange(hi - lo, dtype=np.int64), np.diff(at)) << SLOT_BITS) | slot)
                n += np.bincount(seen & (size - 1), minlength=size)
                c += np.bincount(slot, minlength=size)
            slot = np.flatnonzero(n)
            yield pa.record_batch({"slot": np.append(slot, -1), "docs": np.append(n[slot], b.num_rows), "words": np.append(c[slot], c.sum())})

    got = (docs.select("text").mapInArrow(count, "slot long, docs long, words long").groupBy("slot")
           .agg(F.sum("docs").alias("docs"), F.sum("words").alias("words")).toArrow())
    slot, n, c = (got.column(x).to_numpy() for x in ("slot", "docs", "words"))
    total, words = int(n[slot < 0].sum()), int(c[slot < 0].sum())
    df, cf = np.ones(1 << SLOT_BITS), np.ones(1 << SLOT_BITS)
    df[slot[slot >= 0]], cf[slot[slot >= 0]] = n[slot >= 0], c[slot >= 0]
    idf = np.maximum(np.log((total + 1) / df), LEAST_IDF)
    return idf.astype(np.float32), np.log(max(1, words) / cf).astype(np.float32), words


def chance_bound(words: int, passages: int) -> float:
    """Surprise that a match must have, so that fewer than ``CHANCE`` are expected in a corpus."""
    return math.log(max(1, words)) + math.log(max(1, passages)) - math.log(CHANCE)


def _ways(n: int, k: int) -> float:
    return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)


def _passages(items: list[tuple[int, bytes, bytes | None]], idf: np.ndarray, surprise: np.ndarray) -> list[dict]:
    """Passages of up to ``PASSAGE`` words; the last one of an item ends where the item ends."""
    out = []
    for item, text, answer in items:
        words = _plain(text).split()
        told = _plain(answer).split() if answer else words[-ANSWER_WORDS:]
        last = max(0, len(words) - PASSAGE)
        for lo in [*range(0, last, PASSAGE), last] if words else []:
            part = words[lo:lo + PASSAGE]
            slot = _slots(hashed_words([b" ".join(part)])[0])
            own, place = np.unique(slot, return_inverse=True)
            root = np.sqrt(idf[own])
            out.append({"item": item, "words": part, "idf": idf[slot].tolist(), "nats": surprise[slot].tolist(), "answer": told,
                        "told": bool(answer), "slots": own, "vector": (np.bincount(place) * root).astype(np.float32),
                        "root": root, "weight": float(idf[slot].sum())})
    return out


def _latent(spark, passages: list[dict], rank: int, power: int = 2, seed: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Randomised SVD of the passage matrix: its words' slots, the latent basis (words x rank) and
    the passages in it."""
    slots = np.unique(np.concatenate([p["slots"] for p in passages]))
    width = min(rank + 8, len(passages), len(slots))
    rows = spark.createDataFrame(pa.table({
        "pid": pa.array(range(len(passages)), pa.int64()),
        "cols": pa.array([np.searchsorted(slots, p["slots"]) for p in passages], pa.list_(pa.int64())),
        "vals": pa.array([p["vector"] for p in passages], pa.list_(pa.float32()))})).repartition(4, "pid")

    def product(basis: np.ndarray | None) -> np.ndarray:
        """A^T (A basis), or A^T times a random matrix: each task sums its passages' share, in the
        rows of their words only, so all shares together are no larger than the block's words."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cols, parts = [], []
            for b in batches:
                for pid, c, v in zip(*(b.column(x).to_pylist() for x in ("pid", "cols", "vals"))):
                    c, v = np.array(c), np.array(v, np.float32)
                    right = np.random.default_rng([seed, pid]).standard_normal(width) if basis is None else v @ basis[c]
                    cols.append(c)
                    parts.append(np.outer(v, right).astype(np.float32))
            if cols:
                own, at = np.unique(np.concatenate(cols), return_inverse=True)
                total = np.zeros((len(own), width), np.float32)
                np.add.at(total, at, np.concatenate(parts))
                yield pa.record_batch({"cols": pa.array([own], pa.list_(pa.int64())), "part": pa.array([total.tobytes()], pa.binary())})

        got, total = rows.mapInArrow(run, "cols array<long>, part binary").toArrow(), np.zeros((len(slots), width), np.float32)
        for c, part in zip(got.column("cols"), got.column("part")):
            total[np.array(c.as_py())] += np.frombuffer(part.as_buffer(), np.float32).reshape(-1, width)
        return total

    basis = np.linalg.qr(product(None))[0]
    for _ in range(power):
        basis = np.linalg.qr(product(basis.astype(np.float32)))[0]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [np.array(v, np.float32) @ basis[np.array(c)] for c, v in zip(b.column("cols").to_pylist(), b.column("vals").to_pylist())]
            yield pa.record_batch({"pid": b.column("pid"), "at": pa.array([x.astype(np.float32) for x in out], pa.list_(pa.float32()))})

    got = rows.mapInArrow(project, "pid long, at array<float>").toArrow().sort_by("pid")
    at = np.array(got.column("at").to_pylist(), np.float32)
    turn = np.linalg.svd(at, full_matrices=False)[2][:rank]
    return slots, (basis @ turn.T).astype(np.float32), at @ turn.T


def lcs_length(a: list[bytes], b: list[bytes]) -> int:
    """Longest common subsequence of two word lists, one bit per word of ``a``."""
    where: dict[bytes, int] = {}
    for i, w in enumerate(a):
        where[w] = where.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for w in b:
        hit = row & where.get(w, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _matched(passage: dict, text: list[bytes], bound: float) -> float:
    """The share of the passage that the LCS with ``text`` covers, 0 where chance could bring it."""
    words, there = passage["words"], set(text)
    here = [i for i, w in enumerate(words) if w in there]
    if len(here) < PARAPHRASE * len(words) or sum(passage["idf"][i] for i in here) < WEIGHT * passage["weight"]:
        return 0.0                             # the LCS can't hold more
    k = lcs_length(words, text)
    if k < PARAPHRASE * len(words):
        return 0.0
    nats = sorted(passage["nats"][i] for i in here)[:k]                 # the least that k of them can say
    weight = sum(sorted(passage["idf"][i] for i in here)[:k])
    if k < len(words) and weight < WEIGHT * passage["weight"]:
        return 0.0
    whole = k == len(words) and any(text[i:i + k] == words for i in range(len(text) - k + 1))
    ways = 0.0 if whole else _ways(len(text), k) + _ways(len(words), k)
    return k / len(words) if sum(nats) - ways >= bound else 0.0


def _checked(passage: dict, words: list[bytes], half: int, bound: float) -> tuple[float, bool] | None:
    """(share, answer found) of the best match that starts in one half window, if any."""
    size, best = len(passage["words"]), 0.0
    first = -(-half * HALF // size) * size
    for start in range(first, min((half + 1) * HALF, len(words)), size):
        best = max(best, _matched(passage, words[start:start + 2 * size], bound))
    if not best:
        return None
    near = words[max(0, (half - 1) * HALF):(half + 4) * HALF]
    answer = lcs_length(passage["answer"], near) >= VERBATIM * len(passage["answer"])
    return (best, answer) if best >= VERBATIM or answer or not passage["told"] else None


def _search(texts: list[bytes | None], group: dict) -> list[tuple[int, int, float, float, bool]]:
    """(text, item, cosine, LCS share, answer found) of the texts of one batch."""
    return [(lo + d, *rest) for lo, hi in in_parts(texts) for d, *rest in _searched(texts[lo:hi], group)]


def _searched(texts: list[bytes | None], group: dict) -> list[tuple[int, int, float, float, bool]]:
    plain = [_plain(t) for t in texts]
    h, at = hashed_words(plain)
    if not len(h):
        return []
    slot, n = _slots(h), np.diff(at)
    halves = -(-n // HALF)
    first = np.cumsum(halves) - halves
    total = int(halves.sum())
    doc = np.repeat(np.arange(len(texts)), n)
    mine = first[doc] + (np.arange(len(h)) - at[:-1][doc]) // HALF
    own = np.repeat(np.arange(len(texts)), halves)
    norm = np.sqrt(np.maximum(_windows(np.bincount(mine, group["idf"][slot], minlength=total)[:, None], own)[:, 0], 1e-12))
    known = group["known"][slot]
    told = _distinct((mine[known] << SLOT_BITS) | slot[known])          # a word counts once a half
    mine, slot = told >> SLOT_BITS, told & ((1 << SLOT_BITS) - 1)
    found, words = {}, {}
    for block in group["blocks"]:
        row = block["where"][slot]
        known = row >= 0
        vectors = _half_vectors(mine[known], row[known], total, block["basis"])
        vectors = _windows(vectors, own)
        near = np.flatnonzero(np.einsum("ij,ij->i", vectors, vectors) >= block["least"] ** 2)
        for lo in range(0, len(near), 4096):
            part = near[lo:lo + 4096]
            product = vectors[part] @ block["at"].T
            for i, p in zip(*np.nonzero(product >= block["need"])):
                win, passage = int(part[i]), block["passages"][p]
                d = int(own[win])
                key = (d, passage["item"])
                if key in found and found[key][1] == 1.0:
                    continue
                if d not in words:
                    words = {d: plain[d].split()}
                check = _checked(passage, words[d], win - int(first[d]), group["bound"])
                if check and (key not in found or check[0] > found[key][1]):
                    found[key] = (float(product[i, p] / (norm[win] * block["norms"][p])), *check)
    return [(d, item, *v) for (d, item), v in sorted(found.items())]


def _half_vectors(mine: np.ndarray, row: np.ndarray, total: int, basis: np.ndarray) -> np.ndarray:
    """Sums of the basis rows of each half's words, a few hundred halves at a time (they fit the cache)."""
    count = np.bincount(mine, minlength=total)
    place = np.arange(len(mine)) - (np.cumsum(count) - count)[mine]
    at = np.full((total, int(count.max(initial=0))), len(basis) - 1)          # the last row is zero
    at[mine, place] = row
    out = np.zeros((total, basis.shape[1]), np.float32)
    for lo in range(0, total, 512):
        for k in range(int(count[lo:lo + 512].max(initial=0))):
            out[lo:lo + 512] += basis[at[lo:lo + 512, k]]
    return out


def _windows(halves: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Sums of each half window and the two after it in the same text."""
    out = halves.copy()
    for k in (1, 2):
        same = own[k:] == own[:-k]
        out[:-k][same] += halves[k:][same]
    return out


def _groups(docs: DataFrame, benchmark: DataFrame, rank: int) -> Iterator[dict]:
    """Latent spaces of the benchmark, in groups of blocks."""
    spark = docs.sparkSession
    answer = F.col("answer").cast("binary") if "answer" in benchmark.columns else F.lit(None).cast("binary")
    items = benchmark.filter(F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"),
                                                               F.col("text").cast("binary").alias("text"), answer.alias("answer"))
    count = items.count()
    if not count:
        return
    idf, surprise, words = word_statistics(docs)
    # every passage is a place where chance may strike
    bound = chance_bound(words, items.select(F.sum(F.octet_length("text") / PASSAGE + 1)).first()[0])
    parts = -(-count // (GROUP_BLOCKS * rank // 2))
    for part in range(parts):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).toArrow().to_pylist()
        passages = [p for p in _passages([(r["item_id"], r["text"], r["answer"]) for r in rows], idf, surprise)
                    if sum(p["nats"]) >= bound]
        for lo in range(0, len(passages), GROUP_BLOCKS * rank):
            some = passages[lo:lo + GROUP_BLOCKS * rank]
            blocks = [_block(spark, some[i:i + rank], rank) for i in range(0, len(some), rank)]
            known = np.any([b["where"] >= 0 for b in blocks], axis=0)
            yield {"idf": idf, "bound": bound, "blocks": blocks, "known": known}


def _block(spark, passages: list[dict], rank: int) -> dict:
    slots, basis, at = _latent(spark, passages, rank)
    where = np.full(1 << SLOT_BITS, -1, np.int32)
    where[slots] = np.arange(len(slots))
    root = np.zeros(len(slots), np.float32)
    for p in passages:
        root[np.searchsorted(slots, p["slots"])] = p["root"]
    norms = np.array([np.linalg.norm(p["vector"]) for p in passages], np.float32)
    need = np.array([p["weight"] for p in passages], np.float32) * np.float32(WEIGHT * 0.999)          # rounding
    return {"where": where, "basis": np.vstack([basis * root[:, None], np.zeros((1, basis.shape[1]), np.float32)]), "at": at, "need": need, "norms": norms,
            "least": float((need / norms).min()), "passages": passages}


def leaks(docs: DataFrame, benchmark: DataFrame, rank: int = RANK) -> DataFrame:
    """One row per (doc_id, item_id): cosine, lcs (share of the passage), answer (found too)."""
    schema = "doc_id long, item_id long, cosine double, lcs double, answer boolean"
    spark = docs.sparkSession
    out = spark.createDataFrame([], schema)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    last = None
    for group in _groups(docs, benchmark, rank):
        if last is not None:                   # written before the next group is sent
            out = out.unionByName(written(last[0], "leaks"))
            last[1].unpersist()
        given = spark.sparkContext.broadcast(group)   # bounded: see the module's text

        def run(batches: Iterator[pa.RecordBatch], given=given) -> Iterator[pa.RecordBatch]:
            for b in batches:
                ids = b.column("doc_id").to_pylist()
                hit = _search(b.column("text").cast(pa.large_binary()).to_pylist(), given.value)
                cols = list(zip(*hit)) or [()] * 5
                yield pa.record_batch({
                    "doc_id": pa.array([ids[d] for d in cols[0]], pa.int64()), "item_id": pa.array(cols[1], pa.int64()),
                    "cosine": pa.array(cols[2], pa.float64()), "lcs": pa.array(cols[3], pa.float64()),
                    "answer": pa.array(cols[4], pa.bool_())})

        last = slim.mapInArrow(run, schema), given
    if last is not None:
        out = out.unionByName(last[0])
    best = F.max(F.struct("lcs", "cosine", "answer")).alias("b")
    return out.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "b.cosine", "b.lcs", "b.answer")


def without_leaks(docs: DataFrame, benchmark: DataFrame, rank: int = RANK) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item, with all columns."""
    out, at, last = docs, docs.columns.index("text"), None
    for group in _groups(docs, benchmark, rank):
        if last is not None:
            out = written(out, "clean")
            last.unpersist()
        given = docs.sparkSession.sparkContext.broadcast(group)

        def run(batches: Iterator[pa.RecordBatch], given=given) -> Iterator[pa.RecordBatch]:
            for b in batches:
                hit = {d for d, *_ in _search(b.column(at).cast(pa.large_binary()).to_pylist(), given.value)}
                yield b.filter(pa.array([i not in hit for i in range(b.num_rows)], pa.bool_()))

        out, last = out.mapInArrow(run, docs.schema), given
    return out
