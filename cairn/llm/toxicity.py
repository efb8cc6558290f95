"""Toxicity by class-conditional Kneser-Ney models.

Two bigram models, one of toxic and one of ordinary labelled texts, score every word of a text:

    P_c(w | v) = (m_c(v w) + (SHARED + rest(v) * P(w)) * P_c(w) / P(w)) / norm_c(v)
    P_c(w)     = (m_c(w) + 2 B(w) S_c(w)) / norm_c

m_c(v w) are the texts of class c that hold the bigram (so that one repetitive text does not count
as many), less the discount D, and m_c(w) the distinct words seen before w (Kneser-Ney continuation
counts), less D. P is the mean of both classes' P_c(w). Every counted bigram is kept. All rows of
both classes are counted, so the counts are made comparable: bigrams by the classes' mass and then by
the context's mass in both classes, and continuation counts, which grow slower than the mass, by what
a sample of the smaller class's mass would be expected to show.
``B`` are backoff counts shared by both classes: the discounted mass spread by the pooled
continuation counts, plus ``SHARED`` counts for every word; bigrams get the pooled discounted mass
``rest`` of their context and ``SHARED`` counts too. An unseen bigram has its word's ratio.

A rare or unseen word backs off to the words that begin like it, so inflected forms share their
counts: S_c(w) is class c's share of the backoff counts, taken from the texts that hold a word with
the same first bytes. Prefixes of ``PREFIXES`` bytes are smoothed one by the next shorter, the shortest
by an even share, each with ``STEM`` counts:

    S_c(prefix) = (n_c(prefix) + STEM * S_c(shorter prefix)) / (n_0 + n_1 + STEM)

What was seen too rarely in any form to tell the classes apart gets an even share, and its
log-likelihood ratio stays near 0.

Texts are compared by a length-normalised log-likelihood ratio. It is the mean per word over the
text's most telling span, its two most toxic words, not over the whole text: a few insults make a
text toxic however long it is, and a mean over all words would let length dilute them. A rising
logistic curve, fitted on labelled rows that were not counted, turns it into the score.

Fitting uses a bounded sample of labelled rows by smallest hash of the id: up to ``MAX_ROWS`` per
class are counted, however many the other class has (each class is normalised by its own mass), and
up to ``MAX_ROWS`` per class of the others calibrate the curve, weighed back to the true shares. The ids are broadcast, at most 4 * ``MAX_ROWS``. Words live in hashed tables of fixed size (``WORD_BITS``,
``PAIR_BITS``, ``CONTEXT_BITS``, ``PREFIX_BITS``: 68 MB in all), which bounds the broadcast model whatever the
sample holds. Counting is a Spark aggregate over (previous word, word) pairs.

Defined results: null and empty texts get the score of a zero ratio; a doc_id with several
labels counts as toxic if one says so; null labels and ids are ignored in fitting. Without labels
of both classes every score is the known share of toxic labels (0 if there are none). All rows of
``docs`` are scored with all their columns kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .tables import schema_with, written
from .words import hashed_prefixes, in_parts, mixed

MAX_ROWS = 20_000
CALIBRATE_EVERY = 4
DISCOUNT = 0.75
SHARED = 4.0
STEM = 2.0
PREFIXES = (4, 6, 8)
WORD_BITS, PAIR_BITS, CONTEXT_BITS, PREFIX_BITS = 21, 21, 20, 19
THRESHOLD = 0.7
PARTS = 1 << 20
START = np.uint64(1)                       # the word before the first
STEMS = tuple(range(2, 2 + len(PREFIXES)))  # in its place for rows that count prefixes


def _pairs(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Hashes of all words and of the words before them, the texts' bounds, and hashes of the prefixes."""
    (w, *stems), at = hashed_prefixes(texts, (None, *PREFIXES))
    v = np.empty_like(w)
    v[1:] = w[:-1]
    v[at[:-1][np.diff(at) > 0]] = START
    return v, w, at, stems


def _slots(v: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    pair = mixed(v * np.uint64(0x9E3779B97F4A7C15) + w)
    return ((w >> np.uint64(64 - WORD_BITS)).astype(np.int64), (pair >> np.uint64(64 - PAIR_BITS)).astype(np.int64),
            (v >> np.uint64(64 - CONTEXT_BITS)).astype(np.int64))


def labelled(labels: DataFrame, allowed: Column, max_rows: int = MAX_ROWS) -> DataFrame:
    """The bounded sample: (id, toxic, weight, part); ``allowed`` says which labels may be used."""
    rows = (labels.filter(allowed & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
            .groupBy(F.col("doc_id").alias("id")).agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic")))
    rows = written(rows.withColumn("part", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(CALIBRATE_EVERY)).cast("int")), "toxic-labels")
    n = {(r["toxic"], r["curve"]): r["count"] for r in rows.groupBy("toxic", (F.col("part") == 0).alias("curve")).count().collect()}
    picks = []
    for toxic in (0, 1):
        for curve in (False, True):
            have = n.get((toxic, curve), 0)
            take = min(max_rows, have)
            picks.append(rows.filter((F.col("toxic") == toxic) & ((F.col("part") == 0) == curve))
                         .orderBy(F.xxhash64("id"), "id").limit(take)
                         .withColumn("weight", F.lit(float(have) / max(1, take))))
    return written(picks[0].unionByName(picks[1]).unionByName(picks[2]).unionByName(picks[3]), "toxic-sample")


def _sampled(docs: DataFrame, sample: DataFrame) -> DataFrame:
    slim = docs.select(F.col("doc_id").alias("id"), F.col("text"))
    return slim.join(F.broadcast(sample), "id")          # at most 4 * MAX_ROWS rows of four numbers


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column("text").cast(pa.large_binary()).to_pylist()
        toxic = np.array(b.column("toxic").to_pylist(), bool)
        for lo, hi in in_parts(texts):
            yield _counted(texts[lo:hi], toxic[lo:hi])


def _counted(texts: list[bytes | None], toxic: np.ndarray) -> pa.RecordBatch:
    """Per pair of words, and per prefix of words, how many ordinary and toxic texts hold it."""
    v, w, at, stems = _pairs(texts)
    doc = np.repeat(np.arange(len(texts)), np.diff(at))
    v = np.concatenate([v, *(np.full(len(x), k, np.uint64) for k, x in zip(STEMS, stems))])
    w, doc = np.concatenate([w, *stems]), np.tile(doc, 1 + len(stems))
    order = np.lexsort((doc, w, v))
    v, w, doc = v[order], w[order], doc[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (w[1:] != w[:-1])
    once = new.copy()
    once[1:] |= doc[1:] != doc[:-1]
    first = np.flatnonzero(new)
    sums = [np.add.reduceat((x & once).astype(np.int64), first) if len(first) else first for x in (~toxic[doc], toxic[doc])]
    return pa.record_batch({"v": v[first].view(np.int64), "w": w[first].view(np.int64), "n0": sums[0], "n1": sums[1]})


def _table(rows: DataFrame, bits: int, columns: list[str]) -> list[np.ndarray]:
    """Sums per slot (at most 2**bits rows) as arrays."""
    got = rows.toArrow()
    out = []
    for c in columns:
        a = np.zeros(1 << bits, np.float32)
        a[got.column("slot").to_numpy()] = got.column(c).to_numpy()
        out.append(a)
    return out


def fit_counts(docs: DataFrame, sample: DataFrame) -> dict[str, np.ndarray]:
    """The two models as hashed tables of fixed size."""
    pairs = _sampled(docs, sample).mapInArrow(_count, "v long, w long, n0 long, n1 long")
    counted = written(pairs.groupBy("v", "w").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")), "toxic-pairs")
    pairs = counted.filter(~F.col("v").isin(*STEMS))
    slot = lambda c, bits: F.shiftrightunsigned(c, 64 - bits).alias("slot")
    mass = pairs.agg(*(F.coalesce(F.sum(f"n{c}"), F.lit(0)).alias(f"n{c}") for c in (0, 1))).first()
    part = [max(1, min(mass)) / max(1, m) for m in mass]          # the smaller class, as a share of this one
    seen = [F.sum((F.col(f"n{c}") > 0).cast("long")).alias(f"k{c}") for c in (0, 1)]
    # whole parts, so that the sums don't depend on their order
    seen += [F.sum(F.round((1 - F.pow(F.lit(1 - part[c]), F.col(f"n{c}"))) * PARTS).cast("long")).alias(f"e{c}") for c in (0, 1)]
    uses = [F.sum(f"n{c}").alias(f"c{c}") for c in (0, 1)]
    k = _table(pairs.groupBy(slot("w", WORD_BITS)).agg(*seen), WORD_BITS, ["k0", "k1", "e0", "e1"])
    k, even = k[:2], [x / PARTS for x in k[2:]]
    kept = [F.sum(F.greatest(F.col(f"n{c}") - DISCOUNT, F.lit(0.0))).alias(f"m{c}") for c in (0, 1)]
    ctx = _table(pairs.groupBy(slot("v", CONTEXT_BITS)).agg(*uses, *kept), CONTEXT_BITS, ["c0", "c1", "m0", "m1"])

    used, held = ([x * np.float32(part[c]) for c, x in enumerate(t)] for t in (ctx[:2], ctx[2:]))
    least = np.minimum(used[0], used[1])
    level = [(least + SHARED) / (x + SHARED) for x in used]
    given = docs.sparkSession.sparkContext.broadcast(level)   # fixed size

    def to_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v, w = (b.column(c).to_numpy().view(np.uint64) for c in ("v", "w"))
            _, pair, at = _slots(v, w)
            m = [np.maximum(b.column(f"n{c}").to_numpy() - DISCOUNT, 0) * part[c] * given.value[c][at] for c in (0, 1)]
            yield pa.record_batch({"slot": pair, **{f"m{c}": np.rint(x * PARTS).astype(np.int64) for c, x in enumerate(m)}})

    # each pair is brought to its own context's size before it meets others in a slot
    big = _table(pairs.mapInArrow(to_slots, "slot long, m0 long, m1 long").groupBy("slot")
                 .agg(F.sum("m0").alias("m0"), F.sum("m1").alias("m1")), PAIR_BITS, ["m0", "m1"])
    given.unpersist()
    pooled = even[0] + even[1]
    types = [max(1.0, float(np.minimum(x, 1).sum())) for x in even]
    share = np.maximum(pooled - DISCOUNT, 0) + DISCOUNT * (pooled > 0).sum() / len(pooled)
    shared = DISCOUNT * sum(types) / 2 * share / max(1.0, float(share.sum())) + SHARED
    scale = max(1.0, float(even[1].sum()))
    model, whole = {}, []
    for c in (0, 1):
        left = np.maximum(k[c] - DISCOUNT, 0) * even[c] / np.maximum(k[c], 1) / max(1.0, float(even[c].sum())) * scale
        whole.append(float((left + shared).sum(dtype=np.float64)))
        model[f"own{c}"] = (left / whole[c]).astype(np.float32)
        model[f"pair{c}"] = big[c] / np.float32(PARTS)
    model["shared"] = (shared / (sum(whole) / 2)).astype(np.float32)
    for level_of, cut in zip(STEMS, PREFIXES):
        stems = counted.filter(F.col("v") == level_of).groupBy(slot("w", PREFIX_BITS)).agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        for c, n in enumerate(_table(stems, PREFIX_BITS, ["n0", "n1"])):
            model[f"stem{cut}_{c}"] = n * np.float32(part[c])
    p = [model[f"own{c}"] + model["shared"] for c in (0, 1)]
    mean = (p[0] + p[1]) / 2
    model["rest"] = (used[0] + used[1] - held[0] - held[1]) / 2
    norm = [held[c] * level[c] + model["rest"] + SHARED * float((p[c] / mean).sum(dtype=np.float64)) for c in (0, 1)]
    model["norm"] = np.log(norm[0] / norm[1]).astype(np.float32)
    return model


def ratios(texts: list[bytes | None], model: dict[str, np.ndarray]) -> np.ndarray:
    """Per text: the mean log-likelihood ratio of its two most toxic words (of one, if it has one)."""
    parts = [_ratios(texts[lo:hi], model) for lo, hi in in_parts(texts)]
    return np.concatenate([np.zeros(0), *parts])


def _shares(stems: list[np.ndarray], model: dict[str, np.ndarray]) -> list[np.ndarray]:
    """Per word each class's share of its backoff counts, from words that begin like it. Each is smoothed
    by itself: 1 less the other is 0 in short floats where thousands of texts of one class hold a word
    and none of the other."""
    shares = [np.float32(0.5)] * 2
    for cut, h in zip(PREFIXES, stems):
        at = (h >> np.uint64(64 - PREFIX_BITS)).astype(np.int64)
        counts = [model[f"stem{cut}_{c}"][at] for c in (0, 1)]
        shares = [(n + np.float32(STEM) * s) / (counts[0] + counts[1] + np.float32(STEM)) for n, s in zip(counts, shares)]
    return shares


def _ratios(texts: list[bytes | None], model: dict[str, np.ndarray]) -> np.ndarray:
    v, w, at, stems = _pairs(texts)
    word, pair, ctx = _slots(v, w)
    plain, toxic = (model[f"own{c}"][word] + 2 * s * model["shared"][word] for c, s in enumerate(_shares(stems, model)))
    mean = (plain + toxic) / 2
    shared = (SHARED + model["rest"][ctx] * mean) / mean
    toxic, plain = (model[f"pair{c}"][pair] + shared * p for c, p in ((1, toxic), (0, plain)))
    ratio = (np.log(toxic / plain) + model["norm"][ctx]).astype(np.float64)
    n = np.diff(at)
    some = np.flatnonzero(n > 0)
    out = np.zeros(len(texts))
    if len(some):
        first = np.maximum.reduceat(ratio, at[some])
        place = np.repeat(np.arange(len(some)), n[some])
        top = np.flatnonzero(ratio == first[place])
        ratio[top[np.unique(place[top], return_index=True)[1]]] = -np.inf
        second = np.where(n[some] > 1, np.maximum.reduceat(ratio, at[some]), first)
        out[some] = (first + second) / 2
    return out


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.01) -> np.ndarray:
    """Slope (at least 0) and intercept of a ridge logistic regression, by Newton steps."""
    x = np.c_[x, np.ones(len(x))]
    b = np.zeros(2)
    hold = ridge * np.diag([1.0, 1e-3])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + hold
        step = np.linalg.solve(h, x.T @ (weight * (y - p)) - hold @ b)
        b += step / max(1.0, np.abs(step).max() / 5)
    share = float((weight * y).sum() / weight.sum())
    return b if b[0] > 0 else np.array([0.0, np.log(share / (1 - share))])


def fit(docs: DataFrame, labels: DataFrame, allowed: Column, max_rows: int = MAX_ROWS) -> dict[str, np.ndarray]:
    """Model arrays and ``curve``, slope and intercept of the score."""
    sample = labelled(labels, allowed, max_rows)
    model = fit_counts(docs, sample.filter(F.col("part") > 0))
    given = docs.sparkSession.sparkContext.broadcast(model)   # hashed tables of fixed size

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            r = ratios(b.column("text").cast(pa.large_binary()).to_pylist(), given.value)
            yield pa.record_batch({"toxic": b.column("toxic"), "weight": b.column("weight"), "ratio": r})

    held = _sampled(docs, sample.filter("part = 0")).mapInArrow(measure, "toxic int, weight double, ratio double").toArrow()
    x, y = held.column("ratio").to_numpy(), held.column("toxic").to_numpy().astype(float)
    if len(y) and 0 < y.sum() < len(y):
        curve = _logistic(x, y, held.column("weight").to_numpy())
    else:
        share = labels.filter(allowed).agg(F.avg((F.col("toxic") > 0).cast("double"))).first()[0] or 0.0
        curve = np.array([0.0, np.log(max(share, 1e-9) / max(1 - share, 1e-9))])
    given.unpersist()
    return {**model, "curve": curve}


def with_scores(docs: DataFrame, model: dict[str, np.ndarray], name: str = "score") -> DataFrame:
    """``docs`` with all its columns and the score in ``name``."""
    given = docs.sparkSession.sparkContext.broadcast(model)   # hashed tables of fixed size
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            r = ratios(b.column(at).cast(pa.large_binary()).to_pylist(), given.value)
            z = given.value["curve"][0] * r + given.value["curve"][1]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500))))],
                                             names=[*b.schema.names, name])

    return docs.mapInArrow(run, schema_with(docs, name, T.DoubleType()))


def fold(doc_id: Column) -> Column:
    """crc32 of the id's text, modulo 3 (null id: of the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted; labels of held-out ids are never learnt from."""
    model = fit(docs, labels, fold(F.col("doc_id")) != 1, max_rows)
    return with_scores(docs.select("doc_id", "text"), model).select(
        "doc_id", (fold(F.col("doc_id")) == 1).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, max_rows: int = MAX_ROWS) -> DataFrame:
    """``docs`` without the rows that score at or above the threshold."""
    model = fit(docs, labels, fold(F.col("doc_id")) != 1, max_rows)
    return with_scores(docs, model, "__toxic").filter(F.col("__toxic") < threshold).drop("__toxic")
