"""Language-model scoring by online logistic context mixing.

A text is the sequence of its words and one end, coded bit by bit in order. A word's bits are its
path in a prefix code (Huffman's, over the most frequent training words, ``FREQUENT`` at most, and
one path for all others), so that frequent words take few decisions. For each bit several
predictors look up how often a 0 and a 1 followed their context in the training texts: the place in
the code alone, or with the word before, with the two words before, or with the last of the
``COMMON`` most frequent words (it tells the language); contexts with words are hashed into tables of their own. Their predictions, in the
logistic domain, are combined by weights chosen by a gate (how often the contexts of one and two
words were seen, and how deep in the code the bit lies), then refined by an adaptive table (APM)
over the mixed prediction and the depth. Weights and refinement are learned online.

A word outside the code is one of the training corpus, with its share of the counts there, or, by
the Good-Turing estimate, a new one, which is spelled: byte by byte with a terminator, eight bits
each, mixed in the same way from contexts of the last 1, 2, 3 or 4 bytes and of the whole word so
far; while a word is spelled its weights keep adapting from bit to bit. And the model adapts to each
document as it goes: after i tokens, a word met k times has probability (MEMORY * p + k) / (MEMORY + i).
Each factor is a probability given the text before, so their product is one of the whole text, and
gives total bits per byte. (It adds up to a little less than 1: spellings of known words are not used.)

1. ``encoded``: one pass over the texts; per batch of documents its distinct words and the tokens as
   numbers of these, in order. Written once.
2. ``vocabulary``: exact training counts per word, summed over batches. It grows with the corpus.
3. Spelling: counts and weights from the whole vocabulary. Only words that training has not seen are
   spelled.
4. Counts of the word contexts from every training text: each task counts in tables whose size
   follows the corpus up to ``CONTEXT_BITS``, in 64-bit integers; Spark sums their slots.
5. Weights and refinement, online over all training texts in order, each decision predicted
   without itself (leave-one-out), from tables of what a slot says without the decision at hand.
   Tasks learn apart, and the few hundred weights are averaged.
6. Words outside the code join their counts and spellings and come back to their batch, where the
   texts are scored in order.

Defined results: null and empty texts are one end. A null ``doc_id`` has the checksum of the empty
text. Words longer than ``PIECE`` bytes are spelled in pieces. Repeated rows are counted and scored as
rows. Words of equal count are taken into the code in byte order. An empty corpus gives no rows;
without training documents all counts are 0 and every word is spelled with even predictions. One
row per input row; other columns are ignored.
"""

from __future__ import annotations

import heapq
import itertools
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .tables import written
from .words import SPACES, in_parts

HELD_OUT_OF = 10
FREQUENT = 1 << 16                         # words with a path of their own in the code
CONTEXT_BITS = (21, 21, 21)                # tables of one word before, two words before, the last common word
COMMON = 32                                # so many words are common
PIECE = 40
MERGED = 3                                 # bytes in which many words of a group agree
TABLE_BITS = (16, 18, 19, 20, 21)          # contexts of 1, 2, 3, 4 bytes and of the whole word so far
DELTA = 0.1                                # what both bits have before anything is seen
LEARN_WORDS, LEARN, ADAPT, REFINE = 0.1, 0.02, 0.005, 0.02
MEMORY = 1000.0                            # tokens that what a document has shown is weighed against
LEVELS, FINE = 33, 1 << 15                  # places of the refinement; steps of a prediction that is scored
DEPTHS = 8                                 # depths in the code that the refinement tells apart
BATCH_BYTES = 6 << 20
TOKENS_A_TABLE, WORDS_A_TABLE, WORDS_A_TASK = 8_000_000, 500_000, 100_000
LANES, STEP, GROUP, SLICE, FAN_IN = 8192, 16384, 1024, 1 << 16, 64
PLAIN = bytes(32 if i in SPACES else i for i in bytes(range(256)).lower())                   # A-Z lower-cased, white space a space
ODD, SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _checksum(doc_id: int | None) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())


def _held_out(doc_id: int | None) -> bool:
    return _checksum(doc_id) % HELD_OUT_OF == 0


# ---- texts as numbered words ----------------------------------------------------------------

TEXTS = "batch long, ids array<long>, sizes array<long>, lengths array<long>, words binary, tokens binary"


class Texts(NamedTuple):
    """A batch: ids and bytes of its documents, their numbers of tokens, distinct words (0: the end), tokens."""
    batch: int
    ids: list[int | None]
    sizes: np.ndarray
    lengths: np.ndarray
    words: list[bytes]
    tokens: np.ndarray

    @classmethod
    def of(cls, rows: pa.RecordBatch | pa.Table) -> Iterator[Texts]:
        for i in range(rows.num_rows):
            r = rows.slice(i, 1).to_pylist()[0]
            yield cls(r["batch"], r["ids"], np.array(r["sizes"], np.int64), np.array(r["lengths"], np.int64),
                      r["words"].split(b" "), np.frombuffer(r["tokens"], "<i4"))

    def only(self, keep: np.ndarray) -> Texts:
        """The documents marked in ``keep``."""
        return self._replace(ids=[i for i, k in zip(self.ids, keep) if k], sizes=self.sizes[keep],
                             lengths=self.lengths[keep], tokens=self.tokens[np.repeat(keep, self.lengths)])

    def training(self) -> Texts:
        return self.only(np.array([not _held_out(i) for i in self.ids], bool))


def numbered(texts: list[bytes | None]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The distinct words of some texts, the end first, then as they come, a space between; the tokens as
    numbers of these; how many tokens each text has."""
    flat = np.frombuffer(b"".join(x for t in texts for x in (t or b"", b" ")).translate(PLAIN), np.uint8)
    end = np.cumsum(np.fromiter((len(t or b"") + 1 for t in texts), np.int64, len(texts)))
    letter = flat != 32
    first = letter.copy()
    first[1:] &= ~letter[:-1]
    first = np.flatnonzero(first)                                        # where words begin
    last = np.flatnonzero(letter[:-1] & ~letter[1:]) + 1                 # a text has a space after it
    before = np.searchsorted(first, end)                                 # words up to the end of each text
    sizes = np.insert(last - first, before, 0)                           # an end after them
    at = np.concatenate([[0, 0], np.cumsum(sizes)])                      # one end more in front, to be number 0
    flat = flat[letter]
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(flat)]).dictionary_encode()
    words = pc.binary_join(pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary), pa.scalar(b" ", pa.large_binary()))
    return words[0].as_py(), coded.indices.to_numpy()[1:], np.diff(before, prepend=0) + 1


def encoded(docs: DataFrame) -> DataFrame:
    """One row per batch of documents (``TEXTS``); a word has no space, so one space parts them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = TaskContext.get().partitionId() << 32
        for b in batches:
            texts = b.column("text").cast(pa.large_binary()).to_pylist()
            ids = b.column("doc_id").to_pylist()
            for lo, hi in in_parts(texts, BATCH_BYTES):
                words, tokens, lengths = numbered(texts[lo:hi])
                yield pa.record_batch({
                    "batch": [batch], "ids": pa.array([ids[lo:hi]], pa.list_(pa.int64())),
                    "sizes": pa.array([[len(t or b"") for t in texts[lo:hi]]], pa.list_(pa.int64())),
                    "lengths": pa.array([lengths], pa.list_(pa.int64())),
                    "words": pa.array([words], pa.binary()),
                    "tokens": pa.array([tokens.astype("<i4").tobytes()], pa.binary())})
                batch += 1

    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(run, TEXTS)


def vocabulary(texts: DataFrame) -> DataFrame:
    """(word, c): all words, the end as the empty word, and their counts in training documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in Texts.of(b):
                n = np.bincount(t.training().tokens, minlength=len(t.words)).astype(np.int64)
                for lo in range(0, len(n), 1 << 16):
                    yield pa.record_batch({"word": pa.array(t.words[lo:lo + (1 << 16)], pa.binary()), "n": n[lo:lo + (1 << 16)]})

    return texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


# ---- the word model: paths in a prefix code, contexts of the words before -------------------

class Code(NamedTuple):
    """A prefix code over words: per leaf where its path begins and how long it is; per step the
    inner node and the bit taken there. The last leaf stands for all other words."""
    leaf: dict[bytes, int]
    c: np.ndarray
    first: np.ndarray
    size: np.ndarray
    node: np.ndarray
    bit: np.ndarray
    way: np.ndarray                        # per step: node * 64 + depth as the gate tells it apart * 16 + as the refinement does * 2 + bit
    bits: tuple[int, ...]                  # of the context tables

    @property
    def starts(self) -> np.ndarray:
        """Where the predictors' slots begin: places in the code first, as they are; then the tables."""
        return np.cumsum([0, max(1, len(self.first) - 1), *(1 << b for b in self.bits)])


def prefix_code(words: list[bytes], c: list[int], others: int, bits: tuple[int, ...] = CONTEXT_BITS) -> Code:
    """Huffman's code over the words' counts and those of all other words."""
    weights = [*c, max(1, others)]
    leaves = len(weights)
    up, side = [0] * (2 * leaves), [0] * (2 * leaves)
    heap = [(w, i) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    for inner in range(leaves, 2 * leaves - 1):
        total = 0
        for s in (0, 1):
            w, i = heapq.heappop(heap)
            up[i], side[i] = inner, s
            total += w
        heapq.heappush(heap, (total, inner))
    first, size, node, bit, depth = [], [], [], [], []
    for i in range(leaves):
        path, at = [], i
        while at != 2 * leaves - 2:
            path.append((2 * leaves - 2 - up[at], side[at]))
            at = up[at]
        first.append(len(node))
        size.append(len(path))
        node += [n for n, _ in reversed(path)]
        bit += [s for _, s in reversed(path)]
        depth += range(len(path))
    node, bit, depth = (np.array(x, np.int32) for x in (node, bit, depth))
    way = node * 64 + np.minimum(depth // 3, 3) * 16 + np.minimum(depth, DEPTHS - 1) * 2 + bit
    return Code({w: i for i, w in enumerate(words)}, np.array([*c, 0], np.int64), np.array(first, np.int64),
                np.array(size, np.int64), node, bit, way, bits)


class Line(NamedTuple):
    """Tokens of documents one after another: their leaves, hashes of the contexts of one and two words
    before them, and the last common word before (its leaf + 1; 0: none)."""
    leaf: np.ndarray
    context: list[np.ndarray]
    last: np.ndarray


def in_line(code: Code, t: Texts) -> Line:
    other = len(code.first) - 1
    leaf = np.fromiter(map(code.leaf.get, t.words, itertools.repeat(other)), np.int64, len(t.words)).take(t.tokens)
    name = np.fromiter(map(zlib.crc32, t.words), np.uint64, len(t.words)) + np.uint64(1)
    one, two = np.zeros(len(leaf), np.uint64), np.zeros(len(leaf), np.uint64)                # 0: before the text begins
    start = np.cumsum(t.lengths) - t.lengths
    one[1:] = name.take(t.tokens[:-1])
    one[start] = 0
    two[1:] = one[:-1]
    two[start] = 0
    common = np.flatnonzero((leaf < min(COMMON, other)) & (t.tokens > 0))                # never the last of a text, its end
    shift = COMMON.bit_length()
    last = np.zeros(len(leaf), np.int64)                                 # place << shift | leaf + 1, carried on to the next
    last[start] = start << shift
    last[common + 1] = (common + 1) << shift | leaf[common] + 1
    np.maximum.accumulate(last, out=last)
    last &= (1 << shift) - 1
    return Line(leaf, [one * ODD, (one * SPREAD + two) * ODD + np.uint64(1)], last)


def hashed(context: np.ndarray, spread: np.ndarray, bits: int) -> np.ndarray:
    """Slots, in their table, of decisions in a context; changes ``context``."""
    context ^= spread
    context *= ODD
    context ^= context >> np.uint64(31)
    context *= ODD
    context >>= np.uint64(64 - bits)
    return context.view(np.int64)


def common_slots(code: Code) -> np.ndarray:
    """Slots, in their table, of the last common word (a row each, none first) and the place in the code."""
    words = list(itertools.islice(code.leaf, min(COMMON, len(code.first) - 1)))
    name = np.array([0, *(zlib.crc32(w) + 1 for w in words)], np.uint64)
    spread = np.arange(1, int(code.starts[1]) + 1, dtype=np.uint64) * SPREAD
    return np.stack([hashed(np.full(len(spread), x), spread, code.bits[2]) for x in name * ODD + np.uint64(2)])


class Decisions(NamedTuple):
    """All bits of some tokens in order: the token of each (from 0), the step of its path (``Code.way``),
    the place in the code, the slots of the contexts of one and two words (in their tables)."""
    at: np.ndarray
    way: np.ndarray
    node: np.ndarray
    slots: list[np.ndarray]


def decisions(code: Code, line: Line, lo: int, hi: int) -> Decisions:
    """The decisions of tokens lo to hi."""
    leaf = line.leaf[lo:hi]
    size = code.size.take(leaf)
    step = np.repeat(code.first.take(leaf) - np.cumsum(size) + size, size)
    step += np.arange(len(step))
    at = np.repeat(np.arange(hi - lo), size)
    way = code.way.take(step, mode="clip")                               # (in bounds: without a check it is faster)
    node = (way >> 6).astype(np.int64)
    spread = (node + 1).view(np.uint64)
    spread *= SPREAD
    return Decisions(at, way, node, [hashed(c[lo:hi].take(at), spread, b) for c, b in zip(line.context, code.bits)])


class Lookup(NamedTuple):
    """What decisions read, in as few places as can be. Of a slot of the contexts of one and two words, side
    by side: its prediction in the logistic domain and its share of the gate, that is how often it was
    seen (as a place in ``SEEN``) times 4 or 20. Of the place in the code, alone and with each common word: the
    prediction. ``sides`` is 2 if the tables tell apart which bit is to come."""
    near: list[np.ndarray]
    node: np.ndarray
    common: np.ndarray
    sides: int


def lookup(code: Code, seen: tuple) -> Lookup:
    """``looked_up`` or ``left_out`` arranged for ``predictions``; a ``Lookup`` (out of a broadcast, a tuple) is one already."""
    if len(seen) == len(Lookup._fields):
        return Lookup(*seen)
    stretch, level = seen
    sides = len(stretch) // int(code.starts[-1])
    start = (code.starts * sides).tolist()
    near = []
    for i, times in ((1, 4), (2, 20)):
        both = np.zeros((start[i + 1] - start[i], 2), np.float32)
        both[:, 0] = stretch[start[i]:start[i + 1]]
        both.view(np.uint32)[:, 1] = level[start[i]:start[i + 1]] * np.uint8(times)
        near.append(both.view(np.uint64).reshape(-1))
    common = stretch[start[3]:].reshape(-1, sides).take(common_slots(code), 0)
    return Lookup(near, stretch[:start[1]], common.reshape(-1), sides)


def predictions(code: Code, line: Line, table: Lookup, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Of the decisions of tokens lo to hi: the token, the step of the path, which weights to use (by how often
    the contexts of one and two words were seen, and the depth) and the prediction of each context."""
    at, way, node, slots = decisions(code, line, lo, hi)
    gate = (way >> 4).astype(np.uint8)
    gate &= np.uint8(3)
    place = (line.last[lo:hi] * int(code.starts[1])).take(at)
    place += node
    places = [*slots, node, place]
    if table.sides == 2:
        one = (way & 1).astype(np.int64)
        for x in places:
            x <<= 1
            x |= one
    inputs = []
    for x, both in zip(slots, table.near):
        both = both.take(x, mode="clip")
        inputs.append(np.ascontiguousarray(both.view(np.float32)[::2]))
        gate += both.view(np.uint32)[1::2].astype(np.uint8)
    return at, way, gate, [table.node.take(node, mode="clip"), *inputs, table.common.take(place, mode="clip")]


def new_word_mixer() -> dict[str, np.ndarray]:
    """Weights that begin with the place in the code alone: the words' shares."""
    weights = np.zeros((100, len(CONTEXT_BITS) + 2))
    weights[:, 0] = 1
    return {"weights": weights, "refine": np.repeat(_even()[None, :], DEPTHS, 0)}


def count_words(code: Code, line: Line, counts: np.ndarray) -> None:
    """Add what followed each context to ``counts`` (two rows of all slots)."""
    count_common(code, count_near(code, line, counts), counts)


def count_near(code: Code, line: Line, counts: np.ndarray) -> np.ndarray:
    """Add what followed the contexts of one and two words, decision by decision. The other contexts are few: how
    often each leaf followed each of them is returned."""
    flat, start = counts.reshape(-1), code.starts
    for lo in range(0, len(line.leaf), STEP):
        _, way, _, slots = decisions(code, line, lo, min(lo + STEP, len(line.leaf)))
        side = (way & 1).astype(np.int64)
        side *= counts.shape[1]
        for at, first in zip(slots, start[1:]):
            at += side
            at += first
            np.add.at(flat, at, 1)
    return np.bincount(line.last * len(code.first) + line.leaf, minlength=(COMMON + 1) * len(code.first))


def count_common(code: Code, followed: np.ndarray, counts: np.ndarray) -> None:
    """Add what followed the place in the code, and it with the last common word, from ``count_near``."""
    flat, start, slots = counts.reshape(-1), code.starts, common_slots(code)
    pairs = np.flatnonzero(followed)
    for lo in range(0, len(pairs), STEP):
        last, leaf = np.divmod(pairs[lo:lo + STEP], len(code.first))
        size = code.size[leaf]
        step = np.repeat(code.first[leaf] - np.cumsum(size) + size, size) + np.arange(size.sum())
        node, side = code.node[step], code.bit[step].astype(np.int64) * counts.shape[1]
        often = np.repeat(followed[pairs[lo:lo + STEP]], size)
        np.add.at(flat, node + side, often)
        np.add.at(flat, slots[np.repeat(last, size), node] + start[3] + side, often)


def looked_up(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What scoring reads of each slot: its prediction in the logistic domain, and how often it was
    seen (as a place in ``SEEN``)."""
    stretch, level = np.empty(counts.shape[1], np.float32), np.empty(counts.shape[1], np.uint8)
    for lo in range(0, len(level), SLICE):
        zero, ones = counts[:, lo:lo + SLICE]
        stretch[lo:lo + SLICE] = np.log((ones + np.float32(DELTA)) / (zero + np.float32(DELTA)))
        level[lo:lo + SLICE] = np.searchsorted(SEEN, zero + ones)
    return stretch, level


def costs(mixer: dict) -> np.ndarray:
    """Bits that a 0 and a 1 cost, per depth of the refinement and step of the mixed prediction."""
    depth, dot = np.arange(DEPTHS)[:, None], np.linspace(-8, 8, FINE + 1)
    _, final, _, _ = _refined(mixer["refine"], depth, np.broadcast_to(dot, (DEPTHS, FINE + 1)))
    return -np.log2(np.stack([1 - final, final], 1)).astype(np.float32)


def path_bits(code: Code, line: Line, seen: tuple, mixer: dict) -> np.ndarray:
    """Bits of each token's path given the words before it. The mixed prediction is taken at the
    nearest of ``FINE`` steps, whose costs are computed once."""
    bits = np.zeros(len(line.leaf))
    table = lookup(code, seen)
    cost = costs(mixer).reshape(-1)
    weights = [np.ascontiguousarray(w) for w in (mixer["weights"].T * (FINE / 16)).astype(np.float32)]
    for lo in range(0, len(bits), STEP):
        hi = min(lo + STEP, len(bits))
        at, way, gate, inputs = predictions(code, line, table, lo, hi)
        gate = gate.astype(np.int64)
        dot = weights[-1].take(gate)
        for w, x in zip(weights, inputs):
            w = w.take(gate)
            w *= x
            dot += w
        dot += np.float32(FINE / 2 + 0.5)
        np.clip(dot, 0, FINE, out=dot)
        step = dot.astype(np.int64)
        way &= 15
        way *= FINE + 1
        step += way
        bits[lo:hi] = np.bincount(at, cost.take(step, mode="clip"), minlength=hi - lo)
    return bits


def left_out(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What learning reads of each slot and the bit to come (place 2 * slot + bit): the slot's prediction
    in the logistic domain and how often it was seen (as a place in ``SEEN``), without that decision."""
    stretch, level = np.empty((counts.shape[1], 2), np.float32), np.empty((counts.shape[1], 2), np.uint8)
    for lo in range(0, len(level), SLICE):
        for bit in (0, 1):
            zero, ones = counts[:, lo:lo + SLICE].astype(np.float32)
            if bit:
                ones = np.maximum(ones - 1, 0)
            else:
                zero = np.maximum(zero - 1, 0)
            stretch[lo:lo + SLICE, bit] = np.log((ones + np.float32(DELTA)) / (zero + np.float32(DELTA)))
            level[lo:lo + SLICE, bit] = np.searchsorted(SEEN, zero + ones)
    return stretch.reshape(-1), level.reshape(-1)


def learn_words(code: Code, line: Line, counts: np.ndarray, mixer: dict, group: int = GROUP) -> None:
    """One online pass over the tokens in order, a group at a time, each without itself."""
    learn_line(code, line, lookup(code, left_out(counts)), mixer, group)


def learn_line(code: Code, line: Line, table: Lookup, mixer: dict, group: int = GROUP) -> None:
    """``learn_words`` from the tables of ``left_out``. A group's decisions are sorted by their weights, so
    that what pulls at each is summed in one run."""
    block = max(1, STEP // group) * group
    for start in range(0, len(line.leaf), block):
        at, way, gate, inputs = predictions(code, line, table, start, min(start + block, len(line.leaf)))
        cuts = np.searchsorted(at, np.arange(0, block + group, group)).tolist()
        for lo, hi in itertools.pairwise(cuts):
            if lo == hi:
                continue
            order = np.argsort(gate[lo:hi], kind="stable")
            of = gate[lo:hi].take(order)
            first = np.concatenate([[0], np.flatnonzero(of[1:] != of[:-1]) + 1])
            of, often = of[first], np.diff(first, append=hi - lo)
            weights = np.repeat(mixer["weights"][of].T.astype(np.float32), often, 1)
            x = np.empty_like(weights)
            for row, given in zip(x, inputs):
                given[lo:hi].take(order, out=row, mode="clip")
            weights[:-1] *= x[:-1]
            dot = weights[-1]
            for pull in weights[:-1]:
                dot += pull
            np.clip(dot, -8, 8, out=dot)
            step = np.exp(-dot)
            step += 1
            np.divide(1, step, out=step)
            kind = way[lo:hi].take(order)
            np.subtract((kind & 1).astype(np.float32), step, out=step)
            np.clip(x[:-1], -4, 4, out=x[:-1])
            x[:-1] *= step
            x[-1] = step
            pulls = np.add.reduceat(x.astype(np.float64), first, 1)
            mixer["weights"][of] += (LEARN_WORDS * pulls / np.maximum(often, 32)).T
            dot += 8
            dot *= np.float32((LEVELS - 1) / 16)
            low = np.minimum(dot.astype(np.int32), LEVELS - 2)
            dot -= low
            low *= 16
            low += kind & 15                                             # place, depth and bit
            refine(mixer["refine"], low, dot)


def refine(table: np.ndarray, place: np.ndarray, part: np.ndarray) -> None:
    """Draw the refinement (a row for each of ``DEPTHS``) towards the bits that came. ``place``: the lower of two
    neighbours * 16 + row * 2 + bit; ``part``: how near the upper one is."""
    n, upper = (np.bincount(place, x, 16 * LEVELS).reshape(LEVELS, DEPTHS, 2).transpose(1, 0, 2) for x in (None, part))
    _draw(table, n - upper, upper)


def _draw(table: np.ndarray, lower: np.ndarray, upper: np.ndarray) -> None:
    """One step of a refinement: shares of decisions, by the lower of their two places and the bit."""
    for share, part in ((lower[..., :-1, :], table[..., :-1]), (upper[..., :-1, :], table[..., 1:])):
        goal = share[..., 1]
        pull = share[..., 0] + goal
        part += REFINE * (goal / np.maximum(pull, 1e-9) - part) * np.minimum(pull, 1)


# ---- the spelling of new words, many words at once ------------------------------------------

def _pieces(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of coded bytes (longest first), their lengths, and the word each belongs to."""
    rows, owner = [], []
    for i, w in enumerate(words):
        for lo in range(0, max(1, len(w)), PIECE):
            rows.append(w[lo:lo + PIECE] + (b" " if lo + PIECE >= len(w) else b"\n"))
            owner.append(i)
    length = np.fromiter(map(len, rows), np.int64, len(rows))
    order = np.argsort(-length, kind="stable")
    grid = np.zeros((len(rows), int(length.max(initial=0))), np.uint8)
    flat = np.frombuffer(b"".join(rows), np.uint8)
    grid[np.repeat(np.arange(len(rows)), length), np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length)] = flat
    return grid[order], length[order], np.array(owner, np.int64)[order]


def _steps(grid: np.ndarray, length: np.ndarray, weight: np.ndarray | None = None) -> Iterator[tuple]:
    """For each bit of each byte: how many rows still run, the bit's position, the rows' slots in
    the joined tables (one column per predictor) and the bits to come. Given weights, rows that agree in
    up to ``MERGED`` bytes, and so in all their contexts, are taken as one, and their summed weights come first."""
    k = len(TABLE_BITS)
    start = np.cumsum([0, *(1 << b for b in TABLE_BITS[:-1])])[:, None]
    shift = np.array([[64 - b] for b in TABLE_BITS], np.uint64)
    whole = np.full(len(grid), 0xCBF29CE484222325, np.uint64)
    column = grid.T.astype(np.uint64, order="C")
    for j in range(grid.shape[1]):
        live = int(np.searchsorted(-length, -j, side="left"))
        rows, mass = slice(live), live if weight is None else weight[:live]
        if weight is not None and j < MERGED:
            prefix = column[0, :live]
            for other in column[1:j + 1, :live]:
                prefix = prefix << np.uint64(8) | other
            _, rows, of = np.unique(prefix, return_index=True, return_inverse=True)
            mass = np.bincount(of, mass).astype(weight.dtype)
        byte = column[j][rows]
        context, recent = np.empty((k, len(byte)), np.uint64), np.zeros(len(byte), np.uint64)
        for back in range(1, k):
            recent <<= np.uint64(8)
            if j >= back:
                recent |= column[j - back][rows]
            context[back - 1] = (recent + np.uint64(back << 40)) * ODD
        context[-1] = whole[rows]
        known = np.ones(len(byte), np.uint64)
        for bit in range(8):
            h = context ^ known * SPREAD
            h *= ODD
            h ^= h >> np.uint64(31)
            h *= ODD
            h >>= shift
            slots = h.view(np.int64)
            slots += start
            one = (byte >> np.uint64(7 - bit)) & np.uint64(1)
            yield mass, bit, slots.T, one.view(np.int64)
            known = (known << np.uint64(1)) | one
        whole[:live] = (whole[:live] ^ column[j, :live]) * np.uint64(0x100000001B3) + np.uint64(j)


def _gate(seen: np.ndarray, bit: int) -> np.ndarray:
    """Which weights to use: how often the two longest contexts were seen, and if a byte begins."""
    return _placed(np.searchsorted(SEEN, seen), bit)


def _placed(level: np.ndarray, bit: int) -> np.ndarray:
    return level[1] * 10 + level[0] * 2 + (bit == 0)


SEEN = np.array([0.5, 1.5, 7.5, 63.5], np.float32)
GATES = 50


def new_mixer() -> dict[str, np.ndarray]:
    weights = np.full((GATES, len(TABLE_BITS) + 1), 0.3)
    weights[:, -1] = 0
    return {"weights": weights, "refine": np.repeat(_even()[None, :], 8, 0)}


def _even() -> np.ndarray:
    """A refinement that changes nothing."""
    return 1 / (1 + np.exp(-np.linspace(-8, 8, LEVELS)))


def _refined(table: np.ndarray, row: int | np.ndarray, dot: np.ndarray):
    p = 1 / (1 + np.exp(-dot))
    x = (dot + 8) * ((LEVELS - 1) / 16)
    low = np.minimum(x.astype(np.int64), LEVELS - 2)
    part = x - low
    refined = table[row, low] * (1 - part) + table[row, low + 1] * part
    return p, np.clip((p + refined) / 2, 1e-6, 1 - 1e-6), low, part


def word_bits(words: list[bytes], counts: np.ndarray, mixer: dict) -> np.ndarray:
    """Total bits of each word under the model."""
    bits = np.zeros(len(words))
    mixer = {k: v.astype(np.float32) for k, v in mixer.items()}
    stretch, seen = np.log((counts[1] + DELTA) / (counts[0] + DELTA)), counts[0] + counts[1]
    weights = np.ascontiguousarray(mixer["weights"].T)
    for lo in range(0, len(words), LANES):
        grid, length, owner = _pieces(words[lo:lo + LANES])
        own = np.zeros((len(TABLE_BITS) + 1, len(grid)), np.float32)
        cost = np.zeros(len(grid))
        for live, bit, slots, one in _steps(grid, length):
            inputs = np.ones((len(own), live), np.float32)
            stretch.take(slots.T, out=inputs[:-1], mode="clip")
            gate = _gate(seen.take(slots.T[-2:]), bit)
            dot = weights.take(gate, 1)
            dot += own[:, :live]
            dot *= inputs
            p, final, _, _ = _refined(mixer["refine"], bit, np.clip(dot.sum(0), -8, 8))
            cost[:live] -= np.log2(np.where(one == 1, final, 1 - final))
            np.clip(inputs, -4, 4, out=inputs)
            inputs *= np.float32(ADAPT) * (one.astype(np.float32) - p)
            own[:, :live] += inputs
        bits[lo:lo + LANES] = np.bincount(owner, cost, minlength=min(LANES, len(words) - lo))
    return bits


def learn(words: list[bytes], c: np.ndarray, counts: np.ndarray, mixer: dict, group: int = 4096) -> None:
    """One online pass: weights and refinement follow the words in order, a group at a time."""
    learn_spelling(words, c, left_out(counts), mixer, group)


def learn_spelling(words: list[bytes], c: np.ndarray, left: tuple[np.ndarray, np.ndarray], mixer: dict, group: int = 4096) -> None:
    """``learn`` from the tables of ``left_out``: each decision without the word itself."""
    stretch, level = left
    weights, table = np.ascontiguousarray(mixer["weights"].T, np.float32), mixer["refine"].astype(np.float32)
    k = len(weights)
    bins = 4 * GATES                                                     # four sums of each, as runs of one bin are slow
    for lo in range(0, len(words), group):
        grid, length, owner = _pieces(words[lo:lo + group])
        root = np.sqrt(c[lo:lo + group][owner]).astype(np.float32)
        lane = np.arange(len(grid)) % 4 * GATES
        for w, bit, slots, one in _steps(grid, length, root):
            live, place = len(w), slots.T
            place <<= 1
            place |= one
            gate = _placed(level.take(place[-2:], mode="clip"), bit)
            x = np.empty((k + 1, live), np.float32)                      # what pulls at each weight, and how much counts
            stretch.take(place, out=x[:k - 1], mode="clip")
            dot = weights.take(gate, 1)
            dot[:-1] *= x[:k - 1]
            dot = np.clip(dot.sum(0), -8, 8)
            step = one.astype(np.float32)
            step -= 1 / (1 + np.exp(-dot))
            step *= w
            np.clip(x[:k - 1], -4, 4, out=x[:k - 1])
            x[:k - 1] *= step
            x[-2], x[-1] = step, w
            gate = lane[:live] + gate
            sums = np.bincount((gate + np.arange(0, (k + 1) * bins, bins)[:, None]).reshape(-1), x.reshape(-1), (k + 1) * bins)
            sums = sums.reshape(k + 1, 4, GATES).sum(1)
            weights += LEARN * sums[:-1] / np.maximum(sums[-1], 1)
            dot += 8
            dot *= np.float32((LEVELS - 1) / 16)
            low = np.minimum(dot.astype(np.int64), LEVELS - 2)
            dot -= low
            dot *= w
            low <<= 1
            low |= one
            n, upper = (np.bincount(low, share, 2 * LEVELS).reshape(LEVELS, 2) for share in (w, dot))
            _draw(table[bit], n - upper, upper)
    mixer["weights"][:], mixer["refine"][:] = weights.T, table


def adapted_bits(lengths: np.ndarray, words: np.ndarray, log_p: np.ndarray) -> np.ndarray:
    """Bits of documents that adapt as they go: their words one after another, and the natural log
    of each one's probability before the document's own counts are added."""
    doc = np.repeat(np.arange(len(lengths)), lengths)
    start = np.cumsum(lengths) - lengths
    key = doc * (int(words.max(initial=0)) + 1) + words
    order = np.argsort(key, kind="stable")
    fresh = np.flatnonzero(np.diff(key[order], prepend=-1))
    met = np.empty(len(key), np.int64)                                   # earlier in the same document
    met[order] = np.arange(len(key)) - np.repeat(fresh, np.diff(np.append(fresh, len(key))))
    adapted = log_p + np.log(MEMORY)                                     # of new ones, however small
    again = np.flatnonzero(met)
    adapted[again] = np.log(np.exp(adapted[again]) + met[again])
    adapted -= np.log(MEMORY + np.arange(len(key)) - np.repeat(start, lengths))
    return -np.add.reduceat(adapted, start) / np.log(2)                  # every text has an end


# ---- training and scoring as Spark jobs -----------------------------------------------------

TABLE = "slice int, part long, counts binary"


def _sliced(n: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A task's table (two rows of all slots) as compressed slices; those without counts are left out."""
    part = TaskContext.get().partitionId()
    for i, lo in enumerate(range(0, n.shape[1], SLICE)):
        piece = n[:, lo:lo + SLICE]
        if piece.any():
            yield pa.record_batch({"slice": pa.array([i], pa.int32()), "part": [part],
                                   "counts": pa.array([zlib.compress(piece.tobytes(), 1)], pa.binary())})


def _summed(parts: DataFrame, tasks: int, slots: int) -> np.ndarray:
    """The sum of all tasks' tables. Slices of up to ``FAN_IN`` tables are added at a time, so that a
    group's size does not follow the number of tasks."""
    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(zlib.decompress(x.as_py()), np.int64) for x in group.column("counts"))
        return pa.table({"slice": group.column("slice").slice(0, 1), "part": [group.column("part")[0].as_py() // FAN_IN],
                         "counts": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})

    while tasks > 1:
        parts = parts.groupBy("slice", F.expr(f"part DIV {FAN_IN}").alias("group")).applyInArrow(add, TABLE)
        tasks = -(-tasks // FAN_IN)
    counts = np.zeros((2, slots), np.float32)
    got = written(parts, "lm-contexts").toArrow()                         # one row per slice
    for i, blob in zip(got.column("slice").to_pylist(), got.column("counts").to_pylist()):
        piece = np.frombuffer(zlib.decompress(blob), np.int64).reshape(2, -1)
        counts[:, i * SLICE:i * SLICE + piece.shape[1]] += piece
    return counts


def context_counts(trained: DataFrame, tasks: int = 4) -> np.ndarray:
    """How often a 0 and a 1 followed each slot's spelling contexts, from all training words."""
    slots = sum(1 << b for b in TABLE_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, slots), np.int64)
        for b in batches:
            words, c = b.column("word").to_pylist(), b.column("c").to_numpy()
            for lo in range(0, len(words), LANES):
                grid, length, owner = _pieces(words[lo:lo + LANES])
                weight = c[lo:lo + LANES][owner]
                for often, _, at, one in _steps(grid, length, weight):
                    side = one * slots
                    for row in at.T:
                        row += side
                        np.add.at(n.reshape(-1), row, often)
        yield from _sliced(n)

    return _summed(trained.repartition(tasks).mapInArrow(run, TABLE), tasks, slots)


def word_counts(texts: DataFrame, code, tasks: int = 4) -> np.ndarray:
    """How often a 0 and a 1 followed each slot's word contexts, from all training texts."""
    slots = int(Code(*code.value).starts[-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, paths = np.zeros((2, slots), np.int64), Code(*code.value)
        followed = np.zeros((COMMON + 1) * len(paths.first), np.int64)
        for b in batches:
            for t in Texts.of(b):
                followed += count_near(paths, in_line(paths, t.training()), n)
        count_common(paths, followed, n)
        yield from _sliced(n)

    return _summed(texts.coalesce(tasks).mapInArrow(run, TABLE), tasks, slots)


def _fitted(rows: DataFrame, online, new) -> dict[str, np.ndarray]:
    """A mixer learned online in every task (``online(batches, mixer)`` returns how much it saw) and averaged."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer = new()
        mass = float(online(batches, mixer))
        yield pa.record_batch({"mass": [mass], "weights": [mixer["weights"].tobytes()], "refine": [mixer["refine"].tobytes()]})

    got = rows.mapInArrow(run, "mass double, weights binary, refine binary").filter("mass > 0").collect()
    mixer, total = new(), sum(r["mass"] for r in got)
    for key in mixer if total else ():
        mixer[key] = sum(np.frombuffer(r[key]).reshape(mixer[key].shape) * (r["mass"] / total) for r in got)
    return mixer


def fit_spelling(trained: DataFrame, left) -> dict[str, np.ndarray]:
    """The weights, learned from every training word."""
    def online(batches, mixer) -> int:
        seen = 0
        for b in batches:
            words, c = b.column("word").to_pylist(), b.column("c").to_numpy()
            learn_spelling(words, c, left.value, mixer)
            seen += len(words)
        return seen

    return _fitted(trained, online, new_mixer)


def fit_words(texts: DataFrame, code, left) -> dict[str, np.ndarray]:
    """The weights, learned from every training text."""
    def online(batches, mixer) -> int:
        seen, paths = 0, Code(*code.value)
        table = lookup(paths, left.value)
        for b in batches:
            for t in Texts.of(b):
                t = t.training()
                learn_line(paths, in_line(paths, t), table, mixer)
                seen += len(t.tokens)
        return seen

    return _fitted(texts, online, new_word_mixer)


def other_words(texts: DataFrame, code) -> DataFrame:
    """(batch, number, word): each batch's words that the code has no path for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaf = Code(*code.value).leaf
        for b in batches:
            for t in Texts.of(b):
                at = [i for i, w in enumerate(t.words) if w not in leaf]
                for lo in range(0, len(at), 1 << 16):
                    part = at[lo:lo + (1 << 16)]
                    yield pa.record_batch({"batch": np.full(len(part), t.batch, np.int64), "number": pa.array(part, pa.int32()),
                                           "word": pa.array([t.words[i] for i in part], pa.binary())})

    return texts.mapInArrow(run, "batch long, number int, word binary")


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one document batch packed into one per Arrow batch, so that few rows travel back."""
    for b in batches:
        if not b.num_rows:
            continue
        key = b.column("batch").to_numpy()
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        cuts = list(zip(first.tolist(), [*first[1:].tolist(), len(key)]))
        columns = {k: b.column(k).to_numpy()[order].astype(kind) for k, kind in PACKED.items()}
        yield pa.record_batch({"batch": key[first], **{
            k: pa.array([x[lo:hi].tobytes() for lo, hi in cuts], pa.binary()) for k, x in columns.items()}})


PACKED = {"number": "<i4", "c": "<i8", "bits": "<f8"}


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte."""
    spark = docs.sparkSession
    texts = written(encoded(docs), "lm-texts")
    vocab = written(vocabulary(texts), "lm-vocabulary")
    n, distinct, single, unseen = vocab.agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.count(F.when(F.col("c") > 0, 1)), F.count(F.when(F.col("c") == 1, 1)),
        F.count(F.when(F.col("c") == 0, 1))).first()
    top = vocab.filter("c > 1").orderBy(F.desc("c"), "word").limit(FREQUENT).toArrow()     # at most FREQUENT rows
    known = top.column("c").to_pylist()
    others = n - sum(known)
    fresh = (single + 1) / (others + 2)                                   # chance of a new word among the others
    bits = tuple(min(b, max(12, n.bit_length() + 1)) for b in CONTEXT_BITS)
    code = spark.sparkContext.broadcast(tuple(prefix_code(top.column("word").to_pylist(), known, others, bits)))

    trained = vocab.filter("c > 0")
    letter_counts = context_counts(trained, max(4, -(-distinct // WORDS_A_TABLE)))
    learning = spark.sparkContext.broadcast(left_out(letter_counts))      # fixed size, 40 MB
    mixer = fit_spelling(trained.repartition(max(4, -(-distinct // WORDS_A_TASK))), learning)
    learning.destroy()                                                    # the weights are here
    letters = spark.sparkContext.broadcast(letter_counts)                 # fixed size, 32 MB

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bits = word_bits(b.column("word").to_pylist(), letters.value, mixer)
            yield pa.record_batch({"word": b.column("word"), "c": b.column("c"), "bits": bits})

    spelled = (vocab.filter("c = 0").repartition(max(4, -(-unseen // WORDS_A_TASK)))
               .mapInArrow(spell, "word binary, c long, bits double"))
    rated = written(trained.withColumn("bits", F.lit(0.0)).unionByName(spelled), "lm-words")
    letters.destroy()                                                     # the table is written: nothing reads it again

    contexts = word_counts(texts, code, max(4, -(-n // TOKENS_A_TABLE)))
    paths = Code(*code.value)
    learning = spark.sparkContext.broadcast(tuple(lookup(paths, left_out(contexts))))     # fixed size, 85 MB
    word_mixer = fit_words(texts, code, learning)
    learning.destroy()                                                    # the weights are here
    near = spark.sparkContext.broadcast(tuple(lookup(paths, looked_up(contexts))))        # fixed size, 43 MB
    floor = n + 0.1 * (distinct + 1)

    del paths                                                             # tasks make it from the broadcast

    def total(left: pa.Table, right: pa.Table) -> pa.Table:
        t, paths = next(Texts.of(left)), Code(*code.value)
        line = in_line(paths, t)
        c = paths.c[np.fromiter((paths.leaf.get(w, -1) for w in t.words), np.int64, len(t.words))]
        log_rest = np.zeros(len(t.words))                                 # of others, given that they are others
        number, rare, bits = (np.frombuffer(b"".join(right.column(k).to_pylist()), kind) for k, kind in PACKED.items())
        c[number] = rare
        log_rest[number] = np.where(rare > 0, np.log((1 - fresh) * np.maximum(rare, 1) / max(others, 1)),
                                    np.log(fresh) - bits * np.log(2))
        path = path_bits(paths, line, near.value, word_mixer)
        bits = adapted_bits(t.lengths, t.tokens, log_rest[t.tokens] - path * np.log(2))
        start = np.cumsum(t.lengths) - t.lengths
        sums = lambda x: np.add.reduceat(x.take(t.tokens), start)
        return pa.table({
            "doc_id": pa.array(t.ids, pa.int64()), "held_out": pa.array([_held_out(i) for i in t.ids], pa.bool_()),
            "n_tokens": t.lengths, "n_known": sums((c > 0).astype(np.int64)),
            "train_tokens": pa.array([n] * len(t.ids), pa.int64()),
            "base_score": sums(np.log10((c + 0.1) / floor)), "score": -bits * np.log10(2),
            "bits_per_byte": bits / np.maximum(t.sizes, 1)})

    joined = other_words(texts, code).join(rated, "word").select("batch", "number", "c", "bits")
    packed = joined.mapInArrow(pack, "batch long, number binary, c binary, bits binary")
    return texts.groupBy("batch").cogroup(packed.groupBy("batch")).applyInArrow(
        total, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
               "base_score double, score double, bits_per_byte double")
