"""Best-fit packing of tokenised documents into sequences of fixed length.

A document's ids (its tokens and an end id) are one piece; only a longer document is cut, into
pieces of ``limit`` ids of which the first takes the remainder. Pieces are placed by bounded-space
online best-fit:

* a task keeps at most ``open_bins`` open sequences. A bitset has bit f set if some open sequence
  has f places free, so the best fit for a piece of n ids is the lowest set bit from n on;
* a piece that fits nowhere opens a sequence; beyond the bound the fullest one, the lowest set bit,
  is closed first. Full sequences close by themselves.

Every task packs its own share: pieces are dealt out by a hash of their row and number, in windows
of about ``window`` pieces fed by falling length, so long pieces open sequences and short ones fill
them. Bins and windows are bounded, and any number of tasks works side by side; each leaves a few
sequences unfilled at its end. The same written pieces always give the same places.

Ids are those of the ``tokenizers`` library. Where a byte-level vocabulary's ids follow its merge
order, ``tiktoken`` on the same vocabulary gives the same ids several times faster; texts with special tokens, or with
characters on whose classes Unicode versions differ, are left to ``tokenizers`` itself.

Defined results: null and empty texts are one piece of the end id. One document per input row, so
repeated rows are packed each for itself; a null ``doc_id`` stays null. An empty table gives no
rows. Other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .tables import written
from .token_counts import LAST_PLAIN, WORD_PATTERN, _byte_letters, _spliceable

LIMIT = 2048
END_ID = 0
OPEN_BINS = 16_384
WINDOW = 32_768
TASK_PIECES = 1 << 20
GROUP = 256


def _ranks(spec: dict) -> dict[bytes, int] | None:
    """Byte sequences and ids of a byte-level vocabulary, if ids follow the order of its merges."""
    model = spec["model"]
    if model.get("type") != "BPE" or not _spliceable(spec) or model.get("dropout") or model.get("ignore_merges"):
        return None
    back = {c: b for b, c in _byte_letters().items()}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    special = {t["content"] for t in spec.get("added_tokens", [])}
    vocab = {w: i for w, i in model["vocab"].items() if w not in special}
    if any(vocab.get(a + b) != 256 + i for i, (a, b) in enumerate(pairs)) or len(vocab) != 256 + len(pairs):
        return None
    return {bytes(back[c] for c in w): i for w, i in vocab.items()}


def encoder(definition: bytes) -> Callable[[str], np.ndarray]:
    """Ids of a text, as ``tokenizers`` gives them without added special tokens."""
    spec, tok = json.loads(definition), None

    def plainly(text: str) -> np.ndarray:
        nonlocal tok
        if tok is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer
            tok = Tokenizer.from_str(definition.decode())
        return np.array(tok.encode(text, add_special_tokens=False).ids, np.uint32)

    ranks = _ranks(spec)
    if ranks is None:
        return plainly
    import tiktoken
    fast = tiktoken.Encoding("ranks", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})
    marks = [re.escape(t["content"]) for t in spec.get("added_tokens", [])]
    rare = re.compile("|".join([f"[^\x00-{LAST_PLAIN}]", *marks]))

    def ids(text: str) -> np.ndarray:
        return plainly(text) if rare.search(text) else np.array(fast.encode_ordinary(text), np.uint32)

    return ids


def piece_bounds(n: int, limit: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of n ids: all of ``limit`` but the first."""
    first = n - limit * (-(-n // limit) - 1)
    return [(0, first), *((s, limit) for s in range(first, n, limit))]


def pieces(docs: DataFrame, tokenizer: str, limit: int = LIMIT, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """Per piece: row_id, doc_id, piece, start, length, ids_crc32 and, on request, its ids."""
    with open(tokenizer, "rb") as f:
        definition = docs.sparkSession.sparkContext.broadcast(f.read())   # one tokenizer file, a few MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = None
        for b in batches:
            encode = encode or encoder(definition.value)
            for lo in range(0, b.num_rows, GROUP):
                part = b.slice(lo, GROUP)
                at, rows, kept = [], [], []
                for i, text in enumerate(part.column("text").to_pylist()):
                    ids = np.append(encode(text) if text else np.zeros(0, np.uint32), np.uint32(end_id)).astype("<u4")
                    for k, (s, n) in enumerate(piece_bounds(len(ids), limit)):
                        cut = ids[s:s + n]
                        at.append(i)
                        rows.append((k, s, n, zlib.crc32(cut.tobytes())))
                        kept.append(cut.astype(np.int32))
                k, s, n, c = (np.array(x, np.int64) for x in zip(*rows))
                out = {"row_id": part.column("row_id").take(pa.array(at)), "doc_id": part.column("doc_id").take(pa.array(at)),
                       "piece": pa.array(k.astype(np.int32)), "start": pa.array(s), "length": pa.array(n), "ids_crc32": pa.array(c)}
                if keep_ids:
                    ends = np.cumsum([0, *map(len, kept)], dtype=np.int32)
                    out["ids"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(kept)))
                yield pa.record_batch(out)

    schema = "row_id long, doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if keep_ids else "")
    slim = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").cast("long"), "text")
    return slim.mapInArrow(run, schema)


class BestFit:
    """Open sequences of one task: a bitset over free places, and the open ones of each."""

    def __init__(self, limit: int, open_bins: int, first_id: int = 0) -> None:
        self.limit, self.bound, self.next_id = limit, open_bins, first_id
        self.free, self.bins, self.n_open = 0, [[] for _ in range(limit + 1)], 0

    def _take(self, room: int) -> int:
        bins = self.bins[room]
        found = bins.pop()
        if not bins:
            self.free ^= 1 << room
        self.n_open -= 1
        return found

    def place(self, n: int) -> tuple[int, int]:
        """Sequence and offset of a piece of n ids."""
        fits = self.free >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            seq = self._take(room)
        else:
            room, seq = self.limit, self.next_id
            self.next_id += 1
        left = room - n
        if left:
            self.free |= 1 << left
            self.bins[left].append(seq)
            self.n_open += 1
            if self.n_open > self.bound:
                self._take((self.free & -self.free).bit_length() - 1)      # the fullest closes first
        return seq, self.limit - room


def _tasks(n: int, most: int) -> tuple[int, int]:
    """Packing tasks for n pieces, and windows a task: up to ``most`` tasks of a window or more, then
    longer ones, up to TASK_PIECES each."""
    windows = max(1, -(-n // WINDOW))
    tasks = max(min(windows, most), -(-n // TASK_PIECES))
    return tasks, -(-windows // tasks)


def packed(rows: DataFrame, limit: int = LIMIT, open_bins: int = OPEN_BINS) -> DataFrame:
    """Place pieces (a written table, from ``pieces``): its columns, sequence_id, offset."""
    spark = rows.sparkSession
    tasks, windows = _tasks(rows.count(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    turn = F.pmod(F.xxhash64("row_id", "piece"), F.lit(windows))
    dealt = (rows.repartition(tasks, "row_id", "piece")
             .sortWithinPartitions(turn, F.desc("length"), "row_id", "piece"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = BestFit(limit, open_bins, TaskContext.get().partitionId() << 33)
        for b in batches:
            where = [bins.place(n) for n in b.column("length").to_pylist()]
            seq, off = np.array(where, np.int64).reshape(-1, 2).T
            yield pa.record_batch([*b.columns, pa.array(seq), pa.array(off)], [*b.schema.names, "sequence_id", "offset"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return dealt.mapInArrow(run, f"{kinds}, sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str, limit: int = LIMIT, open_bins: int = OPEN_BINS) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    out = packed(written(pieces(docs, tokenizer, limit), "pieces"), limit, open_bins)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def sequences(docs: DataFrame, tokenizer: str, limit: int = LIMIT, open_bins: int = OPEN_BINS) -> DataFrame:
    """The packed sequences: sequence_id, ids (at most ``limit``), spans array<(doc_id, piece, offset, length)>.

    A sequence gathers at most ``limit`` ids, so the grouping is bounded.
    """
    rows = written(pieces(docs, tokenizer, limit, keep_ids=True), "pieces")
    placed = packed(rows.drop("ids"), limit, open_bins)
    ids = rows.select("row_id", "piece", "ids")
    gathered = (placed.join(ids, ["row_id", "piece"]).groupBy("sequence_id")
                .agg(F.sort_array(F.collect_list(F.struct("offset", "length", "doc_id", "piece", "ids"))).alias("s")))
    return gathered.select("sequence_id", F.flatten("s.ids").alias("ids"),
                           F.transform("s", lambda x: F.struct(x["doc_id"], x["piece"], x["offset"], x["length"])).alias("spans"))
