"""Fill-in-the-middle transformation by secondary-sort assembly.

A text is cut into units (a word with the white space before it, or trailing white space). Two
seeded hashes of the doc_id choose where the prefix and the middle end, two more the form:
``plain`` (unchanged), ``psm`` (prefix, suffix, middle) or ``spm`` (suffix, prefix, middle), each
part behind its sentinel. No text is ever reordered in memory:

1. every document is emitted as pieces, runs of at most ``CHUNK_UNITS`` units and about
   ``CHUNK_BYTES`` bytes, keyed by the document's row and by the piece's place in the output;
2. one shuffle on the row with a sort inside partitions (the DataFrame form of
   repartitionAndSortWithinPartitions) streams the pieces in output order into an incremental digest,
   or into the output text. A partition may hold any number of documents; one piece is in memory;
3. for restoration, the sentinels found in that stream and the form give each piece its place in
   the original text; the same partitions are sorted again by it, without a second shuffle, and
   streamed into a second digest.

A text that holds a sentinel stays plain, so a sentinel in an output of another form is one that
was put there.

Defined results: null and empty texts have no units and stay plain. A null ``doc_id`` hashes as the
empty string. One result per input row, so repeated rows are transformed each for itself. An empty
table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .tables import SPACE

SEED = 42
FIM_PERCENT = 50
SPM_PERCENT = 80
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
CHUNK_UNITS = 4096
CHUNK_BYTES = 1 << 16
FLUSH_BYTES = 4 << 20
HEADER = -1

_PIECES = ("row_id long, pos long, text binary, doc_id long, n long, form string, prefix_chars long, middle_chars long")


def unit_ends(text: bytes) -> np.ndarray:
    """Byte positions where the units of a text end."""
    raw = np.frombuffer(text, np.uint8)
    gap = np.zeros(256, bool)
    gap[list(SPACE.encode())] = True
    blank = gap[raw]
    ends = np.flatnonzero(~blank & np.append(blank[1:], True)) + 1 if len(raw) else np.zeros(0, np.int64)
    return np.append(ends, len(raw)) if len(raw) and blank[-1] else ends


def plan(doc_id: int | None, n: int, text: bytes, seed: int, fim_percent: int, spm_percent: int) -> tuple[str, int, int]:
    """Form, and the units after which the prefix and the middle end."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    h1, h2, h3, h4 = struct.unpack(">4I", digest[:16])
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= fim_percent:
        return "plain", a, b
    return ("spm" if h4 % 100 < spm_percent else "psm"), a, b


def chunks(text: bytes, ends: np.ndarray, lo: int, hi: int) -> Iterator[bytes]:
    """The units lo to hi as runs of bounded size; an endless unit is cut between code points."""
    at = int(ends[lo - 1]) if lo else 0
    while lo < hi:
        nxt = min(hi, lo + CHUNK_UNITS, max(lo + 1, int(np.searchsorted(ends, at + CHUNK_BYTES, "right"))))
        stop = int(ends[nxt - 1])
        while stop - at > 2 * CHUNK_BYTES:
            cut = at + CHUNK_BYTES
            while text[cut] & 0xC0 == 0x80:
                cut -= 1
            yield text[at:cut]
            at = cut
        yield text[at:stop]
        at, lo = stop, nxt


def _code_points(text: bytes) -> int:
    return int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))


def pieces(docs: DataFrame, seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """Pieces of every output: row_id, pos and text; the row at ``HEADER`` describes the document."""
    def emitted(row_id: int, doc_id: int | None, text: bytes) -> Iterator[tuple]:
        ends = unit_ends(text)
        n = len(ends)
        form, a, b = plan(doc_id, n, text, seed, fim_percent, spm_percent)
        cut = [0, *(int(ends[k - 1]) if k else 0 for k in (a, b))]
        sizes = (None, None) if form == "plain" else tuple(_code_points(text[x:y]) for x, y in zip(cut, cut[1:]))
        yield (row_id, HEADER, None, doc_id, n, form, *sizes)
        parts = {"plain": ((b"", 0, n),), "psm": ((PREFIX, 0, a), (SUFFIX, b, n), (MIDDLE, a, b)),
                 "spm": ((SUFFIX, b, n), (PREFIX, 0, a), (MIDDLE, a, b))}[form]
        pos = 0
        for mark, lo, hi in parts:
            for piece in ([mark] if mark else []):
                yield (row_id, pos, piece, *[None] * 5)
                pos += 1
            for piece in chunks(text, ends, lo, hi):
                yield (row_id, pos, piece, *[None] * 5)
                pos += 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = (r for i, d, t in zip(b.column("row_id").to_pylist(), b.column("doc_id").to_pylist(), b.column("text"))
                    for r in emitted(i, d, t.as_py() or b""))
            yield from _batched(rows, schema)

    schema = pa.schema([("row_id", pa.int64()), ("pos", pa.int64()), ("text", pa.binary()), ("doc_id", pa.int64()),
                        ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())])
    slim = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").cast("long"),
                       F.col("text").cast("binary"))
    return slim.mapInArrow(run, _PIECES)


def _batched(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of bounded size; the text is the third column."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r[2] or b"") + 64
        if size >= FLUSH_BYTES:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


_ABOUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long"
# Place of a part in the original text.
_ORDER = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}


def _in_output_order(rows: DataFrame) -> DataFrame:
    return rows.repartition("row_id").sortWithinPartitions("row_id", "pos")


def transform(docs: DataFrame, seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """Per document: doc_id, n, form, prefix_chars, middle_chars, output (the transformed text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def outputs() -> Iterator[tuple]:
            about, held = None, []
            for _, pos, text, *rest in _rows(batches):
                if pos == HEADER:
                    if about is not None:
                        yield (*about[:2], b"".join(held), *about[2:])
                    about, held = rest, []
                else:
                    held.append(text)
            if about is not None:
                yield (*about[:2], b"".join(held), *about[2:])

        yield from _batched(outputs(), schema)

    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("output", pa.binary()), ("form", pa.string()),
                        ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())])
    out = _in_output_order(pieces(docs, seed, fim_percent, spm_percent)).mapInArrow(
        run, "doc_id long, n long, output binary, form string, prefix_chars long, middle_chars long")
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.col("output").cast("string").alias("output"))


def digests(docs: DataFrame, seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """Per document: doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256."""
    def written_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Digest outputs; pass pieces on by their place in the original text, sentinels left out.

        A document's description and digest follow its pieces in a row behind all places.
        """
        def rows() -> Iterator[tuple]:
            row, about, digest, part, place = None, None, None, 0, 0
            for row_id, pos, text, *rest in _rows(batches):
                if pos == HEADER:
                    if about is not None:
                        yield (row, LAST, None, *about, digest.hexdigest())
                    row, about, digest, part, place = row_id, rest, hashlib.sha256(), 0, 0
                    continue
                digest.update(text)
                if about[2] != "plain" and text in _ORDER:
                    part, place = _ORDER[text], 0
                else:
                    yield (row, part << 40 | place, text, *[None] * 6)
                    place += 1
            if about is not None:
                yield (row, LAST, None, *about, digest.hexdigest())

        yield from _batched(rows(), passed)

    def read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            digest = hashlib.sha256()
            for _, place, text, *about in _rows(batches):
                if place == LAST:
                    yield (*about[:2], None, *about[2:], digest.hexdigest())
                    digest = hashlib.sha256()
                else:
                    digest.update(text)

        yield from (b.drop_columns(["blank"]) for b in _batched(rows(), told))

    LAST = 1 << 60
    about = [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
             ("output_sha256", pa.string())]
    passed = pa.schema([("row_id", pa.int64()), ("place", pa.int64()), ("text", pa.binary()), ("doc_id", pa.int64()), *about])
    told = pa.schema([("doc_id", pa.int64()), about[0], ("blank", pa.binary()), *about[1:], ("restored_sha256", pa.string())])
    streamed = _in_output_order(pieces(docs, seed, fim_percent, spm_percent)).mapInArrow(
        written_out, f"row_id long, place long, text binary, {_ABOUT}, output_sha256 string")
    return streamed.sortWithinPartitions("row_id", "place").mapInArrow(
        read_back, f"{_ABOUT}, output_sha256 string, restored_sha256 string")
