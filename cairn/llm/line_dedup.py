"""Line-level deduplication across documents.

Lines are exploded and normalised, keys hashed, distinct documents counted per hash, and lines of
keys found in enough documents dropped everywhere but in the largest ``doc_id`` that holds them;
what stays is put together again by position.

Three steps, each distributed:

1. one pass over the texts emits the distinct (key hash, doc_id) pairs, written once;
2. counts and largest doc_id per hash come from a partial aggregate, so a line that a third of the
   documents share is summed before it is shuffled; the pairs to drop join back on the hash (Spark
   splits a skewed side) and are gathered per document, bounded by the document's own lines;
3. texts join their drop list on ``doc_id`` (the only shuffle of text) and are reassembled.

Key hashes are 128-bit MD5 digests of the whole key.

Defined results: a null or empty text is one empty line. Rows with null ``doc_id`` count as one
document that ranks below all others. Rows that repeat a ``doc_id`` are one document for the
counts, and each is reassembled. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from cairn.operators.lookups import lookup_join

from .tables import SPACE, written

MIN_CHARS = 20
MIN_DOCS = 3


def _lines(texts: pa.Array, space: str, min_chars: int):
    """Per text its lines, and for each line the 16-byte digest of its key (None: key too short)."""
    md5 = hashlib.md5
    lines = pc.split_pattern(pc.fill_null(texts.cast(pa.large_string()), ""), "\n")
    flat = lines.flatten()
    keys = pc.ascii_lower(pc.utf8_trim(flat, characters=space))
    long_enough = pc.greater_equal(pc.utf8_length(keys), min_chars).to_pylist()
    digests = [md5(k.encode()).digest() if ok else None for k, ok in zip(keys.to_pylist(), long_enough)]
    return lines.offsets.to_pylist(), flat, digests


def key_pairs(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Distinct (key, doc_id) of the lines long enough to count."""
    def emit(batches: Iterator[pa.RecordBatch], space=SPACE) -> Iterator[pa.RecordBatch]:
        for b in batches:
            offsets, _, digests = _lines(b.column("text"), space, min_chars)
            keys, ids = [], []
            for doc, lo, hi in zip(b.column("doc_id").to_pylist(), offsets, offsets[1:]):
                own = {d for d in digests[lo:hi] if d is not None}
                keys.extend(own)
                ids.extend([doc] * len(own))
            yield pa.record_batch({"key": pa.array(keys, pa.binary()), "doc_id": pa.array(ids, pa.int64())})

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(emit, "key binary, doc_id long").distinct()


def deduplicate_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Per input row: doc_id, n_lines, n_dropped, kept (the text that stays)."""
    pairs = written(key_pairs(docs, min_chars), "line-keys")
    common = (pairs.groupBy("key").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper"))
              .filter(F.col("n_docs") >= min_docs).select("key", "keeper", F.lit(True).alias("common")))
    # a line that many documents share is looked up where its pairs lie
    drops = (lookup_join(pairs, written(common, "common-lines"), ["key"]).filter(F.col("common") & ~F.col("doc_id").eqNullSafe(F.col("keeper")))
             .groupBy(F.col("doc_id").alias("drop_id")).agg(F.collect_list("key").alias("drop_keys")))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    joined = (texts.join(drops, F.col("doc_id").eqNullSafe(F.col("drop_id")), "left")
              .select("doc_id", "text", "drop_keys"))

    def rebuild(batches: Iterator[pa.RecordBatch], space=SPACE) -> Iterator[pa.RecordBatch]:
        for b in batches:
            offsets, flat, digests = _lines(b.column("text"), space, min_chars)
            n_lines, n_dropped, kept = [], [], []
            for keys, lo, hi in zip(b.column("drop_keys").to_pylist(), offsets, offsets[1:]):
                own = flat.slice(lo, hi - lo).to_pylist()
                gone = frozenset(keys or ())
                stay = [t for t, d in zip(own, digests[lo:hi]) if d not in gone] if gone else own
                n_lines.append(hi - lo)
                n_dropped.append(hi - lo - len(stay))
                kept.append("\n".join(stay))
            yield pa.record_batch({
                "doc_id": b.column("doc_id"), "n_lines": pa.array(n_lines, pa.int64()),
                "n_dropped": pa.array(n_dropped, pa.int64()), "kept": pa.array(kept, pa.string())})

    return joined.mapInArrow(rebuild, "doc_id long, n_lines long, n_dropped long, kept string")
