"""Token counts of whole texts, with overlap resynchronisation for huge ones.

A text longer than ``chunk_chars`` is cut into chunks that overlap their neighbour. Each chunk is
encoded alone, with offsets; neighbours are spliced at a common boundary ``p`` between two words of
the tokenizer (its pre-tokens), and tokens left of ``p`` are counted from the left chunk, the others
from the right one. Why such a splice is exact:

* The tokenizer finds words from left to right, and where a word ends depends only on what follows
  its start. So from a true boundary on, a chunk's words are the text's words.
* Near its end a chunk may see a word, a look-ahead or a special token cut off. Boundaries at least
  ``margin`` before the end (longer than any special token, plus one character) are not affected.
* By induction the left chunk's boundaries are true ones, so ``p`` is, and the right chunk is in
  step from ``p`` on. ``p`` also keeps ``margin`` from the right chunk's start, so that no special
  token that the start cuts through reaches over it.

Where the overlap holds no common boundary (say, one endless word), it is widened, doubling until
one is found or the left chunk reaches the end of the text. Memory is bounded by the chunk, not the
text. Tokens never cross words, which ``_spliceable`` checks in the tokenizer's own definition;
others (and ``.model`` files) are encoded whole.

Shorter texts are cut into words by the same pattern; each distinct word's tokens come from the
library's model once and their number is remembered in a table of bounded size.

Defined results: null and empty texts have 0 bytes and 0 tokens. One row per input row; other
columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

CHUNK_CHARS = 65_536
OVERLAP_CHARS = 512
TOKEN_LIMIT = 1024
MEMORY_WORDS = 300_000

# The published word pattern of byte-level vocabularies, and the last character whose
# class every Unicode version in use agrees on.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LAST_PLAIN = "\u024f"


def _spliceable(spec: dict) -> bool:
    """Byte-level words found by the usual pattern, and special tokens without options."""
    pre = spec.get("pre_tokenizer") or {}
    plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"]) and not re.search(r"\s", t["content"])
                for t in spec.get("added_tokens", []))
    return (spec.get("normalizer") is None and spec.get("truncation") is None and spec.get("padding") is None
            and pre.get("type") == "ByteLevel" and bool(pre.get("use_regex", True))
            and not pre.get("add_prefix_space", False) and plain)


def _encoded(tok, text: str, start: int) -> tuple[list[int], list[int]]:
    """Start offsets of a chunk's tokens in the whole text, and which of them start a word."""
    e = tok.encode(text, add_special_tokens=False)
    at = [start + o[0] for o in e.offsets]
    words = e.word_ids
    return at, [at[i] for i in range(1, len(at)) if words[i] != words[i - 1]]


def spliced_count(tok, text: str, chunk: int, overlap: int, margin: int) -> int:
    """Tokens of a long text, from overlapping chunks."""
    total, begin, lo = 0, 0, 0
    at, words = _encoded(tok, text[:chunk + overlap], 0)
    hi = min(len(text), chunk + overlap)
    while hi < len(text):
        nxt, wide = hi - overlap, overlap
        r_hi = min(len(text), nxt + chunk + overlap)
        r_at, r_words = _encoded(tok, text[nxt:r_hi], nxt)
        while True:
            known = {p for p in r_words if p >= nxt + margin}
            p = next((p for p in words if begin < p <= hi - margin and p in known), None)
            if p is not None or hi == len(text):
                break
            wide *= 2
            hi = min(len(text), hi + wide)
            at, words = _encoded(tok, text[lo:hi], lo)
            if hi > r_hi - overlap:
                r_hi = min(len(text), hi + chunk)
                r_at, r_words = _encoded(tok, text[nxt:r_hi], nxt)
        if p is None:
            break
        total += sum(begin <= a < p for a in at)
        begin, lo, hi, at, words = p, nxt, r_hi, r_at, r_words
    return total + sum(a >= begin for a in at)


def _byte_letters() -> dict[int, str]:
    """How byte-level vocabularies spell bytes: printable ones as themselves, the others shifted up."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class _Words:
    """Token counts of short texts by word, remembered up to a bound.

    A space after a non-space always begins a word, so texts are cut there first; each distinct
    piece is cut into words by the published pattern, and each distinct word's tokens come from the
    library's own model. Texts with special tokens, or with characters on whose classes Unicode
    versions differ, are encoded whole.
    """

    def __init__(self, tok, bound: int, special: list[str]) -> None:
        self.tok, self.bound, self.special = tok, bound, special
        self.pieces, self.words = {}, {}
        self.pattern = regex.compile(WORD_PATTERN)
        self.rare = re.compile(f"[^\x00-{LAST_PLAIN}]")
        self.run = re.compile("[\t\n\x0b\x0c\r \x85\xa0] |^ ")
        self.letters = _byte_letters()

    def word(self, w: str) -> int:
        n = self.words.get(w)
        if n is None:
            n = self.words[w] = len(self.tok.model.tokenize(w.encode().decode("latin-1").translate(self.letters)))
        return n

    def whole(self, text: str) -> int:
        if self.rare.search(text) or any(s in text for s in self.special):
            return len(self.tok.encode(text, add_special_tokens=False))
        return sum(map(self.word, self.pattern.findall(text)))

    def counts(self, texts: list[str]) -> list[int]:
        if len(self.pieces) > self.bound:
            self.pieces = {}
        if len(self.words) > self.bound:
            self.words = {}
        plain = [not (self.run.search(t) or self.rare.search(t) or any(s in t for s in self.special)) for t in texts]
        cut = [t.split(" ") if ok else () for t, ok in zip(texts, plain)]
        known = self.pieces
        for p in set().union(*[c[1:] for c in cut]):
            if p not in known:
                known[p] = self.whole(" " + p)
        get = known.__getitem__
        return [self.whole(c[0]) + sum(map(get, c[1:])) if ok else self.whole(t)
                for t, ok, c in zip(texts, plain, cut)]


def _counter(name: str, definition: bytes, chunk: int, overlap: int, memory: int) -> Callable[[list[str]], list[int]]:
    if name.endswith(".model"):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_proto=definition)
        return lambda texts: [len(sp.encode(t)) for t in texts]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tok, spec = Tokenizer.from_str(definition.decode()), json.loads(definition)
    if not _spliceable(spec):
        return lambda texts: [len(tok.encode(t, add_special_tokens=False)) for t in texts]
    special = [t["content"] for t in spec.get("added_tokens", [])]
    margin = 2 + max(map(len, special), default=0)
    short = _Words(tok, memory, special)

    def count(texts: list[str]) -> list[int]:
        small = iter(short.counts([t if len(t) <= chunk else "" for t in texts]))
        return [n if len(t) <= chunk else spliced_count(tok, t, chunk, overlap, margin) for t, n in zip(texts, small)]

    return count


def count_tokens(docs: DataFrame, tokenizer: str, chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS,
                 token_limit: int = TOKEN_LIMIT, memory_words: int = MEMORY_WORDS) -> DataFrame:
    """Per input row: doc_id, n_bytes, n_tokens, over_limit. ``tokenizer`` is a path on the driver."""
    with open(tokenizer, "rb") as f:
        definition = docs.sparkSession.sparkContext.broadcast(f.read())   # one tokenizer file, a few MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = None
        for b in batches:
            count = count or _counter(tokenizer, definition.value, chunk_chars, overlap_chars, memory_words)
            texts = [t or "" for t in b.column("text").to_pylist()]
            n = [k for i in range(0, len(texts), 256) for k in count(texts[i:i + 256])]
            yield pa.record_batch({
                "doc_id": b.column("doc_id"), "n_bytes": pa.array([len(t.encode()) for t in texts], pa.int64()),
                "n_tokens": pa.array(n, pa.int64()), "over_limit": pa.array([k > token_limit for k in n], pa.bool_())})

    slim = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text")
    return slim.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
