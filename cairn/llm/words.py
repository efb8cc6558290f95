"""Vectorised word hashing for functions that run inside Python workers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

SPACES = b" \t\n\x0b\x0c\r"
STEP_BYTES = 1 << 18


def in_parts(texts: list[bytes | None], limit: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about ``limit`` bytes, so that working memory does not follow the
    size of an Arrow batch."""
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size < limit):
            size += len(texts[hi] or b"")
            hi += 1
        yield lo, hi
        lo = hi


def hashed_words(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of all texts, A-Z lower-cased, and the texts' bounds in them."""
    (h,), at = hashed_prefixes(texts, (None,))
    return h, at


def hashed_prefixes(texts: list[bytes | None], cuts: Sequence[int | None]) -> tuple[list[np.ndarray], np.ndarray]:
    """For each of ``cuts`` the hashes of all words' first ``cut`` bytes (None: of whole words), and the
    texts' bounds in them.

    Words are runs of bytes other than the six ASCII white-space characters. The hash is a
    polynomial over the word's bytes modulo 2**64 with a final mix, computed from prefix sums in
    steps of about 256 KB cut at white space.
    """
    sizes = np.fromiter((len(t or b"") for t in texts), np.int64, len(texts))
    ends = np.cumsum(sizes + 1)
    joined = (b"\n".join(t or b"" for t in texts) + b"\n").lower()
    raw = np.frombuffer(joined, np.uint8)
    gap = np.zeros(256, bool)
    gap[list(SPACES)] = True
    hashes, starts, lo, n = [[] for _ in cuts], [], 0, len(raw)
    power = inverse = None
    while lo < n:
        hi = min(n, lo + STEP_BYTES)
        while hi < n and not gap[raw[hi - 1]]:
            more = np.flatnonzero(gap[raw[hi:hi + STEP_BYTES]])
            hi = hi + int(more[0]) + 1 if len(more) else min(n, hi + STEP_BYTES)
        part = raw[lo:hi]
        if power is None or len(power) <= len(part):
            base = np.uint64(0x9E3779B97F4A7C15)
            back = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
            power, inverse = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(part) + STEP_BYTES, b, np.uint64)]))
                              for b in (base, back))
        word = ~gap[part]
        edge = np.diff(np.concatenate([[0], word.view(np.int8), [0]]))
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((part.astype(np.uint64) + np.uint64(1)) * power[:len(part)])])
        for cut, found in zip(cuts, hashes):
            end = last if cut is None else np.minimum(last, first + cut)
            found.append(mixed((total[end] - total[first]) * inverse[first]))
        starts.append(first + lo)
        lo = hi
    h = [np.concatenate(x) if x else np.zeros(0, np.uint64) for x in hashes]
    at = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    return h, np.concatenate([[0], np.searchsorted(at, ends)]).astype(np.int64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that all its bits depend on all of the input's."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))
