"""Words of whole texts as arrays: positions and 64-bit hashes, for many documents at once."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa

#: Bytes of text that are taken at once; a longer text is taken alone.
CHUNK_BYTES = 1 << 20
U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | U(1)
_BASE = U(0x9E3779B97F4A7C15)
_BASE_INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 2**64))
_powers: dict[str, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    for a, b in ranges:
        out[a : b + 1] = True
    return out


#: Bytes that no word holds where words are runs of [^\x20\x09-\x0D].
SPACES = byte_set((0x20, 0x20), (0x09, 0x0D))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on each other."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1)
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= 4 * CHUNK_BYTES:
            _powers[name] = have
    return have[:n]


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; a null text is an empty one."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=len(texts) + 1 + texts.offset)[texts.offset :]
    if texts.buffers()[2] is None:
        return np.zeros(0, dtype=np.uint8), offsets - offsets[0]
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents with at most ``limit`` bytes, or of one document."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield at, end
        at = end


def word_spans(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte spans of all words, and the index of each document's first word (one more at the end)."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = ~separators[data]
    begins = inside[1:-1] & ~inside[:-2]
    stops = inside[1:-1] & ~inside[2:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] = inside[1:-1][edges]
    stops[edges - 1] = inside[1:-1][edges - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, the same wherever the span stands."""
    n = len(data)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * _power("up", _BASE, n), out=total[1:])
    h = (total[ends] - total[starts]) * _power("down", _BASE_INVERSE, n + 1)[starts]
    return mix(h + (ends - starts).astype(np.uint64) * U(0xD6E8FEB86659FD93))


def word_hashes(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words in order, index of each document's first word)."""
    if lower:
        data = LOWER[data]
    starts, ends, first = word_spans(data, offsets, separators)
    return span_hashes(data, starts, ends), first


def shingle_hashes(words: np.ndarray, first: np.ndarray, size: int) -> list[np.ndarray]:
    """Each document's distinct shingles of ``size`` words, sorted; fewer words make one shingle, none make none."""
    n = max(0, len(words) - size + 1)
    rolled = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        rolled = mix(rolled * _BASE + words[k : k + n]) if k % 2 else rolled * _BASE + words[k : k + n]
    rolled = mix(rolled + U(size))
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(rolled[a : b - size + 1]))
        elif b > a:
            h = np.zeros(1, dtype=np.uint64)
            for k in range(a, b):
                h = mix(h * _BASE + words[k : k + 1])
            out.append(mix(h + U(b - a)))
        else:
            out.append(words[:0])
    return out


def release() -> None:
    """Give freed memory back to the system: workers live long, and what they hold counts against their executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc alone
    if trim:
        trim(0)


def tidy(run: Callable) -> Callable:
    """A function over batches, or over groups, that gives memory back after every one."""

    @wraps(run)
    def over(first):
        if not isinstance(first, pa.Table):
            return batches(first)
        try:
            return run(first)
        finally:
            release()

    def batches(given):
        def passed():
            for batch in given:
                yield batch
                del batch
                release()

        yield from run(passed())
        release()

    return over


def tidy_pair(run: Callable) -> Callable:
    """``tidy`` for a function over two groups."""

    @wraps(run)
    def over(left, right):
        try:
            return run(left, right)
        finally:
            release()

    return over
