"""Vectorised text primitives over UTF-8 buffers: word spans, span hashes, sliding minima.

Everything works on the bytes of a batch of documents laid end to end, so a
batch costs a handful of numpy passes whatever the number of documents. All
arithmetic is modulo 2**64. Working memory is a small multiple of
``SEGMENT`` elements plus the batch itself; callers bound the batch.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
#: Elements hashed per numpy pass.
SEGMENT = 1 << 18
#: Odd multiplier of the polynomial hash (any odd number is invertible mod 2**64).
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)
#: Multiplier of a span's size.
_SIZE = 0xD6E8FEB86659FD93

_powers: list[np.ndarray] = []


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, 2 * SEGMENT)
        _powers[:] = [
            np.concatenate([np.ones(1, U64), np.cumprod(np.full(size - 1, base, U64), dtype=U64)])
            for base in (BASE, BASE_INVERSE)
        ]
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser, so that every output bit depends on every input bit."""
    x = x ^ (x >> U64(31))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def span_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of values[start:end] for every span; ``starts`` must ascend.

    Equal contents give equal hashes wherever the span lies, because the
    prefix sum of a span is brought back to position zero by the inverse power.
    """
    out = np.empty(len(starts), U64)
    i = 0
    while i < len(starts):
        a = int(starts[i])
        j = int(np.searchsorted(starts, a + SEGMENT, "left"))
        b = max(int(ends[i:j].max()), a)
        power, inverse = _tables(b - a + 1)
        prefix = np.zeros(b - a + 1, U64)
        np.cumsum((values[a:b].astype(U64) + U64(1)) * power[: b - a], out=prefix[1:], dtype=U64)
        s, e = starts[i:j] - a, ends[i:j] - a
        out[i:j] = (prefix[e] - prefix[s]) * inverse[s] + (e - s).astype(U64) * U64(_SIZE)
        i = j
    return mix(out)


class Spans:
    """The hashes of ``span_hash`` for many spans of few values, in any order; takes 24 bytes a value."""

    def __init__(self, values: np.ndarray):
        power, self.inverse = _tables(len(values) + 1)
        self.prefix = np.zeros(len(values) + 1, U64)
        np.cumsum((values.astype(U64) + U64(1)) * power[: len(values)], out=self.prefix[1:], dtype=U64)

    def alike(self, starts: np.ndarray, sizes: np.ndarray | int) -> np.ndarray:
        """Numbers that are equal for equal spans of one size."""
        return (self.prefix[starts + sizes] - self.prefix[starts]) * self.inverse[starts]

    def hash(self, starts: np.ndarray, sizes: np.ndarray | int) -> np.ndarray:
        return mix(self.alike(starts, sizes) + np.asarray(sizes).astype(U64) * U64(_SIZE))

    def every(self, size: int) -> np.ndarray:
        """Hashes of the spans of ``size`` values, from the first to the last."""
        n = max(len(self.prefix) - size, 0)
        return mix((self.prefix[size:] - self.prefix[:n]) * self.inverse[:n] + U64(size * _SIZE & (1 << 64) - 1))


def separators(pattern: str) -> np.ndarray:
    """256 flags: the bytes that are not part of a word. 'space' or 'alnum'."""
    flags = np.zeros(256, bool)
    if pattern == "space":  # words [^\x20\x09-\x0D]+
        flags[[0x20, *range(0x09, 0x0E)]] = True
    else:  # words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+, upper case folded before
        flags[0x00:0x30] = flags[0x3A:0x61] = flags[0x7B:0x80] = True
    return flags


#: Byte table that lower-cases A-Z and nothing else.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def words(buf: np.ndarray, offsets: np.ndarray, sep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words of the documents buf[offsets[d]:offsets[d+1]],
    and first[d]: the index of the first word of document d (one entry more than documents)."""
    gap = sep[buf]
    edge = np.ones(len(buf) + 1, bool)
    edge[1:-1] = gap[:-1]
    edge[offsets] = True  # a word ends with its document
    starts = np.flatnonzero(~gap & edge[:-1])
    after = np.ones(len(buf) + 1, bool)
    after[:-1] = gap
    after[offsets] = True
    ends = np.flatnonzero(~gap & after[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def windows(first: np.ndarray, size: int) -> np.ndarray:
    """Starts of all runs of ``size`` consecutive elements that stay inside one document."""
    n = int(first[-1])
    ok = np.ones(n, bool)
    for a, b in zip(np.maximum(first[1:] - size + 1, first[:-1]), first[1:], strict=True):
        ok[a:b] = False
    return np.flatnonzero(ok)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """min(values[i:i+width]) for every i that has so many elements, by doubling widths."""
    if len(values) < width:
        return values[:0]
    have, out = 1, values
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out
