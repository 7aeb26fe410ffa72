"""Blocks of windows that share a minimiser: how repeated windows are found without shuffling every window.

A window's key is the smallest hash of its ``gram``-grams. Equal windows have
equal keys, so a window can only be repeated if its key is. Neighbouring
windows mostly share their key at one place, the leftmost; a maximal run of them
(at most ``RUN`` long) is a block, described by its key, the hash of all it covers, and its place.
Windows of one block have that place at different offsets, so none of them are
equal. Cutting a run anywhere is harmless: blocks with equal keys but unlike contents
are compared window by window later on.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from ._vector import Spans, sliding_min

#: Window starts handled per numpy pass, and the longest run.
SECTION = 1 << 18
RUN = 1 << 10


@dataclass
class Blocks:
    doc: np.ndarray  # index of the document in the batch
    at: np.ndarray  # start of the block's first window, counted in elements from the document's start
    size: np.ndarray  # windows
    key: np.ndarray
    content: np.ndarray
    start: np.ndarray  # start in the batch
    gram: np.ndarray  # place of the key's gram in the batch
    low: int  # start of the section in the batch
    spans: Spans  # of all that the section's windows cover


#: Bits of a place within a section; the other bits of a packed value order the grams.
_PLACE = np.uint64((1 << 19) - 1)


def blocks(values: np.ndarray, first: np.ndarray, width: int, gram: int, reach: int = 0):
    """Yields the Blocks of documents values[first[d]:first[d+1]], section by section.

    With a ``reach`` over ``width`` a block's content goes on as far as windows of that width would, within its document.
    """
    n, reach = len(values), max(width, reach)
    ok = np.ones(n, bool)
    for a, b in zip(np.maximum(first[1:] - width + 1, first[:-1]), first[1:], strict=True):
        ok[a:b] = False
    for low in range(0, n, SECTION):
        starts = low + np.flatnonzero(ok[low : low + SECTION])
        if not len(starts):
            continue
        part = values[low : low + SECTION + reach - 1]
        spans = Spans(part)
        hashes = spans.every(gram)
        packed = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
        least = (sliding_min(packed, width - gram + 1)[starts - low] & _PLACE).astype(np.int64)
        cut = np.ones(len(starts), bool)
        cut[1:] = (least[1:] != least[:-1]) | (starts[1:] != starts[:-1] + 1)
        at = np.flatnonzero(cut)
        size = np.diff(np.append(at, len(starts)))
        if size.max(initial=0) > RUN:
            extra = [np.arange(a, a + s, RUN) for a, s in zip(at, size, strict=True)]
            at = np.concatenate(extra)
            size = np.diff(np.append(at, len(starts)))
        begin = starts[at]
        doc = np.searchsorted(first, begin, "right") - 1
        covered = np.minimum(size + reach - 1, first[doc + 1] - begin)
        yield Blocks(doc, begin - first[doc], size, hashes[least[at]], spans.hash(begin - low, covered), begin, low + least[at], low, spans)


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open ranges as disjoint, non-touching ones in ascending order."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] > ends[:-1]
    last = np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1)
    return starts[new], ends[last]
