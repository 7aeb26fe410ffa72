"""Sets of word shingles, and their exact comparison: texts are linked by a Jaccard similarity of THRESHOLD or more.

Texts are lower-cased in A-Z; a set holds the hashes of all runs of ``SHINGLE``
words (fewer words: all of them as one); a text without words has the empty set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import slices, utf8
from ._vector import LOWER, mix, separators, span_hash, words

SHINGLE = 5
#: 4 / 5, as whole numbers.
THRESHOLD = (4, 5)
_SPACE = separators("space")


def shingle_sets(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts' distinct shingle hashes, ascending by text, and where each text's begin (one entry more than texts)."""
    buf = LOWER[buf]
    starts, ends, first = words(buf, offsets, _SPACE)
    values = span_hash(buf, starts, ends)
    n = np.diff(first)
    sizes = np.where(n > 0, np.maximum(n - SHINGLE + 1, 1), 0)
    owner = np.repeat(np.arange(len(n)), sizes)
    begin = first[owner] + np.arange(len(owner)) - (np.cumsum(sizes) - sizes)[owner]
    hashed = mix(span_hash(values, begin, np.minimum(begin + SHINGLE, first[owner + 1])))
    order = np.lexsort((hashed, owner))
    hashed, owner = hashed[order], owner[order]
    new = np.ones(len(hashed), bool)
    new[1:] = (hashed[1:] != hashed[:-1]) | (owner[1:] != owner[:-1])
    return hashed[new], np.searchsorted(owner[new], np.arange(len(n) + 1))


#: Bins of a sketch, and what its values say by chance.
BINS, CHANCE = 192, 1 / 15
#: Deviations below the mean of two sets at the threshold that still pass.
SLACK = 3.0


def sketches(hashed: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Of each set BINS bins by the hashes' size: one to fifteen for the bin's smallest hash, zero if it is empty; two bins a byte."""
    owner = np.repeat(np.arange(len(cut) - 1), np.diff(cut))
    bins = owner * BINS + ((hashed >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]]) if len(bins) else np.zeros(0, np.int64)
    out = np.zeros((len(cut) - 1) * BINS, np.uint8)
    out[bins[first]] = 1 + (mix(hashed[first]) % np.uint64(15)).astype(np.uint8)
    return (out[0::2] << 4 | out[1::2]).reshape(len(cut) - 1, BINS // 2)


def alike(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Which of the sketches may be of sets as similar as the threshold: bins agree in too few cases only by more than SLACK deviations."""
    low, high = others & 15, others >> 4
    a, b = one & 15, one >> 4
    some = ((low | a) > 0).sum(1) + ((high | b) > 0).sum(1)
    same = ((low == a) & (a > 0)).sum(1) + ((high == b) & (b > 0)).sum(1)
    p = THRESHOLD[0] / THRESHOLD[1] + (1 - THRESHOLD[0] / THRESHOLD[1]) * CHANCE
    return same >= p * some - SLACK * np.sqrt(p * (1 - p) * some)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    over, under = THRESHOLD
    for batch in slices(batches):
        hashed, cut = shingle_sets(*utf8(batch.column(2)))
        others, cut_ = shingle_sets(*utf8(batch.column(3)))
        pair = np.arange(batch.num_rows)
        owner, every = np.concatenate([np.repeat(pair, np.diff(cut)), np.repeat(pair, np.diff(cut_))]), np.concatenate([hashed, others])
        order = np.lexsort((every, owner))
        owner, every = owner[order], every[order]
        same = (owner[1:] == owner[:-1]) & (every[1:] == every[:-1])
        common = np.bincount(owner[1:][same], minlength=batch.num_rows)
        linked = under * common >= over * (np.diff(cut) + np.diff(cut_) - common)
        yield pa.record_batch([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(linked))


def fit(n: str, m: str) -> Column:
    """Sets of these sizes can be similar enough."""
    over, under = THRESHOLD
    return under * F.least(n, m) >= over * F.greatest(n, m)


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts' sets are similar enough."""
    one, two = texts.select(F.col("doc_id").alias("a"), "text"), texts.select(F.col("doc_id").alias("b"), F.col("text").alias("other"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "text", "other").mapInArrow(_compare, "a long, b long")
