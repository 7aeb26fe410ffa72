"""Side-by-side view: the paragraphs of a chapter and of its translation, aligned by length.

A step pairs one paragraph with one, one with two, two with one, or leaves one
alone; it costs the difference of the lengths in characters, and MERGE or ALONE
for what isn't one to one. The cheapest alignment is found over a band around the
diagonal, which is doubled until no path that leaves it could be as cheap; of
equal ones the walk from the start takes the first of STEPS. Tasks see lengths
only; texts stay in the JVM.

Paragraphs are what blank lines part, stripped, blank ones left out. A null text
has none. Every row of pairs is aligned for itself.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from quire.functions.text import py_strip

MERGE, ALONE = 20, 40
#: (source paragraphs, translated paragraphs) of a step, preferred in this order.
STEPS = ((1, 1), (1, 2), (2, 1), (1, 0), (0, 1))
BAND = 8
_FAR = 1 << 60


def paragraphs(text: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n\n", -1), py_strip), lambda p: p != "")


def step_cost(a: int, b: int, n: int, m: int) -> int:
    """Of a step over n and m paragraphs with a and b characters."""
    return abs(a - b) + (0 if (n, m) == (1, 1) else MERGE if n and m else ALONE)


def _rows(a: np.ndarray, b: np.ndarray, width: int) -> list[tuple[int, np.ndarray]]:
    """For each i from the end: the first j of the band and the cost from (i, j) on."""
    n, m = len(a), len(b)
    low, high = min(0, m - n) - width, max(0, m - n) + width
    before = np.r_[0, np.cumsum(b + ALONE)]
    two = b[:-1] + b[1:] if m > 1 else np.zeros(0, np.int64)
    out: list[tuple[int, np.ndarray]] = [(0, np.zeros(0, np.int64))] * (n + 1)

    def at(i: int, j: np.ndarray) -> np.ndarray:
        """Costs from (i, j) on, far where that lies outside."""
        if i > n:
            return np.full(len(j), _FAR)
        first, own = out[i]
        k = j - first
        ok = (k >= 0) & (k < len(own))
        return np.where(ok, own[np.clip(k, 0, max(len(own) - 1, 0))] if len(own) else _FAR, _FAR)

    for i in range(n, -1, -1):
        j = np.arange(max(0, i + low), min(m, i + high) + 1)
        best = np.where((j == m) & (i == n), 0, _FAR)
        if i < n:
            one, pair = b[np.minimum(j, m - 1)] if m else np.zeros(len(j), np.int64), two[np.minimum(j, m - 2)] if m > 1 else np.zeros(len(j), np.int64)
            best = np.minimum(best, a[i] + ALONE + at(i + 1, j))
            best = np.minimum(best, np.where(j < m, np.abs(a[i] - one) + at(i + 1, j + 1), _FAR))
            best = np.minimum(best, np.where(j < m - 1, np.abs(a[i] - pair) + MERGE + at(i + 1, j + 2), _FAR))
            if i < n - 1:
                best = np.minimum(best, np.where(j < m, np.abs(a[i] + a[i + 1] - one) + MERGE + at(i + 2, j + 1), _FAR))
        # Translated paragraphs left alone, any number of them: the least over all j behind this one.
        best = np.minimum.accumulate((best + before[j])[::-1])[::-1] - before[j]
        out[i] = (int(j[0]) if len(j) else 0, np.minimum(best, _FAR))
    return out


def align(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """The steps, as (source paragraphs, translated paragraphs), of the cheapest alignment."""
    x, y, width = np.array(a, np.int64), np.array(b, np.int64), BAND
    n, m = len(a), len(b)
    while True:
        rows = _rows(x, y, width)
        cost = int(rows[0][1][0 - rows[0][0]])
        # Off the diagonal every step costs MERGE at least; a path outside takes so many of them.
        if cost < MERGE * (abs(m - n) + 2 * (width + 1)) or width >= n + m:
            break
        width *= 2

    def left(i: int, j: int) -> int:
        first, own = rows[i] if i <= n else (0, x[:0])
        return int(own[j - first]) if i <= n and 0 <= j - first < len(own) else _FAR

    out, i, j = [], 0, 0
    while (i, j) != (n, m):
        now = left(i, j)
        for p, q in STEPS:
            if i + p <= n and j + q <= m and step_cost(sum(a[i : i + p]), sum(b[j : j + q]), p, q) + left(i + p, j + q) == now:
                out.append((p, q))
                i, j = i + p, j + q
                break
    return out


STEP = ArrayType(StructType().add("n", "integer").add("i", "integer").add("m", "integer").add("j", "integer"))


@F.udf(STEP, useArrow=False)
def _aligned(a: list[int], b: list[int]) -> list[tuple[int, int, int, int]]:
    """The steps, with where they begin, from one. Python gets the lengths alone, the texts stay with Spark."""
    i, j, steps = 1, 1, []
    for n, m in align(a, b):
        steps.append((n, i, m, j))
        i, j = i + n, j + m
    return steps


def side_by_side(pairs: DataFrame, keys: tuple[str, ...] = ("book_id", "chapter_pos"), source: str = "source", translated: str = "translated") -> DataFrame:
    """(keys, step, n, m, source_text, translated_text): the rows of the view in order, for each row of ``pairs``."""
    texts = pairs.select(*keys, paragraphs(F.col(source)).alias("a"), paragraphs(F.col(translated)).alias("b"))
    steps = texts.select(*keys, "a", "b", _aligned(F.transform("a", F.length), F.transform("b", F.length)).alias("steps"))
    rows = steps.select(*keys, "a", "b", F.posexplode("steps").alias("step", "s"))
    cut = lambda of, begin, count: F.array_join(F.slice(of, F.col(begin), F.col(count)), "\n\n")
    return rows.select(*keys, "step", "s.n", "s.m", cut("a", "s.i", "s.n").alias("source_text"), cut("b", "s.j", "s.m").alias("translated_text"))
