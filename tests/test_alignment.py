"""Alignment against the whole table of the dynamic program."""

import functools
import random

import numpy as np
import pytest

from quire.operators import alignment as A


def plain(a, b):
    """Steps of the cheapest alignment, ties by the order of STEPS."""

    @functools.cache
    def best(i, j):
        if (i, j) == (len(a), len(b)):
            return 0, ()
        options = []
        for k, (p, q) in enumerate(A.STEPS):
            if i + p <= len(a) and j + q <= len(b):
                cost, steps = best(i + p, j + q)
                options.append((A.step_cost(sum(a[i : i + p]), sum(b[j : j + q]), p, q) + cost, k, steps))
        cost, k, steps = min(options, key=lambda x: x[:2])
        return cost, (A.STEPS[k], *steps)

    return list(best(0, 0)[1])


@pytest.mark.parametrize("band", [1, 8])
def test_cheapest_alignment(monkeypatch, band):
    monkeypatch.setattr(A, "BAND", band)
    rng = random.Random(band)
    for _ in range(300):
        a = [rng.choice([1, 5, 40, 200, 900]) for _ in range(rng.randint(0, 12))]
        b = list(a)
        for _ in range(rng.randint(0, 5)):
            k = rng.randrange(len(b) + 1)
            b[k:k] = [] if rng.random() < 0.5 else [rng.choice([3, 60, 300])]
            if b and rng.random() < 0.6:
                del b[rng.randrange(len(b))]
        if rng.random() < 0.2:
            b = [rng.randint(1, 50) for _ in range(rng.randint(0, 30))]
        assert A.align(a, b) == plain(a, b)


def test_long_chapter():
    """Past the first band: forty paragraphs are lost in the middle of a thousand; as cheap as over the whole table."""
    rng = random.Random(7)
    a = [rng.randint(20, 900) for _ in range(1000)]
    b = a[:400] + a[440:]
    steps, i, j, cost = A.align(a, b), 0, 0, 0
    for p, q in steps:
        cost += A.step_cost(sum(a[i : i + p]), sum(b[j : j + q]), p, q)
        i, j = i + p, j + q
    assert (i, j) == (1000, 960)
    assert cost == A._rows(np.array(a), np.array(b), 2000)[0][1][0]


def test_side_by_side(spark):
    rows = [("b", 1, "One.\n\nTwo is longer.\n\n\n\n  \n\nThree.", "Eins.\n\nZwei ist laenger.\n\nDrei."), ("b", 2, "x" * 90 + "\n\n" + "y" * 80, "z" * 172), ("b", 3, "only", None), ("b", 4, None, "only"), ("b", 5, None, ""), ("b", 1, "again", "again")]
    found = A.side_by_side(spark.createDataFrame(rows, "book_id string, chapter_pos int, source string, translated string"))
    by = {}
    for r in found.orderBy("chapter_pos", "step").collect():
        by.setdefault(r["chapter_pos"], []).append((r["n"], r["m"], r["source_text"], r["translated_text"]))
    assert sorted(by[1]) == sorted([(1, 1, "One.", "Eins."), (1, 1, "Two is longer.", "Zwei ist laenger."), (1, 1, "Three.", "Drei."), (1, 1, "again", "again")])
    assert by[2] == [(2, 1, "x" * 90 + "\n\n" + "y" * 80, "z" * 172)]
    assert by[3] == [(1, 0, "only", "")] and by[4] == [(0, 1, "", "only")] and 5 not in by


def test_python_gets_lengths_alone(spark):
    pairs = spark.createDataFrame([("b", 1, "one\n\ntwo", "uno\n\ndos")], "book_id string, chapter_pos int, source string, translated string")
    plan = A.side_by_side(pairs)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython [_aligned(" in plan and "Arrow" not in plan
