"""The language model: seating against its exact distribution, the whole against a plain version, and layouts."""

import math
import random
import zlib
from collections import Counter
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import language_model as lm
from quire.llm._vector import mix, span_hash

from . import brute
from .test_operators import ROWS, frame, prose, rows_of


def test_seatings_follow_their_distribution():
    """P(t) is in proportion to fresh ** t times the generalised Stirling number of the count."""
    for n, fresh, d in ((2, 0.7, 0.5), (5, 0.7, 0.5), (8, 2.5, 0.3), (6, 0.05, 0.8)):
        stirling = {(1, 1): 1.0}
        for c in range(1, n):
            for t in range(1, c + 2):
                stirling[c + 1, t] = stirling.get((c, t - 1), 0.0) + (c - d * t) * stirling.get((c, t), 0.0)
        weight = np.array([fresh**t * stirling[n, t] for t in range(1, n + 1)])
        got = lm.seat(np.full(40_000, n), np.full(40_000, fresh), d, np.random.default_rng(3))
        assert np.abs(np.bincount(got, minlength=n + 1)[1:] / 40_000 - weight / weight.sum()).max() < 0.01


def test_seatings_of_large_cells():
    n = np.array([0, 1, 3000, 100_000])
    t = np.array([lm.seat(n, np.full(4, 5.0), 0.5, np.random.default_rng(k)) for k in range(30)])
    assert (t[:, 0] == 0).all() and (t[:, 1] == 1).all() and (t <= np.maximum(n, 1)).all()
    steps = np.zeros(30)
    for k in range(30):  # one customer after the other
        rng, tables = np.random.default_rng(100 + k), 1
        for i in range(1, 3000):
            tables += rng.random() * (5.0 + i - 0.5 * tables) < 5.0
        steps[k] = tables
    assert abs(t[:, 2].mean() - steps.mean()) < 0.25 * steps.mean()  # unweighted steps, so nearly


def test_strengths_are_drawn_around_what_seated_the_customers():
    """The Gibbs draws of a strength, with everything else known, come back to the one that was used."""
    rng, d, s = np.random.default_rng(5), 0.4, 6.0
    customers, tables = np.full(300, 200), np.zeros(300, np.int64)
    for u in range(300):
        t = 0
        for i in range(200):
            t += rng.random() < (s + d * t) / (s + i)
        tables[u] = t
    at, seen = 1.0, []
    for _ in range(60):
        opened, waited = lm._aux(customers, tables, d, at, rng)
        at = rng.gamma(1 + opened, 1 / (1 + waited))
        seen.append(at)
    assert abs(np.mean(seen[20:]) - s) < 1


def _key(word):
    if word is None:
        return int(lm.END & lm.MASK)
    raw = np.frombuffer(word.encode(), np.uint8)
    return int(span_hash(raw, np.array([0]), np.array([len(raw)]))[0] & lm.MASK)


def plain(rows):
    """One part, counted and seated in dictionaries; draws come in the model's order of cells and words."""
    start = int(lm.START & lm.MASK)
    texts = [(doc, [_key(w) for w in brute.WORD.findall(brute.lower(text or ""))] + [_key(None)]) for doc, text in rows]
    train = [zlib.crc32(str(doc).encode()) % 10 > 0 for doc, _ in texts]
    pairs = [list(zip([start, *ts[:-1]], ts, strict=True)) for _, ts in texts]
    n = Counter(w for (_, ts), own in zip(texts, train, strict=True) if own for w in [start, *ts])
    cells = Counter(c for ps, own in zip(pairs, train, strict=True) if own for c in ps)
    u64 = lambda x: np.array([x], np.uint64)
    many = sorted((c for c in cells if cells[c] > 1), key=lambda c: int(mix(mix(u64(c[0])) + u64(c[1]))[0]))
    names = sorted(n)
    total, rng = lm.Totals(known=len(n) - 1), np.random.default_rng(9)
    ones, twos = (sum(x == k for x in cells.values()) for k in (1, 2))
    total = replace(total, d1=lm._beta(rng, ones, twos))
    t, samples, seatings = dict.fromkeys(cells, 1), [], []
    for k in range(lm.ROUNDS + 1):
        below, above = Counter(), Counter()
        for (u, w), x in t.items():
            below[u] += x
            above[w] += x
        draw = np.random.default_rng((k, 0))
        seated = dict(zip(names, lm.seat(np.array([above[w] for w in names]), np.full(len(names), total.base()), total.d0, draw), strict=True))
        some = [w for w in names if below[w]]
        opened, waited = lm._aux(np.array([n[w] for w in some]), np.array([below[w] for w in some]), total.d1, total.s1, draw)
        total = replace(total, customers=float(sum(above.values())), tables=float(sum(seated.values())))
        if k <= lm.ROUNDS - lm.SAMPLES:
            single, double = (sum(above[w] == x for w in names) for x in (1, 2))
            total = replace(total, d1=lm._beta(rng, ones, twos), d0=lm._beta(rng, single, double), s1=float(rng.gamma(1 + round(opened, 3), 1 / (1 + round(waited, 3)))) + 1e-3)
            opened, waited = lm._aux(np.array([total.customers]), np.array([total.tables]), total.d0, total.s0, rng)
            total = replace(total, s0=float(rng.gamma(1 + opened, 1 / (1 + waited))) + 1e-3)
        p = lambda w, total=total, above=above, seated=seated: (max(above[w] - total.d0 * seated.get(w, 0), 0) + (total.s0 + total.d0 * total.tables) / (total.known + 1)) / (total.s0 + total.customers)
        if k > lm.ROUNDS - lm.SAMPLES:
            samples.append((dict(below), p))
        if k < lm.ROUNDS:
            fresh = np.array([(total.s1 + total.d1 * below[u]) * p(w) for u, w in many])
            t |= dict(zip(many, lm.seat(np.array([cells[c] for c in many]), fresh, total.d1, np.random.default_rng((k, 1, 0))).tolist(), strict=True))
            if k >= lm.ROUNDS - lm.SAMPLES:
                seatings.append(dict(t))
    out = []
    for (doc, _), ps in zip(texts, pairs, strict=True):
        score = 0.0
        for u, w in ps:
            share = cells[u, w] - total.d1 * np.mean([x.get((u, w), 0) for x in seatings])
            score += math.log10((share + np.mean([(total.s1 + total.d1 * below.get(u, 0)) * p(w) for below, p in samples])) / (total.s1 + n[u]))
        out.append((doc, score))
    return out


def test_against_the_plain_version(spark):
    rng = random.Random(4)
    rows = [*ROWS, *((300 + k, prose(rng, rng.randint(1, 80))) for k in range(60))]
    found = rows_of(lm.score(frame(spark, rows).repartition(5)).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"))
    for a, b, c in zip(found, sorted(brute.base_language_model(rows)), sorted(plain(rows)), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], abs=1e-6)
        assert a[6] == pytest.approx(c[1], rel=1e-5, abs=1e-4)


def test_layouts_and_parts(spark):
    """The same scores from one partition and from many; with many parts, nearly the same model."""
    rng = random.Random(6)
    rows = [(k, prose(rng, rng.randint(20, 120))) for k in range(150)]
    one, many = (rows_of(lm.score(frame(spark, rows).repartition(n)).select("doc_id", "score")) for n in (1, 13))
    assert one == many
    few, split = (rows_of(lm.score(frame(spark, rows).repartition(n), part_tokens=300).select("doc_id", "n_known", "base_score", "score")) for n in (2, 7))
    assert few == split
    assert sum(r[3] for r in few) == pytest.approx(sum(r[1] for r in one), rel=0.01)


def test_probabilities_sum_to_one():
    """Over all known words and one unknown, what follows a context has probabilities that sum to one."""
    rng = np.random.default_rng(1)
    n = rng.integers(0, 20, (3, 40))
    t = np.minimum(n, 1 + rng.integers(0, 4, n.shape)) * (n > 0)
    above, below = t.sum(0), t.sum(1)
    seated = np.minimum(above, 1)
    totals = lm.Totals(known=40, customers=float(above.sum()), tables=float(seated.sum()), d1=0.7, d0=0.4, s1=1.5, s0=2.0)
    p = totals.parent(np.append(above, 0), np.append(seated, 0))
    assert (above > 0).all() and p.sum() == pytest.approx(1)
    for u in range(3):
        share = np.append(n[u] - 0.7 * t[u], 0.0)
        found = lm.predictive(share, np.full(41, u), np.arange(41), n.sum(1), np.array([below]), np.array([p]), 1.5, 0.7)
        assert found.sum() == pytest.approx(1)


def test_better_than_its_base_on_held_out_texts(spark):
    rng = random.Random(2)
    pairs = [("alpha", "one"), ("beta", "two"), ("gamma", "three")]
    rows = [(k, " ".join(x for _ in range(60) for x in rng.choice(pairs))) for k in range(120)]
    held = lm.score(frame(spark, rows)).where("held_out").agg(F.sum("base_score"), F.sum("score")).first()
    assert held[1] > 0.7 * held[0]  # the second word of a pair is certain


def test_no_training_text(spark):
    held = [d for d in range(200) if zlib.crc32(str(d).encode()) % 10 == 0][:3]
    found = rows_of(lm.score(frame(spark, [(d, "a b") for d in held])).select("n_known", "train_tokens", "held_out"))
    assert found == [(0, 0, True)] * 3
