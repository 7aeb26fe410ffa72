"""Toxicity by a subsequence string kernel: a support vector machine with Nyström landmarks on sentences.

A string's features are its subsequences of four symbols that stand within SPAN
symbols, each weighted by DECAY for every symbol left out; symbols are letters,
digits and one blank for whatever stands between. The kernel of two strings is
the product of their features, so an insult with a letter put in, a gap or an
ending of its own still shares most of them. Landmarks are words of the training
sentences; the machine is fitted in the space that they span (Nyström). What it
has learnt is a weight for each subsequence of a landmark, so a sentence is
scored in one pass over its symbols, with the same result as by its kernels with
all landmarks. A sentence counts as its most toxic stretch of STRETCH symbols from
the start of a word, a document as its most toxic sentence.

Labels are of documents, so sentences of toxic ones are first all taken as
toxic, then only those that the machine finds so, and the best of each document;
clean sentences stand for the stretches that come closest to toxic ones.
Folds by crc32(doc_id) % 4: 0 and 1 teach the machine (a sample of at most about
TOXIC and CLEAN documents of at most SAMPLE_CHARS characters; the only sample
here), 3 the probabilities (all its rows), 2 is held out.

Null texts are empty ones. An empty text, or one without a letter or digit, has
the machine's bias as its margin. A null doc_id isn't held out and has no label;
of labels that differ for one doc_id the larger counts, null ones don't; of unlike
texts with one doc_id the smallest teaches. Rows are
scored each by its own text, repeated ones too; other columns are not read. With
no labels of both kinds every score is the share of toxic labels, or 0.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import saved, shared_dir, slices, text_of

SPAN, DECAY = 6, 0.5
STRETCH = 12
LANDMARKS, LONGEST = 320, 24
TOXIC, CLEAN, SAMPLE_CHARS = 600, 900, 8000
ROUNDS, RIDGE = 3, 0.01
THRESHOLD = 0.3
#: Margins are counted in bins of this width for the probabilities.
BIN = 1 / 64

_GAPS = [(g, DECAY ** (g[2] - 3)) for g in itertools.combinations(range(1, SPAN), 3)]
_PAD = "\0" * SPAN
_SYMBOLS = 64


def _table() -> np.ndarray:
    out = np.zeros(1 << 16, np.uint8)
    for c in range(1 << 16):
        if chr(c).isalpha():
            out[c] = c - 96 if 97 <= c <= 122 else 28 + c % 36
        elif chr(c).isdigit():
            out[c] = 27
    return out


_CODES: list[np.ndarray] = []


def symbols(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all texts, apart by SPAN blanks; where a word starts (its blank); the sentence and the text that it belongs to."""
    if not _CODES:
        _CODES.append(_table())
    low = [(t or "").lower() for t in texts]
    whole = _PAD + _PAD.join(low) + _PAD
    points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.cumsum([SPAN, *(len(t) + SPAN for t in low)])[:-1]
    code = _CODES[0][np.minimum(points, (1 << 16) - 1)]
    ends = np.cumsum((points == 0) | (points == 10) | (points == 33) | (points == 46) | (points == 63), dtype=np.int32)
    blank = code == 0
    keep = ~blank | (points == 0)
    keep[1:] |= ~blank[:-1]
    code, place = code[keep], np.flatnonzero(keep)
    # Letters that stand alone in a row are one word: what is between them goes.
    blank = code == 0
    alone = np.zeros(len(code), bool)
    alone[1:-1] = blank[:-2] & ~blank[1:-1] & blank[2:]
    drop = np.zeros(len(code), bool)
    drop[1:-1] = blank[1:-1] & alone[:-2] & alone[2:]
    code, place = code[~drop], place[~drop]
    word = np.flatnonzero((code[:-1] == 0) & (code[1:] != 0))
    begin = place[word + 1]
    return code, word, ends[begin], np.searchsorted(starts, begin, "right") - 1


def _ids(code: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
    """For each place the subsequences that start there, and their weight."""
    n = max(0, len(code) - SPAN + 1)
    wide = code.astype(np.int32)
    for (i, j, k), weight in _GAPS:
        yield (((((wide[:n] << 6) | wide[i : i + n]) << 6) | wide[j : j + n]) << 6) | wide[k : k + n], weight


def features(word: bytes) -> Counter:
    """The weighted subsequences of one word's symbols between blanks."""
    code = np.frombuffer(b"\0" + word + b"\0" * SPAN, np.uint8)
    out: Counter = Counter()
    for (ids, weight), ((_, _, last), _) in zip(_ids(code), _GAPS, strict=True):
        for u in ids[: max(0, len(word) + 2 - last)].tolist():
            out[u] += weight
    return out


@dataclass
class Model:
    """The weight of each subsequence, the bias, and the probability's slope and intercept."""

    ids: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    intercept: float = 0.0

    def table(self) -> np.ndarray:
        out = np.zeros(_SYMBOLS**4, np.float32)
        out[self.ids] = self.weights
        return out


def stretches(code: np.ndarray, word: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Of each word the sum over what starts within STRETCH symbols from its blank."""
    total = np.zeros(len(code) + STRETCH + 1, np.float64)
    for ids, weight in _ids(code):
        total[1 : len(ids) + 1] += np.float32(weight) * table[ids]
    np.cumsum(total, out=total)
    return total[word + STRETCH] - total[word]


def margins(texts: list[str | None], table: np.ndarray, bias: float) -> np.ndarray:
    """Of each text the largest margin of its stretches, the bias where there is none."""
    code, word, _, owner = symbols(texts)
    out = np.full(len(texts), -np.inf)
    np.maximum.at(out, owner, stretches(code, word, table))
    return np.where(np.isinf(out), 0, out) + bias


# ---- learning -------------------------------------------------------------------


def spelled(code: np.ndarray, word: np.ndarray) -> list[bytes]:
    blanks, raw = np.flatnonzero(code == 0), code.tobytes()
    ends = blanks[np.searchsorted(blanks, word, "right")]
    return [raw[a + 1 : b] for a, b in zip(word.tolist(), ends.tolist(), strict=True)]


def told_apart(words: list[bytes], owner: np.ndarray, toxic: np.ndarray) -> dict[bytes, float]:
    """How far each word's share of the toxic documents lies above its share of the others, in deviations."""
    held: tuple[Counter, Counter] = (Counter(), Counter())
    for doc, group in itertools.groupby(zip(owner.tolist(), words, strict=True), key=lambda x: x[0]):
        held[int(toxic[doc])].update({w for _, w in group})
    n = [max(1, int((toxic == y).sum())) for y in (0, 1)]

    def apart(w: bytes) -> float:
        r = (held[1][w] + held[0][w] + 1) / (n[0] + n[1] + 2)
        return (held[1][w] / n[1] - held[0][w] / n[0]) / math.sqrt(r * (1 - r))

    return {w: apart(w) for w in held[0] | held[1]}


def choose_landmarks(apart: dict[bytes, float]) -> list[bytes]:
    """Half of them words that tell the labels apart best, half other words in the order of a hash."""
    every = sorted(w for w in apart if 3 <= len(w) <= LONGEST)
    told = sorted(every, key=lambda w: (-apart[w], w))[: LANDMARKS // 2]
    rest = sorted(set(every) - set(told), key=lambda w: (zlib.crc32(w), w))[: LANDMARKS - len(told)]
    return told + rest


def kernels(code: np.ndarray, word: np.ndarray, landmarks: list[Counter]) -> np.ndarray:
    """(words, landmarks): the kernel of each word's stretch with each landmark."""
    place = {u: k for k, u in enumerate(sorted(set().union(*landmarks)))}
    lut = np.full(_SYMBOLS**4, -1, np.int32)
    lut[list(place)] = list(place.values())
    held = sorted((place[u], m, w) for m, f in enumerate(landmarks) for u, w in f.items())
    of, which, value = (np.array(x) for x in zip(*held, strict=True))
    begin = np.searchsorted(of, np.arange(len(place) + 1))
    m, step = len(landmarks), 4096
    out = np.zeros((len(word), m), np.float32)
    ids = [(i, w) for i, w in _ids(np.r_[code, np.zeros(STRETCH + SPAN, np.uint8)])]
    for at in range(0, len(word), step):  # some words at a time, for memory
        places = word[at : at + step, None] + np.arange(STRETCH)
        for each, weight in ids:
            f = lut[each[places]]
            s, _ = np.nonzero(f >= 0)
            f = f[f >= 0]
            n = begin[f + 1] - begin[f]
            inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin[f], n)
            out[at : at + step] += np.bincount(np.repeat(s, n) * m + which[inner], weight * value[inner], len(places) * m).reshape(len(places), m).astype(np.float32)
    return out


def machine(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of least squared hinge loss, classes alike in weight, by Newton steps."""
    x = np.c_[x, np.ones(len(x), np.float32)]
    cost = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * 2000
    w, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], RIDGE)
    ridge[-1] = 1e-3
    active = np.ones(len(y), bool)
    for _ in range(20):
        z = x[active] * np.sqrt(cost[active])[:, None].astype(np.float32)
        h = (z.T @ z).astype(np.float64) + np.diag(ridge)
        w = np.linalg.solve(h, (x[active].T @ (cost[active] * y[active]).astype(np.float32)).astype(np.float64))
        now = y * (x @ w.astype(np.float32)) < 1
        if (now == active).all():
            break
        active = now
    return w[:-1], float(w[-1])


def best_of(group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The first place of the largest value of each group."""
    order = np.lexsort((np.arange(len(group)), -value, group))
    return order[np.r_[True, group[order][1:] != group[order][:-1]]]


def learn(texts: list[str], toxic: list[int]) -> Model | None:
    """The machine of these documents, or None where only one label is there."""
    y = np.array(toxic, np.int64)
    code, word, sentence, owner = symbols(texts)
    if not len(word) or len(set(y.tolist())) < 2:
        return None
    words = spelled(code, word)
    apart = told_apart(words, owner, y)
    landmarks = [f for f in map(features, choose_landmarks(apart)) if f]
    if not landmarks:
        return None
    every = np.array(sorted(set().union(*landmarks)), np.int32)
    held = np.zeros((len(landmarks), len(every)))
    for m, f in enumerate(landmarks):
        held[m, np.searchsorted(every, list(f))] = list(f.values())
    values, vectors = np.linalg.eigh(held @ held.T)
    good = values > 1e-6 * values[-1]
    root = vectors[:, good] / np.sqrt(values[good])
    score, table, bias, weights = np.array([apart[w] for w in words]), np.zeros(_SYMBOLS**4, np.float32), 0.0, np.zeros(0)
    label, clean = y[owner], np.zeros(0, np.int64)
    for k in range(ROUNDS):
        best = best_of(sentence, score)  # of every sentence the stretch that counts
        top = best_of(owner[best], score[best])
        taken = best[(label[best] == 1) & (score[best] > 0 if k else np.ones(len(best), bool))]
        taken = np.union1d(taken, best[top][label[best[top]] == 1])
        clean = np.union1d(clean, best[label[best] == 0])  # also those of the rounds before
        use = np.r_[taken, clean]
        x = kernels(code, word[use], landmarks) @ root.astype(np.float32)
        w, bias = machine(x, np.where(label[use] == 1, 1.0, -1.0))
        weights = ((root @ w) @ held).astype(np.float32)
        table[every] = weights
        score = stretches(code, word, table) + bias
    return Model(every, weights, bias)


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = sorted((r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)), key=lambda r: (r[0], r[1]))
    model = learn([r[1] for r in rows], [r[2] for r in rows])
    ids, weights = ([], []) if model is None else (model.ids.tolist(), model.weights.tolist())
    yield pa.record_batch([pa.array([-1, *ids], pa.int32()), pa.array([math.nan if model is None else model.bias, *weights], pa.float64())], ["id", "weight"])


def fold(id_column: str = "doc_id") -> Column:
    return F.crc32(F.col(id_column).cast("string")) % 4


def sample(documents: DataFrame, labels: DataFrame, path: str) -> DataFrame:
    """(doc_id, text, toxic): about TOXIC and CLEAN labelled documents of folds 0 and 1, in the order of a hash."""
    short = documents.where(F.length("text").between(1, SAMPLE_CHARS) & (fold() < 2)).select("doc_id")
    known = saved(labels.join(short, "doc_id", "left_semi"), f"{path}/known")
    n = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = F.lit(2.0**31) * F.when(F.col("toxic") == 1, TOXIC / max(n.get(1, 0), 1)).otherwise(CLEAN / max(n.get(0, 0), 1))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31)) < share)
    found = documents.where(F.length("text").between(1, SAMPLE_CHARS)).join(F.broadcast(chosen), "doc_id")  # bounded by TOXIC + CLEAN
    return found.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))


def _scorer(model: Model):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.table()
        for batch in slices(batches):
            yield pa.record_batch([batch.column(0), pa.array(margins(batch.column(1).to_pylist(), table, model.bias))], ["doc_id", "margin"])

    return task


def probability(bins: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Slope and intercept of a logistic curve through (margin, documents, toxic ones), with Platt's targets."""
    n1 = sum(t for _, _, t in bins)
    n0 = sum(n for _, n, _ in bins) - n1
    if not n0 or not n1:
        return 0.0, math.log((n1 + 1) / (n0 + 1))
    high, low = (n1 + 1) / (n1 + 2), 1 / (n0 + 2)
    x = np.array([[m, 1.0] for m, _, _ in bins])
    n = np.array([c for _, c, _ in bins], float)
    t = np.array([k * high + (c - k) * low for _, c, k in bins])
    w = np.array([1.0, math.log((n1 + 1) / (n0 + 1))])

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((n * np.logaddexp(0, z) - t * z).sum() + 0.5e-3 * w[0] ** 2)

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        g = x.T @ (n * p - t) + [1e-3 * w[0], 0]
        h = (x * (n * p * (1 - p))[:, None]).T @ x + np.diag([1e-3, 1e-9])
        step, rate = np.linalg.solve(h, g), 1.0
        while loss(w - rate * step) > loss(w) and rate > 1e-6:
            rate /= 2
        w = w - rate * step
        if np.abs(rate * step).max() < 1e-9:
            break
    return float(max(w[0], 0.0)), float(w[1])


def toxicity(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, margin, score, predicted) for every row of ``documents``."""
    spark = documents.sparkSession
    path, rows = shared_dir(spark, "toxicity"), text_of(documents)
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    taught = known.where(fold() != 2)
    chosen = sample(rows, taught, path).select("doc_id", "text", "toxic")
    learnt = [(r["id"], r["weight"]) for r in chosen.repartition(1).mapInArrow(_fit, "id int, weight double").collect()]
    bias = next((w for u, w in learnt if u < 0 and not math.isnan(w)), None)
    if bias is None:
        n = taught.agg(F.avg("toxic")).first()[0] or 0.0
        made = rows.select("doc_id", F.lit(None).cast("double").alias("margin")).withColumn("score", F.lit(float(n)))
    else:
        weights = sorted((u, w) for u, w in learnt if u >= 0)
        model = Model(np.array([u for u, _ in weights], np.int32), np.array([w for _, w in weights], np.float32), bias)
        scored = saved(rows.mapInArrow(_scorer(model), "doc_id long, margin double"), f"{path}/scored")
        held = scored.where(fold() == 3).join(taught.where(fold() == 3), "doc_id")
        bins = held.groupBy(F.round(F.greatest(F.least("margin", F.lit(16.0)), F.lit(-16.0)) / BIN).cast("int").alias("bin")).agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic"))
        slope, intercept = probability([(r["bin"] * BIN, r["n"], r["toxic"]) for r in bins.collect()])  # 2048 bins at most
        made = scored.withColumn("score", 1 / (1 + F.exp(-(F.lit(slope) * F.col("margin") + F.lit(intercept)))))
    return made.select("doc_id", F.coalesce(fold() == 2, F.lit(False)).alias("held_out"), "margin", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
