"""The string kernel against a plain one, and what the machine learns from it."""

import itertools
import random

import numpy as np
import pytest

from quire.llm import toxicity

INSULTS = ("grumblewit", "snorfle", "dunderpate")


def plain_symbols(text):
    out, table = [0], toxicity._table()
    for c in text.lower():
        code = int(table[min(ord(c), 65535)])
        if code or out[-1]:
            out.append(code)
    return out + [0] * toxicity.SPAN


def plain_kernel(a, b):
    """Over all pairs of four-symbol subsequences within the span: of the symbols from a's start, and of the word b."""

    def held(code, starts, end):
        found = {}
        for p in range(starts):
            for gaps in itertools.combinations(range(1, toxicity.SPAN), 3):
                if p + gaps[2] < end:
                    key = (code[p], *(code[p + g] for g in gaps))
                    found[key] = found.get(key, 0) + toxicity.DECAY ** (gaps[2] - 3)
        return found

    x = held(plain_symbols(a), min(toxicity.STRETCH, len(plain_symbols(a)) - toxicity.SPAN + 1), len(plain_symbols(a)))
    word = [0, *(int(toxicity._table()[ord(c)]) for c in b), 0]
    y = held(word, len(word), len(word))
    return sum(v * y.get(u, 0) for u, v in x.items())


def prose(rng, n):
    return " ".join("".join(rng.choices(["an", "the", "ing", "re", "ou", "tion", "ble", "ha"], k=rng.randint(1, 3))) for _ in range(n))


def spoiled(rng, word):
    k = rng.randrange(2, len(word) - 2)
    return rng.choice([word[:k] + "x" + word[k:], word[:k] + "-" + word[k:], ".".join(word), word + "tion", word.upper()])


def corpus(n=400, seed=3):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        sentences, toxic = [prose(rng, rng.randint(4, 12)) for _ in range(rng.randint(2, 8))], k % 4 == 0
        if toxic:
            for s in rng.sample(range(len(sentences)), 2):
                word = rng.choice(INSULTS)
                sentences[s] = f"{prose(rng, 3)} {spoiled(rng, word) if rng.random() < 0.3 else word} {prose(rng, 2)}"
        rows.append((k, ". ".join(sentences) + ".", int(toxic)))
    return rows


def test_kernel_is_that_of_all_subsequences():
    rng = random.Random(1)
    words = [prose(rng, 1)[:9] or "an" for _ in range(20)] + list(INSULTS)
    landmarks = [toxicity.features(bytes(int(toxicity._table()[ord(c)]) for c in w)) for w in words]
    for text in ("Snor-fle the houble", "grumblewit", "ab", "É1 grumxblewit!"):
        code, word, _, _ = toxicity.symbols([text])
        k = toxicity.kernels(code, word[:1], landmarks)
        assert np.allclose(k[0], [plain_kernel(text, w) for w in words], rtol=1e-5)


def test_one_pass_gives_the_sum_over_landmarks():
    rows = corpus(120)
    model = toxicity.learn([t for _, t, _ in rows], [y for _, _, y in rows])
    texts = ["the snorfle hable", "", None, "!!!", rows[1][1], "a " * 50, "日本語 text"]
    alone = [toxicity.margins([t], model.table(), model.bias)[0] for t in texts]
    assert np.allclose(alone, toxicity.margins(texts, model.table(), model.bias))  # texts beside it don't matter
    assert alone[1] == alone[2] == alone[3] == pytest.approx(model.bias)
    assert alone[0] > 0 > alone[4]


def test_gaps_and_put_in_letters():
    rows = corpus()
    model = toxicity.learn([t for _, t, _ in rows], [y for _, _, y in rows])

    def margin(text):
        return toxicity.margins([text], model.table(), model.bias)[0]

    clean = max(margin(t) for _, t, y in corpus(200, 9) if not y)
    for text in ("grumxblewit", "g r u m b l e w i t", "g.r.u.m.b.l.e.w.i.t", "grumble-wit", "dunderrpate", "dunder pate", "snorfletion", "SNORFLE"):
        assert margin(f"the an {text} reing") > clean, text


SCHEMA = "doc_id long, text string, lang string, toxic int"


def test_held_out_accuracy_and_awkward_rows(spark):
    rows = corpus(600)
    more = [(None, "snorfle the", "en", 5), (900_001, None, None, 5), (900_002, "", None, 5), (0, rows[0][1], "en", 5), (900_003, "an ing " * 30_000 + "snorfle", "en", 5)]
    documents = spark.createDataFrame([(d, t, "en", 9) for d, t, _ in rows] + more, SCHEMA).repartition(3)  # a column called toxic isn't a label here
    labels = spark.createDataFrame([(d, 1, y) for d, _, y in rows] + [(5, 1, None), (None, 0, 1), (8, 0, 0)], "doc_id long, quality int, toxic int")
    found = toxicity.toxicity(documents, labels).collect()
    assert len(found) == len(rows) + len(more)
    truth = {d: y for d, _, y in rows}
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert len(held) > 100
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    by_id = {r.doc_id: r for r in found}
    assert not by_id[None].held_out and by_id[None].predicted == 1
    assert by_id[900_001].score == by_id[900_002].score and by_id[900_001].predicted == 0
    assert by_id[900_003].predicted == 1  # the last word of a long text
    assert len({r.score for r in found if r.doc_id == 0}) == 1


def test_labels_teach_by_fold_alone(spark):
    """Labels of the held-out fold change nothing."""
    import zlib

    rows = corpus(200)
    documents = spark.createDataFrame([(d, t) for d, t, _ in rows], "doc_id long, text string")

    def scores(turned):
        labels = [(d, 1 - y if turned and zlib.crc32(str(d).encode()) % 4 == 2 else y) for d, _, y in rows]
        return sorted(tuple(r) for r in toxicity.toxicity(documents, spark.createDataFrame(labels, "doc_id long, toxic int")).collect())

    assert scores(False) == scores(True)


def test_no_labels(spark):
    documents = spark.createDataFrame([(1, "an ing"), (2, None)], "doc_id long, text string")
    for labels in ([], [(1, 0)], [(1, None)]):
        found = toxicity.toxicity(documents, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
        assert [r.score for r in found] == [0.0, 0.0] and [r.predicted for r in found] == [0, 0]
    assert toxicity.toxicity(documents.limit(0), spark.createDataFrame([(1, 1)], "doc_id long, toxic int")).count() == 0
