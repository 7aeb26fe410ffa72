"""Terms in texts against a loop over all pairs, with one shard and with many."""

import random

import pytest

from quire.operators import term_search as T


def plain(terms, texts):
    held = {(e, r) for e, r in terms if e and r}
    out = []
    for book in {b for b, t in texts if t is not None}:
        own = [t for b, t in texts if b == book and t is not None]
        out += [(book, e, r) for e, r in held if not any(e.lower() in t.lower() or r in t for t in own)]
    return sorted(out, key=repr)


def sample(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcдеA", k=rng.randint(1, 4)))
    terms = [(word(), word()) for _ in range(300)] + [("", "x"), (None, "x"), ("x", None), ("a", ""), ("İ", "ß"), ("ab", "ab"), ("ab", "ab"), ("a\nb", "c")]
    texts = [(rng.choice(["b1", "b2", "b3", None]), " ".join(word() for _ in range(rng.randint(0, 8)))) for _ in range(40)]
    return terms, texts + [("b4", None), ("b5", ""), ("b5", None), ("b6", "Ab " * 20_000)]


@pytest.mark.parametrize("shard,lanes", [(16_384, 4), (20, 64), (7, 3)])
def test_absent_terms(spark, monkeypatch, shard, lanes):
    monkeypatch.setattr(T, "SHARD", shard)
    terms, texts = sample(shard)
    found = T.absent_terms(spark.createDataFrame(terms, "english string, russian string"), spark.createDataFrame(texts, "book_id string, content string").repartition(3), lanes)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain(terms, texts)


def test_empty_sides(spark):
    none, texts = spark.createDataFrame([], "english string, russian string"), spark.createDataFrame([("b", "x")], "book_id string, content string")
    assert T.absent_terms(none, texts).count() == 0
    assert T.absent_terms(spark.createDataFrame([("y", "z")], "english string, russian string"), texts.limit(0)).count() == 0
    assert [tuple(r) for r in T.absent_terms(spark.createDataFrame([("y", "z")], "english string, russian string"), texts).collect()] == [("b", "y", "z")]
