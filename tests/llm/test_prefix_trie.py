"""The trie against one of plain dictionaries, over any number of ranges and levels."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from quire.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string, lang string"


def plain(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn, role or "", text or ""))
    for turns in own.values():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, hashlib.md5(f"{len(t[1])}:{t[1]}{t[2]}".encode()).digest()))
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h, rest = zlib.crc32(str(c).encode()) % 6, abs(c) % 100
        head = own.get(c - rest if c >= 0 else c + rest, [])
        path = tuple(t[1:] for t in head[:h] + turns[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)

    def below(p):
        leaves, spared = (0 if children[p] else 1), (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
        for q in children[p]:
            more = below(q)
            leaves, spared = leaves + more[0], spared + more[1]
        return leaves, spared

    return sorted(
        ((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), *below(p), hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items()),
        key=repr,
    )


def table(seed, convs=150, most=7):
    rng, rows = random.Random(seed), []
    for c in range(convs):
        conv = rng.choice([c, c, c + 100, c * 7])
        for t in range(rng.randint(1, most)):
            rows.append((conv, rng.choice([t, t, None]) if c % 11 == 0 else t, rng.choice(["user", "assistant", None, ""]), rng.choice(["", None, "aé日", "b", "a longer text"])))
    return rows


def copies(n):
    """One conversation many times, as every member of its hundred, besides unlike ones."""
    same = [("user", "Hi"), ("assistant", "Hello there"), ("user", "日本"), ("assistant", "x" * 40)]
    return [(c, t, *turn) for c in range(n) for t, turn in enumerate(same)] + [(c, t, "user", f"{c} {t}") for c in range(n, n + 30) for t in range(3)]


AWKWARD = [(None, 1, "user", "a"), (-5, None, None, None), (-5, 1, "user", "x"), (-5, 1, "user", "x"), (-105, 1, "user", "x"), (1207, 1, "user", "alone, its head is absent"), (100_000, 0, "user", "y" * 50_000)] + [(3100, t, "user", str(t)) for t in range(150)] + [(3199, t, "user", str(t)) for t in range(150)]


def found(df):
    order = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in df.select(order).collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "en") for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("rows", [table(1), table(2, 40, 3), copies(170), AWKWARD, table(3) + AWKWARD], ids=["mixed", "small", "copies", "awkward", "all"])
def test_against_dictionaries(spark, rows):
    assert found(P.conversation_trie(frame(spark, rows))) == plain(rows)


@pytest.mark.parametrize("ranges,fan", [(1, 256), (13, 256), (13, 2), (9, 3)])
def test_ranges_and_levels(spark, monkeypatch, ranges, fan):
    """Edges are folded in several levels when FAN is small."""
    rows, fold = copies(90) + [(c + 1000, *r) for c, *r in table(5, 60)], P._fold
    monkeypatch.setattr(P, "parts", lambda spark: ranges)
    monkeypatch.setattr(P, "FAN", fan)

    def small(whole):
        task = fold(whole)

        def run(batches):
            P.FAN = fan
            yield from task(batches)
            P.FAN = 256

        return run

    monkeypatch.setattr(P, "_fold", small)
    assert found(P.conversation_trie(frame(spark, rows))) == plain(rows)


def test_empty(spark):
    assert found(P.conversation_trie(frame(spark, AWKWARD).limit(0))) == []
    assert found(P.conversation_trie(frame(spark, AWKWARD[:1]))) == []


def test_merge_compares_no_shared_turn_twice():
    rng = random.Random(4)
    key = lambda n: b"".join(bytes([rng.randrange(2)]) * P.WIDTH for _ in range(n))
    shared = bytes(P.WIDTH * 500)
    items = [(shared + key(rng.randrange(6)), c, []) for c in range(400)]
    runs = [P.run_of([x for x in items if x[1] % 8 == k]) for k in range(8)]
    tree = P.LcpLoserTree(runs)
    out = list(tree)
    assert [x for x, _ in out] == sorted(items, key=lambda x: x[:2])
    assert all(n == P.lcp(a[0], b[0]) for (a, _), (b, n) in zip(out, out[1:]))
    assert tree.compared < 8 * 500 + 400 * 3 * 8  # not 500 for each comparison
