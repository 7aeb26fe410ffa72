"""Conversation repair against exhaustive search, at any segment size and layout."""

import hashlib
import heapq
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from quire.llm import conversation_repair as C

SCHEMA = "conv_id long, turn long, role string, text string, lang string"
SHAPE = re.compile("(s?(ua)+)?")


def plain_damage(rows):
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        yield from [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)


def plain_repair(rows):
    """(faults, cost, audit, lines) of one conversation's rows in order, by a search that knows only the shape."""
    seen, faults = set(), []
    for role, text in rows:
        shown = text.strip(C.SPACE)
        faults.append("blank" if not shown else "again" if (role, text) in seen else "cut" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    queue, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, k, initials, lines = heapq.heappop(queue)
        if k == len(rows) and SHAPE.fullmatch(initials):
            return faults, cost, audit, lines
        state = (k, initials[-1:])
        if state in done:
            continue
        done.add(state)

        def go(more, letter, k, role, text):
            now = initials + (role[:1] if role is not None else "")
            if role is None or any(SHAPE.fullmatch(now + rest) for rest in ("", "a", "ua")):
                heapq.heappush(queue, (cost + more, audit + letter, k, now, lines if role is None else (*lines, f"{role}:{text}")))

        for role in ("user", "assistant"):
            go(3, "I", k, role, "")
        if k < len(rows):
            role, text = rows[k]
            go(4, "D", k + 1, None, None)
            if faults[k] not in ("blank", "again"):
                more = 3 if faults[k] == "cut" else 0
                if role[:1] in ("s", "u", "a"):
                    go(more, "K", k + 1, role, text)
                for name in ("user", "assistant"):
                    go(3 + more, "R", k + 1, name, text)


def plain(rows):
    by = defaultdict(list)
    for conv, turn, role, text in plain_damage(rows):
        by[conv].append((turn, role, text))
    out = []
    for conv in {r[0] for r in rows}:
        own = sorted(by[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
        faults, cost, audit, lines = plain_repair([r[1:] for r in own])
        turns = [t for t, _, _ in own if t is not None]
        pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(own)]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((conv, gaps, faults.count("blank"), faults.count("again"), faults.count("cut"), sum(p not in C.LEGAL for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def table(seed, convs, most):
    rng, rows = random.Random(seed), []
    for c in range(convs):
        roles = ["user", "assistant", "system", "user", "assistant", "tool", "super", "Admin"]
        for t in range(rng.randint(1, most)):
            role = ["user", "assistant"][t % 2] if rng.random() < 0.6 else rng.choice(roles)
            text = rng.choice(["Yes.", "No!", "Well", "Really? \n", " \t", "", "é.", f"line {t}.", f"open {t}", None])
            rows.append((c * 3, rng.choice([t, t, t, t + 2, None]), None if rng.random() < 0.03 else role, text))
    return rows


AWKWARD = [(None, 1, "user", "a."), (None, None, "assistant", "b."), (-5, None, None, None), (-5, None, "user", "x."), (-5, 7, "user", "x."), (-5, 7, "user", "x."), (-6, 2, "user", "q." + " " * 300), (-6, 3, "assistant", "long. " * 20_000)]


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frame(spark, rows, slices=3):
    return spark.createDataFrame([(*r, "en") for r in rows], SCHEMA).repartition(slices)


@pytest.mark.parametrize("segment", [1, 3, 4096])
def test_against_search(spark, monkeypatch, segment):
    """Segments of any size give the same; workers are forked anew, so the size travels in a closure."""
    rows = table(4, 40, 9) + AWKWARD
    cut, part_of = C._cut, C._segment

    def small(batches):
        C.SEGMENT = segment
        return cut(batches)

    monkeypatch.setattr(C, "_cut", small)
    assert C._segment is part_of
    assert found(C.repair(frame(spark, rows))) == plain(rows)


def test_long_conversation_over_tasks(spark):
    rows = table(8, 1, 1) + [(77, t, random.Random(t).choice(["user", "assistant", "assistant", "system"]), random.Random(t + 1).choice(["Fine.", f"So {t}.", f"So {t}", ""])) for t in range(1500)]
    assert found(C.repair(frame(spark, rows, 7))) == plain(rows)


def test_empty_and_all_dropped(spark):
    assert found(C.repair(frame(spark, AWKWARD).limit(0))) == []
    gone = next(t for t in range(200) if zlib.crc32(f"9:{t}".encode()) % 20 == 0)
    assert found(C.repair(frame(spark, [(9, gone, "user", "Hi.")]))) == [(9, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]


def test_repaired_rows_are_the_digest(spark):
    rows = table(5, 12, 8)
    data = frame(spark, rows)
    hurt = C.damaged(data)
    segments = C.solved(hurt, C.shared_dir(spark, "repair"))
    lines = defaultdict(list)
    order = ("conv_id", "last", "turn", "role", "digest")
    for r in C.repaired(hurt, segments).orderBy(*order).collect():
        lines[r.conv_id] += [f"{role}:" for role in filter(None, r.put.split(","))]
        if not r.last:
            lines[r.conv_id].append(f"{r.renamed or r.role}:{r.text}")
    for r in C.repair(data).collect():
        assert r.repaired_sha256 == hashlib.sha256("\n".join(lines[r.conv_id]).encode()).hexdigest()


def test_distances_are_shortest():
    rng = random.Random(2)
    for _ in range(200):
        rows = [(rng.choice(["s", "u", "a", ""]), rng.randrange(3), 0) for _ in range(rng.randint(0, 6))]
        m = C.between(rows)
        ahead = [min(m[4 * s + t] + C.GOAL[t] for t in range(4)) for s in range(4)]
        assert ahead == C.distances(rows, C.GOAL)[:4]
