"""Conversation structure repair by shortest paths over edits, found with Dial's bucket queue.

A conversation's rows, by turn (nulls first; equal turns by role, then by the MD5
of the text), are turned into one of the shape (system)? (user assistant)+, or
into nothing, by the cheapest edits. A graph has a node for each place between
rows and state of that shape; Keep, Rerole, Delete and Insert are arcs of cost 0
to 6. Dial's queue, run from the goal, records every node's distance; a walk from
the start takes, of the arcs that lie on shortest paths, the one whose letter
comes first: that is the audit, the ASCII-least of the cheapest.

Rows are dealt and sorted by ranges of (conversation, turn), so a conversation of
any size is spread: it is cut into segments, each summed up by its sixteen
distances between states; those chain, a small row for each segment, and every
segment is walked for itself. Texts take no part in this; they move once, for
the digest of the repaired conversation, which is one stream for each conversation.

Nulls: a null role or text is one blank; a null turn comes first and doesn't
count for gaps; rows of a null conv_id are a conversation. A role that doesn't
begin with s, u or a can't be kept. Equal rows count each: all but the first are
duplicates. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from ._common import parts, saved, shared_dir

KEEP, INSERT, REROLE, DELETE, TRUNCATED = 0, 3, 3, 4, 3
#: Rows of a segment at most.
SEGMENT = 4096
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"

# States: nothing yet, after the system row, after a user, after an assistant.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
#: What the state lets follow by role, and the only role that may be put in.
NEXT = {EMPTY: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
PUT = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Cost from each state to the end behind the last row.
GOAL = (0, 2 * INSERT, INSERT, 0)
LEGAL = ("su", "ua", "au")
#: A row's fault in the graph.
SOUND, CUT, LOST = range(3)


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n) after the damage that crc32 of conv_id:turn picks; n copies stand together."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), (F.crc32(key) % 20).alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    return rows.where("kind <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("n"))


def _digest(text: str = "text") -> Column:
    return F.unhex(F.md5(text))


def faulty(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, n, blank, again, cut): equal rows together; again if the role and text have been seen earlier."""
    shown = F.expr(f"trim(BOTH '{''.join(f'\\{ord(c):03o}' for c in SPACE)}' FROM text)")
    last = F.right(shown, F.lit(1))
    slim = rows.select("conv_id", "turn", "role", _digest().alias("digest"), "n", (shown == "").alias("blank"), ((shown != "") & ~last.isin(".", "!", "?")).alias("cut"))
    slim = slim.groupBy("conv_id", "turn", "role", "digest").agg(F.sum("n").alias("n"), F.first("blank").alias("blank"), F.first("cut").alias("cut"))
    seen = slim.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d")).agg(F.min(F.struct(F.col("turn").isNotNull().alias("given"), "turn")).alias("least"))
    both = slim.join(seen, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d")))
    return both.select("conv_id", "turn", "role", "digest", "n", "blank", (~F.col("turn").eqNullSafe(F.col("least.turn"))).alias("again"), "cut")


# ---- one segment's graph ------------------------------------------------------------

Row = tuple[str, int, int]
"""(initial, fault, further copies)."""


def _steps(initial: str, fault: int, state: int) -> list[tuple[str, int, int]]:
    """The arcs over a row: (letter, cost, next state) by letter."""
    out = [("D", DELETE, state)]
    if fault != LOST:
        more = TRUNCATED if fault == CUT else 0
        if initial in NEXT[state]:
            out.append(("K", KEEP + more, NEXT[state][initial]))
        out.append(("R", REROLE + more, PUT[state]))
    return out


def _back(initial: str, fault: int) -> list[list[tuple[int, int]]]:
    """For each state behind a row the states before it, with costs."""
    out: list[list[tuple[int, int]]] = [[], [], [], []]
    for state in range(4):
        for _, cost, to in _steps(initial, fault, state):
            out[to].append((state, cost))
    return out


_BACK = {(i, f): _back(i, f) for i in ("s", "u", "a", "") for f in (SOUND, CUT, LOST)}
_PUT_BACK = [[s for s in range(4) if PUT[s] == to] for to in range(4)]
_FAR = 1 << 60


def distances(rows: list[Row], ahead: tuple[int, ...]) -> list[int]:
    """Dial: the cost of every node (place * 4 + state) to the segment's end, where each state has still ``ahead`` to go."""
    n, low = len(rows), min(ahead)
    width = max(DELETE, REROLE + TRUNCATED, *(min(a - low, _FAR) for a in ahead if a < _FAR)) + 1
    out, buckets, left = [_FAR] * (4 * n + 4), [[] for _ in range(width)], 0
    for state, cost in enumerate(ahead):
        if cost < _FAR:
            buckets[cost - low].append((cost - low, 4 * n + state))
            out[4 * n + state] = cost - low
            left += 1
    now = 0
    while left:
        queue = buckets[now % width]
        while queue:
            d, node = queue.pop()
            left -= 1
            if d != out[node]:
                continue
            place, state = divmod(node, 4)
            near = [(node - state + s, INSERT) for s in _PUT_BACK[state]] if place < n else []
            if place:
                initial, fault, _ = rows[place - 1]
                near += [(4 * place - 4 + s, cost) for s, cost in _BACK[initial, fault][state]]
            for other, cost in near:
                if d + cost < out[other]:
                    out[other] = d + cost
                    buckets[(d + cost) % width].append((d + cost, other))
                    left += 1
        now += 1
    return [d + low if d < _FAR else _FAR for d in out]


def between(rows: list[Row]) -> list[int]:
    """Sixteen distances: from each state before the segment to each behind it."""
    cols = [distances(rows, tuple(0 if s == to else _FAR for s in range(4))) for to in range(4)]
    return [cols[to][state] for state in range(4) for to in range(4)]


def walk(rows: list[Row], ahead: tuple[int, ...], state: int, last: bool) -> tuple[str, int, list[tuple[int, str, str | None]], str]:
    """The audit from ``state`` on, the state behind it, what stays as (row, roles put in before it, new role or None), roles put in at the end."""
    d = distances(rows, ahead)
    audit, kept, put, place = [], [], [], 0
    while place < len(rows):
        initial, fault, more = rows[place]
        node = d[4 * place + state]
        arcs = [(letter, cost, 4 * place + 4 + to, to) for letter, cost, to in _steps(initial, fault, state)]
        arcs.insert(1, ("I", INSERT, 4 * place + PUT[state], PUT[state]))
        letter, _, _, to = next(a for a in arcs if a[1] + d[a[2]] == node)
        audit.append(letter)
        if letter == "I":
            put.append(NAMES[to])
        else:
            if letter != "D":
                kept.append((place, ",".join(put), NAMES[to] if letter == "R" else None))
                put = []
            audit.append("D" * more)
            place += 1
        state = to
    while last and GOAL[state]:
        state = PUT[state]
        audit.append("I")
        put.append(NAMES[state])
    return "".join(audit), state, kept, ",".join(put)


# ---- segments -------------------------------------------------------------------------

def _struct(**fields: pa.DataType) -> list[pa.Field]:
    return [pa.field(k, t) for k, t in fields.items()]


_LONG, _INT, _STRING, _YES = pa.int64(), pa.int32(), pa.string(), pa.bool_()
_PLACE = _struct(conv_id=_LONG, part=_INT, piece=_INT)
_ROW = pa.struct(_struct(turn=_LONG, role=_STRING, digest=pa.binary(), initial=_STRING, fault=_INT, more=_LONG))
_EDIT = pa.struct(_struct(turn=_LONG, role=_STRING, digest=pa.binary(), put=_STRING, renamed=_STRING))
_SUM = _struct(fixed=_LONG, illegal=_LONG, first=_STRING, last=_STRING, low=_LONG, high=_LONG, turns=_LONG, n_blank=_LONG, n_again=_LONG, n_cut=_LONG)
_SOLVED = [*_PLACE, *_SUM, *_struct(cost=_LONG, audit=_STRING, put=_STRING, edits=pa.list_(_EDIT))]
_SEGMENT = pa.schema([*_SOLVED, *_struct(whole=_YES, rows=pa.list_(_ROW), between=pa.list_(_LONG))])
_AHEAD = pa.schema([*_PLACE, *_struct(ahead=pa.list_(_LONG), begins=_YES, ends=_YES, total=_LONG)])
_WALKED = pa.schema([*_PLACE, *_struct(begins=_YES, total=_LONG, exits=pa.list_(_INT), audits=pa.list_(_STRING), puts=pa.list_(_STRING), edits=pa.list_(pa.list_(_EDIT)))])
_ENTERED = pa.schema(_struct(part=_INT, piece=_INT, state=_INT))
_HASHED = pa.schema(_struct(conv_id=_LONG, repaired_sha256=_STRING))


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int = 256) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _edits(held: list[dict], kept: list[tuple[int, str, str | None]]) -> list[dict]:
    return [{**{c: held[k][c] for c in ("turn", "role", "digest")}, "put": put, "renamed": name} for k, put, name in kept]


def _segment(held: list[dict], part: int, piece: int, whole: bool) -> dict:
    turns = [r["turn"] for r in held if r["turn"] is not None]
    graph = [(r["initial"], r["fault"], r["more"]) for r in held]
    initials = [i for i, _, _ in graph]
    out = {
        "conv_id": held[0]["conv_id"], "part": part, "piece": piece, "whole": whole,
        "fixed": DELETE * sum(r["more"] for r in held),
        "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])) + sum(r["more"] for r in held),
        "first": initials[0], "last": initials[-1],
        "low": turns[0] if turns else None, "high": turns[-1] if turns else None, "turns": len(set(turns)),
        "n_blank": sum(r["n"] for r in held if r["blank"]), "n_again": sum(r["n"] - (not r["again"]) for r in held if not r["blank"]), "n_cut": sum(r["fault"] == CUT for r in held),
        "cost": None, "audit": None, "put": None, "edits": None, "rows": None, "between": None,
    }
    if whole:
        audit, _, kept, put = walk(graph, GOAL, EMPTY, True)
        out |= {"cost": distances(graph, GOAL)[EMPTY], "audit": audit, "put": put, "edits": _edits(held, kept)}
    else:
        out |= {"rows": [{c: r[c] for c in ("turn", "role", "digest", "initial", "fault", "more")} for r in held], "between": between(graph)}
    return out


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of sorted rows. A conversation that begins and ends within the task is done here."""
    part = TaskContext.get().partitionId()

    def made() -> Iterator[dict]:
        held: list[dict] = []
        piece, inner = 0, False  # inner: the segment begins its conversation for certain
        for r in _rows(batches):
            r["more"], r["initial"] = r["n"] - 1, r["role"][:1] if r["role"][:1] in ("s", "u", "a") else ""
            r["fault"] = LOST if r["blank"] or r["again"] else CUT if r["cut"] else SOUND
            if held and (r["conv_id"] != held[0]["conv_id"] or len(held) == SEGMENT):
                ends = r["conv_id"] != held[0]["conv_id"]
                yield _segment(held, part, piece, inner and ends)
                held, piece, inner = [], piece + 1, ends
            held.append(r)
        if held:
            yield _segment(held, part, piece, False)

    return _batches(made(), _SEGMENT)


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The segments' sums of one conversation at a time, in order."""
    held: list[dict] = []
    for r in _rows(batches):
        if held and r["conv_id"] != held[0]["conv_id"]:
            yield held
            held = []
        held.append(r)
    if held:
        yield held


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each state still costs behind each segment."""

    def made() -> Iterator[dict]:
        for held in _conversations(batches):
            ahead = list(GOAL)
            for k in reversed(range(len(held))):
                r, m = held[k], held[k]["between"]
                now = [min(m[4 * s + t] + ahead[t] for t in range(4)) for s in range(4)]
                yield {**{c: r[c] for c in ("conv_id", "part", "piece")}, "ahead": ahead, "begins": k == 0, "ends": k == len(held) - 1, "total": now[EMPTY] if k == 0 else None}
                ahead = now

    return _batches(made(), _AHEAD)


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each segment walked from every state that it may be entered in."""

    def made() -> Iterator[dict]:
        for r in _rows(batches):
            graph = [(x["initial"], x["fault"], x["more"]) for x in r["rows"]]
            found = [walk(graph, tuple(r["ahead"]), s, r["ends"]) for s in ([EMPTY] if r["begins"] else range(4))]
            yield {**{c: r[c] for c in ("conv_id", "part", "piece", "begins", "total")}, "exits": [x[1] for x in found], "audits": [x[0] for x in found], "puts": [x[3] for x in found], "edits": [_edits(r["rows"], x[2]) for x in found]}

    return _batches(made(), _WALKED, 16)


def _entered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state in which each segment is entered."""

    def made() -> Iterator[dict]:
        for held in _conversations(batches):
            state = EMPTY
            for r in held:
                yield {**{c: r[c] for c in ("part", "piece")}, "state": state}
                state = r["exits"][state]

    return _batches(made(), _ENTERED)


def _by_conversation(df: DataFrame) -> DataFrame:
    return df.repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece")


def solved(rows: DataFrame, path: str) -> DataFrame:
    """Segments (conv_id, part, piece, sums, cost, audit, put, edits) of ``rows``, written below ``path``; each conversation's cost stands in its first."""
    order = ("conv_id", "turn", "role", "digest")
    dealt = faulty(rows).repartitionByRange(parts(rows.sparkSession), *order).sortWithinPartitions(*order)
    segments = saved(dealt.mapInArrow(_cut, from_arrow_schema(_SEGMENT)), f"{path}/segments")
    names = [f.name for f in _SOLVED]
    whole = segments.where("whole").select(names)
    open_ = segments.where("not whole")
    ahead = _by_conversation(open_.select("conv_id", "part", "piece", "between")).mapInArrow(_chain, from_arrow_schema(_AHEAD)).withColumnRenamed("conv_id", "own")
    walked = saved(open_.drop("cost", "audit", "put", "edits").join(ahead, ["part", "piece"]).mapInArrow(_walked, from_arrow_schema(_WALKED)), f"{path}/walked")
    entered = _by_conversation(walked.select("conv_id", "part", "piece", "exits")).mapInArrow(_entered, from_arrow_schema(_ENTERED))
    each = lambda c: F.get(c, F.col("state")).alias(c[:-1] if c != "edits" else c)
    taken = walked.join(entered, ["part", "piece"]).select("part", "piece", F.col("total").alias("cost"), each("audits"), each("puts"), each("edits"))
    return saved(whole.unionByName(open_.drop("cost", "audit", "put", "edits").join(taken, ["part", "piece"]).select(names)), f"{path}/solved")


def report(segments: DataFrame) -> DataFrame:
    """A row for each conversation that has rows: gaps, blank, duplicate, truncated, illegal, cost, audit."""
    of = F.struct("part", "piece", "audit", "first", "last", "low", "high")
    g = segments.groupBy("conv_id").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("turns").alias("turns"), F.sum("n_blank").alias("blank"), F.sum("n_again").alias("duplicate"), F.sum("n_cut").alias("truncated"),
        F.sum("illegal").alias("inside"), (F.sum("cost") + F.sum("fixed")).alias("cost"), F.array_sort(F.collect_list(of)).alias("s"),
    )
    seams = F.arrays_zip(F.slice("s", 1, F.size("s") - 1).alias("a"), F.slice("s", 2, F.size("s")).alias("b"))
    illegal = F.size(F.filter(seams, lambda x: ~F.concat(x["a"]["last"], x["b"]["first"]).isin(*LEGAL)))
    shared = F.size(F.filter(seams, lambda x: x["a"]["high"] == x["b"]["low"]))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - (F.col("turns") - shared), F.lit(0))
    return g.select("conv_id", gaps.cast("long").alias("gaps"), "blank", "duplicate", "truncated", (F.col("inside") + illegal).cast("long").alias("illegal"), "cost", F.array_join(F.transform("s", lambda x: x["audit"]), "").alias("audit"))


def _edit_rows(segments: DataFrame) -> DataFrame:
    """(conv_id, last, turn, role, digest, put, renamed): what stays, with what is put in before it; at the end what is put in last."""
    kept = segments.select("conv_id", F.lit(0).alias("last"), F.inline("edits"))
    end = segments.where("put <> ''").selectExpr("conv_id", "1 AS last", "CAST(NULL AS LONG) AS turn", "CAST(NULL AS STRING) AS role", "CAST(NULL AS BINARY) AS digest", "put", "CAST(NULL AS STRING) AS renamed")
    return kept.unionByName(end)


def repaired(rows: DataFrame, segments: DataFrame) -> DataFrame:
    """(conv_id, last, turn, role, digest, put, renamed, text): the rows that stay, with their texts, in the order of these columns.

    ``put``: roles of rows without text that come before it; ``last``: 1 for those at the end.
    """
    texts = rows.select("conv_id", "turn", "role", _digest().alias("digest"), "text").dropDuplicates(["conv_id", "turn", "role", "digest"]).withColumnsRenamed({c: f"_{c}" for c in ("conv_id", "turn", "role", "digest")})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("conv_id", "turn", "role", "digest")]
    return _edit_rows(segments).join(texts, same[0] & same[1] & same[2] & same[3], "left").select("conv_id", "last", "turn", "role", "digest", "put", "renamed", "text")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits and texts of a conversation come in one order, a text right behind its edit: the digest is taken as they pass."""

    def made() -> Iterator[dict]:
        now, some, edit, digest, any_line = None, False, None, hashlib.sha256(), False

        def line(text: str) -> None:
            nonlocal any_line
            digest.update((("\n" if any_line else "") + text).encode())
            any_line = True

        for r in _rows(batches):
            if not some or r["conv_id"] != now:
                if some:
                    yield {"conv_id": now, "repaired_sha256": digest.hexdigest()}
                now, some, edit, digest, any_line = r["conv_id"], True, None, hashlib.sha256(), False
            if r["text"] is None:
                edit = r
                for role in filter(None, r["put"].split(",")):
                    line(f"{role}:")
            elif edit is not None and (edit["turn"], edit["role"], edit["digest"]) == (r["turn"], r["role"], r["digest"]):
                line(f"{edit['renamed'] or r['role']}:{r['text']}")
                edit = None
        if some:
            yield {"conv_id": now, "repaired_sha256": digest.hexdigest()}

    return _batches(made(), _HASHED)


def digests(rows: DataFrame, segments: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): SHA-256 of the repaired conversation's role:text lines."""
    texts = rows.select("conv_id", F.lit(0).alias("last"), "turn", "role", _digest().alias("digest"), F.lit(None).cast("string").alias("put"), F.lit(None).cast("string").alias("renamed"), "text")
    both = _edit_rows(segments).withColumn("text", F.lit(None).cast("string")).unionByName(texts)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "last", "turn", "role", "digest", F.col("text").isNotNull()).mapInArrow(_hashed, from_arrow_schema(_HASHED))


def repair(conversations: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """A row for every conv_id of ``conversations``: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``rows`` (conv_id, turn, role, text, n) are what is left of them, by default after ``damaged``.
    """
    rows = damaged(conversations) if rows is None else rows
    segments = solved(rows, shared_dir(conversations.sparkSession, "repair"))
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    found = report(segments).withColumnRenamed("conv_id", "_c")
    hashed = digests(rows, segments).withColumnRenamed("conv_id", "_d")
    out = every.join(found, every["conv_id"].eqNullSafe(found["_c"]), "left").join(hashed, every["conv_id"].eqNullSafe(hashed["_d"]), "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select("conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
