"""The prefix trie of conversations, by an LCP-aware external mergesort and a stack of open nodes.

A conversation is the sequence of its turns' digests. Conversations are dealt to
ranges of (sequence, conv_id); within a range every Arrow batch is a sorted run
that carries its longest common prefixes (LCPs, in turns), and a loser tree merges
the runs: heads are told apart by their LCP with the last output, and only where
those are alike by the turns behind it, so shared turns are not compared again.
The merged stream opens and closes nodes on a stack; a node that is closed is
finished. Nodes on the first and the last path of a range may go on in its
neighbours: they are handed on with what they have gathered, FAN ranges at a
time, to the same stack, until one task has handled all that is left of them.

A turn is told by the MD5 of its role and text. Nulls: a null turn comes first,
a null role or text is empty; rows of a null conv_id are left out, since such a
conversation has neither a head nor a number. Equal turns of a conversation are
ordered by their digest; repeated rows count each. Other columns are not read. A
range is held in memory, and a conversation is one value of 24 bytes for each turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from ._common import parts, saved, shared_dir

WIDTH = 16
#: Ranges whose edges are folded into one.
FAN = 256
NOTHING = hashlib.sha256().hexdigest()


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as (digest, code points)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    turn = F.struct(F.col("turn").isNotNull().alias("given"), F.col("turn").cast("long").alias("turn"), F.unhex(digest).alias("digest"), F.length(text).cast("long").alias("n"))
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    return rows.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list("t")), lambda t: F.struct(t["digest"].alias("digest"), t["n"].alias("n"))).alias("turns"))


def rebuilt(own: DataFrame) -> DataFrame:
    """(conv_id, turns): the first h turns come from conversation c - c % 100, h = crc32(c) % 6."""
    heads = own.where("conv_id % 100 = 0").select(F.col("conv_id").alias("head_id"), F.slice("turns", 1, 5).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % 6).cast("int")
    turns = F.concat(F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), h), F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0))))
    return own.join(heads, F.col("conv_id") - F.col("conv_id") % 100 == F.col("head_id"), "left").select("conv_id", turns.alias("turns"))


# ---- sorting ------------------------------------------------------------------------

Item = tuple[bytes, int, list[int]]
"""(digests, conv_id, code points of each turn)."""


def lcp(a: bytes, b: bytes, start: int = 0) -> int:
    """Common turns, of which the first ``start`` are known."""
    most = min(len(a), len(b)) // WIDTH
    while start < most and a[start * WIDTH : start * WIDTH + WIDTH] == b[start * WIDTH : start * WIDTH + WIDTH]:
        start += 1
    return start


def run_of(items: list[Item]) -> list[tuple[Item, int]]:
    """A sorted run; with each item its LCP with the one before it."""
    items.sort(key=lambda x: (x[0], x[1]))
    return [(x, lcp(items[k - 1][0], x[0]) if k else 0) for k, x in enumerate(items)]


class LcpLoserTree:
    """Merge of runs. All heads hold their LCP with the last output; a loser holds that with the one that beat it."""

    def __init__(self, runs: list[list[tuple[Item, int]]]):
        self.runs = [iter(r) for r in runs]
        self.heads: list[Item | None] = [None] * len(runs)
        self.common = [0] * len(runs)
        self.losers = [-1] * len(runs)
        self.compared = 0
        for k in range(len(runs)):
            self._advance(k)
            self.common[k] = 0 if self.heads[k] is not None else -1

    def _advance(self, k: int) -> None:
        self.heads[k], self.common[k] = next(self.runs[k], (None, -1))

    def _match(self, a: int, b: int) -> tuple[int, int]:
        """(winner, loser)."""
        if self.common[a] != self.common[b]:
            return (a, b) if self.common[a] > self.common[b] else (b, a)
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return (a, b) if y is None else (b, a)
        n = lcp(x[0], y[0], self.common[a])
        self.compared += n - self.common[a] + 1
        first, second = (a, b) if (x[0][n * WIDTH :], x[1], a) < (y[0][n * WIDTH :], y[1], b) else (b, a)
        self.common[second] = n
        return first, second

    def _build(self, node: int) -> int:
        k = len(self.runs)
        if node >= k:
            return node - k
        winner, self.losers[node] = self._match(self._build(2 * node), self._build(2 * node + 1))
        return winner

    def __iter__(self) -> Iterator[tuple[Item, int]]:
        """Items in order, each with its LCP with the one before it."""
        k = len(self.runs)
        winner = self._build(1) if k > 1 else 0
        while k and (head := self.heads[winner]) is not None:
            yield head, self.common[winner]
            self._advance(winner)
            node = (winner + k) // 2
            while node >= 1:
                winner, self.losers[node] = self._match(winner, self.losers[node])
                node //= 2


# ---- nodes ----------------------------------------------------------------------------

_LONG, _INT, _STRING, _BYTES = pa.int64(), pa.int32(), pa.string(), pa.binary()
_OWN = [("id", _BYTES), ("parent", _BYTES), ("depth", _INT), ("chars", _LONG), ("n_convs", _LONG), ("least", _LONG), ("n_children", _LONG), ("n_leaves", _LONG), ("saved", _LONG)]
#: kind: FINISHED, HANDED on as (group, entry), or a part of a handed node's ENDS.
_OUT = pa.schema([("kind", _INT), ("group", _INT), ("entry", _INT), *_OWN, ("parent_least", _LONG), ("ends", _STRING)])
FINISHED, HANDED, ENDS = range(3)


class Node:
    """What a node has gathered from what is finished below it."""

    __slots__ = ("id", "parent", "depth", "chars", "n_convs", "least", "n_children", "n_leaves", "saved", "ends", "first", "waiting")

    def __init__(self, id_: bytes, parent: bytes | None, depth: int, chars: int, first: bool = False):
        self.id, self.parent, self.depth, self.chars, self.first = id_, parent, depth, chars, first
        self.n_convs = self.n_children = self.n_leaves = self.saved = 0
        self.least: int | None = None
        self.ends: list[int] | None = None
        self.waiting: list[dict] = []  # finished children that lack this node's smallest member

    def add(self, n_convs: int, least: int | None, n_children: int, n_leaves: int, saved: int) -> None:
        self.n_convs, self.n_children, self.n_leaves, self.saved = self.n_convs + n_convs, self.n_children + n_children, self.n_leaves + n_leaves, self.saved + saved
        if least is not None and (self.least is None or least < self.least):
            self.least = least

    def row(self, kind: int, group: int = 0, entry: int = 0) -> dict:
        out = {c: getattr(self, c) for c, _ in _OWN}
        return out | {"kind": kind, "group": group, "entry": entry, "parent_least": None, "ends": None}


class OpenPath:
    """The stack. ``whole``: nothing lies outside, so every node can be finished here."""

    def __init__(self, group: int, whole: bool, hashed: bool):
        self.group, self.whole, self.hashed = group, whole, hashed
        self.stack: list[Node] = []
        self.left: list[Node] = []  # closed nodes of the first path
        self.out: list[dict] = []

    def push(self, node: Node) -> None:
        self.stack.append(node)

    def close(self, depth: int) -> None:
        """Close what lies deeper than ``depth``."""
        while len(self.stack) > depth + 1:
            node = self.stack.pop()
            if node.first:
                self.left.append(node)
            else:
                self._finish(node)

    def _finish(self, node: Node) -> None:
        node.n_leaves = node.n_leaves or 1
        node.saved += (node.n_convs - 1) * node.chars
        for child in node.waiting:
            child["parent_least"] = node.least
        self.out += node.waiting
        row = node.row(FINISHED)
        if self.hashed:
            row["ends"] = hashlib.sha256(",".join(map(str, node.ends or ())).encode()).hexdigest()
        if self.stack:
            top = self.stack[-1]
            top.add(node.n_convs, node.least, 1, node.n_leaves, node.saved)
            top.waiting.append(row)
        else:
            self.out.append(row)

    def end(self) -> None:
        if self.whole:
            self.close(-1)
            return
        trunk = [n for n in self.stack if n.first]
        first = trunk + self.left[::-1]
        for entry, path in enumerate((first, self.stack[len(trunk) :])):
            for node in path:
                self.out += node.waiting
                self.out.append(node.row(HANDED, self.group, entry))
                if node.ends:
                    self.out.append(node.row(ENDS, self.group) | {"ends": ",".join(map(str, node.ends))})

    def taken(self, least: int = 0) -> list[dict]:
        out = []
        if len(self.out) > least:
            out, self.out = self.out, []
        return out


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, _OUT)


ROOT = hashlib.md5(b"root").digest()


def nodes_of(merged: Iterator[tuple[Item, int]], path: OpenPath) -> Iterator[list[dict]]:
    for k, ((key, conv, chars), common) in enumerate(merged):
        if not k:
            path.push(Node(ROOT, None, 0, 0, True))
            common = 0
        path.close(common)
        for d in range(common, len(chars)):
            top = path.stack[-1]
            path.push(Node(hashlib.md5(top.id + key[d * WIDTH : d * WIDTH + WIDTH]).digest(), top.id, d + 1, chars[d], not k))
        top = path.stack[-1]
        top.add(1, conv, 0, 0, 0)
        top.ends = top.ends or []
        top.ends.append(conv)
        yield path.taken(2048)


def _sorted_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    runs = [run_of(list(zip(*(b.column(c).to_pylist() for c in ("key", "conv_id", "chars")), strict=True))) for b in batches if b.num_rows]
    if not runs:
        return
    path = OpenPath(TaskContext.get().partitionId(), False, True)
    for rows in nodes_of(iter(LcpLoserTree(runs)), path):
        if rows:
            yield _batch(rows)
    path.end()
    yield _batch(path.taken())


def _fold(whole: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same stack over the edges of neighbouring ranges, each a first path and what its last path has besides."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, at, first = None, None, True
        for batch in batches:
            for r in batch.to_pylist():
                if path is None or path.group != r["group"] // FAN:
                    if path is not None:
                        path.end()
                        yield _batch(path.taken())
                    path, at, first = OpenPath(r["group"] // FAN, whole, False), (r["group"], r["entry"]), True
                first = first and (r["group"], r["entry"]) == at
                depth = r["depth"]
                if depth >= len(path.stack) or path.stack[depth].id != r["id"]:
                    path.close(depth - 1)
                    path.push(Node(r["id"], r["parent"], depth, r["chars"], first and not whole))
                elif r["entry"] == 1:
                    path.close(depth)
                path.stack[depth].add(*(r[c] for c in ("n_convs", "least", "n_children", "n_leaves", "saved")))
                if rows := path.taken(2048):
                    yield _batch(rows)
        if path is not None:
            path.end()
            yield _batch(path.taken())

    return task


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's ends, which come in order, in parts."""
    schema, now, digest = pa.schema([("ends_id", _BYTES), ("sha", _STRING)]), None, hashlib.sha256()
    for batch in batches:
        out = []
        for id_, ends in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if id_ != now:
                if now is not None:
                    out.append({"ends_id": now, "sha": digest.hexdigest()})
                now, digest = id_, hashlib.sha256(ends.encode())
            else:
                digest.update(("," + ends).encode())
        yield pa.RecordBatch.from_pylist(out, schema)
    if now is not None:
        yield pa.RecordBatch.from_pylist([{"ends_id": now, "sha": digest.hexdigest()}], schema)


def trie(sequences: DataFrame) -> DataFrame:
    """A row for each node of (conv_id, turns): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = sequences.sparkSession
    path, schema = shared_dir(spark, "trie"), from_arrow_schema(_OUT)
    keyed = sequences.select("conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), "")).alias("key"), F.transform("turns", lambda t: t["n"]).alias("chars"))
    keyed = saved(keyed, f"{path}/keys")  # read twice: to choose the ranges and to deal
    ranges = parts(spark)
    table = saved(keyed.repartitionByRange(ranges, "key", "conv_id").mapInArrow(_sorted_range, schema), f"{path}/ranges")
    levels, handed, left, level = [table.where(f"kind = {FINISHED}")], table.where(f"kind = {HANDED}"), int(handed_groups(table)), 0
    while True:
        whole = left <= FAN
        order = ("group", "entry", "depth")
        dealt = handed.repartition(max(1, -(-left // FAN)), F.floor(F.col("group") / FAN)).sortWithinPartitions(*order)
        folded = saved(dealt.mapInArrow(_fold(whole), schema), f"{path}/level{level}")
        levels.append(folded.where(f"kind = {FINISHED}"))
        if whole:
            break
        handed, left, level = folded.where(f"kind = {HANDED}"), -(-left // FAN), level + 1
    ends = table.where(f"kind = {ENDS}").select("id", "ends", "group").repartition("id").sortWithinPartitions("id", "group").drop("group")
    shas = ends.mapInArrow(_streamed, "ends_id binary, sha string")
    late = levels[1]
    for more in levels[2:]:
        late = late.unionByName(more)
    late = saved(late.join(shas, F.col("id") == F.col("ends_id"), "left").withColumn("ends", F.coalesce("sha", F.lit(NOTHING))).drop("ends_id", "sha"), f"{path}/late")
    nodes = levels[0].unionByName(late)
    parents = late.select(F.col("id").alias("up"), F.col("least").alias("up_least"))
    named = nodes.where("parent_least is null").join(parents, F.col("parent") == F.col("up"), "left").withColumn("parent_least", F.col("up_least")).drop("up", "up_least")
    out = nodes.where("parent_least is not null").unionByName(named)
    return out.select(
        F.col("least").alias("conv_id"), F.col("depth").cast("long").alias("depth"), F.col("parent_least").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256")
    )


def handed_groups(table: DataFrame) -> int:
    """One more than the last range that hands nodes on."""
    return (table.where(f"kind = {HANDED}").agg(F.max("group")).first()[0] or 0) + 1


def conversation_trie(conversations: DataFrame) -> DataFrame:
    own = saved(sequences(conversations), f"{shared_dir(conversations.sparkSession, 'turns')}/own")
    return trie(rebuilt(own))
