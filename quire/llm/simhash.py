"""SimHash near-dedup with BK-trees.

``fingerprints``: texts lower-cased in A-Z, words (bytes other than x20 and
x09-x0D), shingles of ``shingle`` words with repeats, joined by a space (fewer
words: all of them; none: fingerprint zero); XXH64 with seed 42; a bit is set if
it is set in over half the hashes.

``links``: distinct fingerprints that differ in at most ``radius`` bits. They
agree in at least one of ``radius + 1`` bands, so each band value is a shard
with a BK-tree whose children are keyed by their distance to the parent; a
search follows only edges within the radius. Shards of more than ``SHARD``
fingerprints are parted by a band of the remaining bits as well, and any that
are still larger are cut into pieces, each searched with each other's tree. A
shard emits a spanning forest of its links, never all pairs.

``components`` joins the links by alternating large-star and small-star steps,
each written to the shared folder. Nodes are the smallest doc_id of a
fingerprint, so a component's root is its smallest doc_id.

``similar_documents`` links texts whose sets of five-word shingles have a Jaccard
similarity of 0.8 or more. The radius that this takes (about 30 of 128 bits) has
no bands that are worth a shard, so shards are values of sampled bits: pairs at
the threshold agree in all ``k`` bits of one of ``n`` samples with probability
``RECALL``, where ``k`` grows with the logarithm of the table and ``n`` follows
from it, so that a shard holds some ``BUCKET`` texts at every size. In a shard
the smallest text is compared first, then a BK-tree finds the pairs of different
components. Every candidate is held against the exact sets before it is a link.

Defined results: null and blank texts have fingerprint zero and link like any
other; equal rows are one node; a null doc_id is dropped; an empty table gives
an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import binary, parts, saved, shared_dir, slices, text_of, utf8
from ._vector import mix
from .resemblance import THRESHOLD, alike, fit, shingle_sets, sketches, verified

SHINGLE = 4
RADIUS = 4
SEED = 42
#: Fingerprints in one BK-tree.
SHARD = 2000
#: For similarity: the share of the pairs at the threshold that samples have to bring together, and texts in a shard, about.
RECALL = 0.995
BUCKET = 128


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    found = text.lower().split()
    if not found:
        return 0
    pieces = map(b" ".join, zip(*(found[k:] for k in range(shingle)), strict=False)) if len(found) > shingle else [b" ".join(found)]
    hashed = xxhash.xxh64_intdigest
    hashes = np.array([hashed(x, SEED) for x in pieces], "<u8")
    set_ = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 13):
        part = hashes[k : k + (1 << 13)]
        set_ += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * set_ > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint): the 64 bits as a signed long."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            buf, offsets = utf8(batch.column(1))
            raw = buf.tobytes()
            marks = [fingerprint(raw[a:b], shingle) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.record_batch([batch.column(0), pa.array(np.array(marks, np.uint64).view(np.int64))], ["doc_id", "fingerprint"])

    return text_of(documents, id_column, text_column).where("doc_id is not null").mapInArrow(task, "doc_id long, fingerprint long")


class BKTree:
    """Children of a node are keyed by their Hamming distance to it."""

    def __init__(self, values: list[int]):
        self.values = values
        self.children: list[dict[int, int]] = [{} for _ in values]
        for k in range(1, len(values)):
            at, x = 0, values[k]
            while True:
                d = (x ^ values[at]).bit_count()
                step = self.children[at].get(d)
                if step is None:
                    self.children[at][d] = k
                    break
                at = step

    def within(self, x: int, radius: int) -> list[int]:
        out, todo = [], [0] if self.values else []
        while todo:
            at = todo.pop()
            d = (x ^ self.values[at]).bit_count()
            if d <= radius:
                out.append(at)
            todo += [k for e, k in self.children[at].items() if d - radius <= e <= d + radius]
        return out

    def pairs(self, queries: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """Nodes with the indices of the queries (of one or more 64-bit words) within the radius; many queries go down the tree together."""
        queries = queries[:, None] if queries.ndim == 1 else queries
        shifts = [64 * k for k in range(queries.shape[1])]
        todo = [(0, np.arange(len(queries)))] if self.values else []
        while todo:
            at, who = todo.pop()
            own = np.array([self.values[at] >> k & (1 << 64) - 1 for k in shifts], np.uint64)
            d = np.bitwise_count(queries[who] ^ own).sum(1, dtype=np.int64)
            near = who[d <= radius]
            if len(near):
                yield at, near
            for e, k in self.children[at].items():
                go = who[np.abs(d - e) <= radius]
                if len(go):
                    todo.append((k, go))


def forest(tree: np.ndarray, queries: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """Index pairs that span the links among ``tree``, or between ``tree`` and ``queries`` (indexed after it)."""
    n = len(tree)
    root = list(range(n + (0 if queries is None else len(queries))))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out: list[tuple[int, int]] = []

    def link(i: int, j: int) -> None:
        a, b = find(i), find(j)
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((i, j))

    bk = BKTree(tree.tolist())
    if queries is None and n <= 64:
        for i, x in enumerate(bk.values):
            for j in bk.within(x, radius):
                link(i, j)
    else:
        base = 0 if queries is None else n
        for node, who in bk.pairs(tree if queries is None else queries, radius):
            for j in who.tolist():
                link(node, base + j)
    return out


def _shards(radius: int):
    """Rows of one shard arrive together: (shard, side, fingerprint, node)."""

    def flush(marks: list[int], sides: list[int], nodes: list[int]) -> list[tuple[int, int]]:
        marks_, sides_ = np.array(marks, np.int64).view(np.uint64), np.array(sides)
        if (sides_ == 0).all():
            return [(nodes[i], nodes[j]) for i, j in forest(marks_, None, radius)]
        one, two = np.flatnonzero(sides_ == 1), np.flatnonzero(sides_ == 2)
        order = np.concatenate([one, two]).tolist()
        return [(nodes[order[i]], nodes[order[j]]) for i, j in forest(marks_[one], marks_[two], radius)]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, marks, sides, nodes = None, [], [], []
        out: list[tuple[int, int]] = []
        for batch in batches:
            for k, side, mark, node in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != key:
                    if len(marks) > 1:
                        out += flush(marks, sides, nodes)
                    key, marks, sides, nodes = k, [], [], []
                marks.append(mark)
                sides.append(side)
                nodes.append(node)
            if out:
                yield pa.record_batch([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], ["a", "b"])
                out = []
        if len(marks) > 1:
            out += flush(marks, sides, nodes)
        if out:
            yield pa.record_batch([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], ["a", "b"])

    return task


def _bands(bits: list[int], radius: int) -> list[list[int]]:
    """The bits in radius + 1 bands of nearly equal size."""
    return [x.tolist() for x in np.array_split(np.array(bits), radius + 1)]


def _masked(mark: Column, bits: list[int]) -> Column:
    mask = sum(1 << b for b in bits)
    return mark.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))


def links(classes: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """(a, b): a spanning set of the links between the nodes of (fingerprint, node)."""
    spark = classes.sparkSession
    bands = _bands(list(range(64)), radius)
    mark = F.col("fingerprint")
    outer = classes.select("fingerprint", "node", F.explode(F.array(*(F.struct(F.lit(k).alias("band"), _masked(mark, bits).alias("value")) for k, bits in enumerate(bands)))).alias("b")).select("fingerprint", "node", "b.*", F.lit(-1).alias("inner"), F.lit(0).cast("long").alias("rest"))
    key = ["band", "value", "inner", "rest"]
    sizes = outer.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")
    outer = outer.join(sizes, key)
    fine = None
    for k, bits in enumerate(bands):
        others = _bands([b for b in range(64) if b not in bits], radius)
        part = outer.where(F.col("n") > shard).where(F.col("band") == k).select(
            "fingerprint", "node", "band", "value", F.explode(F.array(*(F.struct(F.lit(i).alias("inner"), _masked(mark, own).alias("rest")) for i, own in enumerate(others)))).alias("b")
        ).select("fingerprint", "node", "band", "value", "b.inner", "b.rest")
        fine = part if fine is None else fine.unionByName(part)
    fine = fine.join(fine.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1"), key)
    every = outer.where(F.col("n") <= shard).unionByName(fine)
    # Larger shards: pieces i <= j meet as tree and queries.
    pieces = F.ceil(F.col("n") / shard).cast("int")
    piece = F.pmod(F.xxhash64("fingerprint"), pieces.cast("long")).cast("int")
    i, j = F.least("own", "other"), F.greatest("own", "other")
    dealt = (
        every.withColumn("own", F.when(F.col("n") > shard, piece).otherwise(0))
        .withColumn("other", F.explode(F.when(F.col("n") > shard, F.sequence(F.lit(0), pieces - 1)).otherwise(F.array(F.lit(0)))))
        .select(F.xxhash64(*key, i, j).alias("shard"), F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("side"), "fingerprint", "node")
    )
    return dealt.repartition(parts(spark), "shard").sortWithinPartitions("shard").mapInArrow(_shards(radius), "a long, b long")


def components(edges: DataFrame, work: str) -> DataFrame:
    """(node, root): the smallest node that each node of an edge is connected with; nodes without edges are left out."""
    now = saved(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{work}/edges0")
    mark, step = None, 0
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = both.where("b > a").join(least, "a").select(F.col("low").alias("a"), "b").distinct()
        step += 1
        large = saved(large.where("a <> b"), f"{work}/edges{step}")
        low = large.groupBy("b").agg(F.min("a").alias("low"))
        small = large.join(low, "b").select(F.col("low").alias("x"), F.explode(F.array("a", "b")).alias("y")).where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        step += 1
        now = saved(small, f"{work}/edges{step}")
        seen = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if seen == mark:
            return now.select(F.col("b").alias("node"), F.col("a").alias("root"))
        mark = seen


def near_duplicates(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (long) and component_id: the smallest doc_id reachable over links, of every row."""
    spark = documents.sparkSession
    work = shared_dir(spark, "simhash")
    marks = saved(fingerprints(documents, id_column, text_column, shingle), f"{work}/fingerprints")
    classes = saved(marks.groupBy("fingerprint").agg(F.min("doc_id").alias("node")), f"{work}/classes")
    roots = components(links(classes, radius), work)
    named = classes.join(roots, "node", "left").select("fingerprint", F.coalesce("root", "node").alias("component_id"))
    return marks.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


# ---- similarity of shingle sets ----------------------------------------------

_SIDES = mix(np.arange(1, 3).astype(np.uint64))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, a hash and the size of the shingle set, and its fingerprint of 128 bits."""
    for batch in slices(batches):
        hashed, cut = shingle_sets(*utf8(batch.column(1)))
        total = np.append(np.uint64(0), np.cumsum(mix(hashed), dtype=np.uint64))
        size = np.diff(cut)
        some = np.flatnonzero(size)
        marks = []
        for side in _SIDES:
            mixed = mix(hashed ^ side)
            mark = np.zeros(len(size), np.uint64)
            for bit in range(64):
                ones = np.add.reduceat((mixed >> np.uint64(bit) & np.uint64(1)).astype(np.int32), cut[:-1][some]) if len(some) else np.zeros(0, np.int32)
                mark[some] |= (2 * ones > size[some]).astype(np.uint64) << np.uint64(bit)
            marks.append(pa.array(mark.view(np.int64)))
        yield pa.record_batch([batch.column(0), pa.array((total[cut[1:]] - total[cut[:-1]]).view(np.int64)), pa.array(size.astype(np.int64)), *marks, binary([x.tobytes() for x in sketches(hashed, cut)])], ["doc_id", "mark", "n", "f0", "f1", "sketch"])


def _plan(classes: int) -> tuple[int, int, int]:
    """Bits of a sample, the number of samples, and the radius, for a number of distinct texts."""
    j = THRESHOLD[0] / THRESHOLD[1]
    agree = 1 - math.acos(2 * j / (1 + j)) / math.pi
    bits = max(4, math.ceil(math.log2(max(1, classes) / BUCKET)))
    samples = math.ceil(math.log(1 - RECALL) / math.log(1 - agree**bits))
    return bits, samples, math.ceil(128 * (1 - agree) + 2.6 * math.sqrt(128 * agree * (1 - agree)))


def _samples(bits: int, samples: int) -> Column:
    """A key for each sample: its number and the sampled bits."""
    rng = np.random.default_rng(17)
    keys = []
    for k in range(samples):
        own = rng.permutation(128)[:bits].tolist()
        keys.append(F.xxhash64(F.lit(k), _masked(F.col("f0"), [b for b in own if b < 64]), _masked(F.col("f1"), [b - 64 for b in own if b >= 64])))
    return F.explode(F.array(*keys))


def _search(radius: int):
    """Candidates of each shard: (shard, tree, node, n, root, f0, f1, sketch), rows of one shard together; their sketches agree as well."""
    over, under = THRESHOLD

    def flush(rows: list[tuple]) -> tuple[list[int], list[int]]:
        node, n, root = (np.array([r[k] for r in rows], np.int64) for k in (2, 3, 4))
        marks = np.array([r[5:7] for r in rows], np.int64).view(np.uint64)
        held = np.frombuffer(b"".join(r[7] for r in rows), np.uint8).reshape(len(rows), -1)
        own = [k for k, r in enumerate(rows) if r[1]]
        tree = BKTree([int(marks[k, 0]) | int(marks[k, 1]) << 64 for k in own])
        a: list[int] = []
        b: list[int] = []
        for at, who in tree.pairs(marks, radius):
            k = own[at]
            who = who[root[who] != root[k]]
            who = who[under * np.minimum(n[who], n[k]) >= over * np.maximum(n[who], n[k])]
            who = who[alike(held[k], held[who])]
            a += np.minimum(node[who], node[k]).tolist()
            b += np.maximum(node[who], node[k]).tolist()
        return a, b

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            out: tuple[list[int], list[int]] = ([], [])
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if rows and row[0] != rows[0][0]:
                    for x, y in zip(out, flush(rows), strict=True):
                        x += y
                    rows = []
                rows.append(row)
            yield pa.record_batch([pa.array(x, pa.int64()) for x in out], ["a", "b"])
        if rows:
            yield pa.record_batch([pa.array(x, pa.int64()) for x in flush(rows)], ["a", "b"])

    return task


def similar_documents(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", shard: int = SHARD) -> DataFrame:
    """doc_id and component_id, the smallest doc_id reachable over links of similarity 0.8 or more, of every row."""
    spark = documents.sparkSession
    work = shared_dir(spark, "similar")
    docs = text_of(documents, id_column, text_column).where("doc_id is not null")
    rows = saved(docs.mapInArrow(_measure, "doc_id long, mark long, n long, f0 long, f1 long, sketch binary"), f"{work}/marks")
    classes = saved(rows.groupBy("mark").agg(F.min(F.struct("doc_id", "n", "f0", "f1", "sketch")).alias("x")).select("mark", F.col("x.doc_id").alias("node"), "x.n", "x.f0", "x.f1", "x.sketch"), f"{work}/classes")
    bits, samples, radius = _plan(classes.count())
    keys = classes.select(_samples(bits, samples).alias("key"), "node", "n", "f0", "f1")
    hubs = keys.groupBy("key").agg(F.min(F.struct("node", "n", "f0", "f1")).alias("hub"), F.count("*").alias("size")).where("size > 1").drop("size")
    met = keys.join(hubs, "key").where("node > hub.node").where(fit("n", "hub.n"))
    apart = F.bit_count(F.col("f0").bitwiseXOR(F.col("hub.f0"))) + F.bit_count(F.col("f1").bitwiseXOR(F.col("hub.f1")))
    pairs = saved(met.where(apart <= radius).select(F.col("hub.node").alias("a"), F.col("node").alias("b")).distinct(), f"{work}/pairs")

    def linked(pairs: DataFrame, name: str) -> DataFrame:
        named = saved(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), f"{work}/named_{name}")
        texts = saved(docs.join(named, "doc_id", "left_semi").dropDuplicates(["doc_id"]), f"{work}/texts_{name}")
        return saved(verified(pairs, texts), f"{work}/{name}")

    first = linked(pairs, "first")
    roots = components(first, f"{work}/components")
    # What is left: pairs of a shard in different components. The most common component of a shard is not in its tree.
    labelled = classes.join(roots, "node", "left").select("node", "n", "f0", "f1", F.coalesce("root", "node").alias("root"))
    keys = labelled.select(_samples(bits, samples).alias("key"), "node", "n", "f0", "f1", "root")
    kinds = keys.groupBy("key", "root").agg(F.count("*").alias("k")).groupBy("key").agg(F.max_by("root", F.struct("k", "root")).alias("common"), (F.sum("k") - F.max("k")).alias("others")).where("others > 0")
    mixed = keys.join(kinds, "key").withColumn("tree", F.col("root") != F.col("common"))
    # Trees of at most ``shard`` nodes, about; every node of the shard searches each of them.
    pieces = F.ceil(F.col("others") / shard).cast("int")
    dealt = mixed.withColumn("piece", F.explode(F.sequence(F.lit(0), pieces - 1))).withColumn("tree", F.col("tree") & (F.pmod(F.xxhash64("node"), pieces.cast("long")) == F.col("piece")))
    dealt = dealt.select(F.xxhash64("key", "piece").alias("shard"), "tree", "node", "n", "root", "f0", "f1").join(classes.select("node", "sketch"), "node").select("shard", "tree", "node", "n", "root", "f0", "f1", "sketch")
    found = dealt.repartition(parts(spark), "shard").sortWithinPartitions("shard").mapInArrow(_search(radius), "a long, b long")
    second = linked(saved(found.distinct(), f"{work}/more"), "second")
    roots = components(first.unionByName(second), f"{work}/all")
    named = classes.join(roots, "node", "left").select("mark", F.coalesce("root", "node").alias("component_id"))
    return rows.select("doc_id", "mark").join(named, "mark").select("doc_id", "component_id")
