"""Substring dedup: a count-min prefilter, then exact grouping of the windows it estimates repeated.

``repeated_passages`` marks, in every document, the words covered by a window of
``width`` words whose word sequence also starts in a document with a smaller
doc_id. Words are maximal runs of bytes other than x20 and x09-x0D.

1. Every partition counts its window blocks (``_repeats``) by key in a sketch of
   ``DEPTH`` rows whose counters stop at two: of a window it estimates how often
   its key occurs, which is never less than the window does. Merged sketches never
   count too little, so a window whose estimate is below two occurs once.
2. A second pass emits only blocks with an estimate of two or more. Equal blocks
   are grouped exactly; where blocks with one key differ, the windows of one copy
   of each are grouped exactly as well.

Hot passages are aggregated before the shuffle, and copies of a block never meet
in a task. The sketch has a fixed size: at most ``DEPTH * MAX_WIDTH`` bits are
broadcast; beyond that many keys it lets more through and loses nothing.

Defined results: null or blank texts have no words; documents shorter than a
window lose nothing; rows with an equal doc_id, like or unlike, are each judged
against smaller ids; a row with a null doc_id loses nothing and takes nothing
from others; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import binary, on_row, parts, rows_of, saved, shared_dir, slices, utf8
from ._repeats import blocks, merged
from ._vector import mix, separators, span_hash, words

WIDTH = 50
GRAM = 16
DEPTH = 2
MIN_WIDTH, MAX_WIDTH = 1 << 20, 1 << 27
#: Bytes of text for each block, roughly; only the sketch's size depends on it.
BYTES_PER_BLOCK = 140
SEGMENT = 1 << 16
_SPACE = separators("space")


class Sketch:
    """Count-min rows of two bit planes: counted once or more, counted twice or more."""

    def __init__(self, width: int):
        self.width = width
        self.once = np.zeros((DEPTH, width // 8), np.uint8)
        self.twice = np.zeros((DEPTH, width // 8), np.uint8)

    def cells(self, row: int, keys: np.ndarray) -> np.ndarray:
        return mix(keys + np.uint64(row * 0x632BE59BD9B4E019 & (1 << 64) - 1)) & np.uint64(self.width - 1)

    def add(self, keys: np.ndarray) -> None:
        for row in range(DEPTH):
            cell, count = np.unique(self.cells(row, keys), return_counts=True)
            byte, bit = (cell >> np.uint64(3)).astype(np.int64), np.left_shift(1, (cell & np.uint64(7)).astype(np.uint8)).astype(np.uint8)
            again = (count > 1) | ((self.once[row][byte] & bit) != 0)
            np.bitwise_or.at(self.twice[row], byte[again], bit[again])
            np.bitwise_or.at(self.once[row], byte, bit)

    def repeated(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for row in range(DEPTH):
            cell = self.cells(row, keys)
            out &= (self.twice[row][(cell >> np.uint64(3)).astype(np.int64)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out


def _blocks(batches, width: int, gram: int):
    for batch in slices(batches):
        buf, offsets = utf8(batch.column(1))
        starts, ends, first = words(buf, offsets, _SPACE)
        values = span_hash(buf, starts, ends)
        for found in blocks(values, first, width, gram):
            yield batch, values, found


def _sketch(width: int, gram: int, cells: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = Sketch(cells)
        for _, _, found in _blocks(batches, width, gram):
            sketch.add(found.key)
        yield from _segments(sketch, range(DEPTH * cells // 8 // SEGMENT))

    return task


def _segments(sketch: Sketch, which) -> Iterator[pa.RecordBatch]:
    once, twice = sketch.once.reshape(-1), sketch.twice.reshape(-1)
    for k in which:
        a, b = once[k * SEGMENT : (k + 1) * SEGMENT], twice[k * SEGMENT : (k + 1) * SEGMENT]
        if a.any():
            yield _segment(k, a, b)


def _segment(k: int, once: np.ndarray, twice: np.ndarray) -> pa.RecordBatch:
    both = zlib.compress(once.tobytes() + twice.tobytes(), 1)
    return pa.record_batch([pa.array([k], pa.int32()), binary([both])], ["segment", "planes"])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for k, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            both = np.frombuffer(zlib.decompress(raw.as_py()), np.uint8)
            once, twice = both[:SEGMENT], both[SEGMENT:]
            if k in held:
                mine = held[k]
                held[k] = (mine[0] | once, mine[1] | twice | (mine[0] & once))
            else:
                held[k] = (once, twice)
    for k, (_, twice) in held.items():
        yield pa.record_batch([pa.array([k], pa.int32()), binary([zlib.compress(twice.tobytes(), 1)])], ["segment", "planes"])


def merged_sketch(docs: DataFrame, width: int, gram: int) -> Sketch:
    """The sum of the partitions' sketches; its size is fixed by the input's bytes and MAX_WIDTH."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cells = MIN_WIDTH
    while cells < MAX_WIDTH and cells < 2 * total // BYTES_PER_BLOCK:
        cells *= 2
    rows = docs.mapInArrow(_sketch(width, gram, cells), "segment int, planes binary")
    merged_rows = rows.repartition(parts(docs.sparkSession), "segment").mapInArrow(_merge, "segment int, planes binary")
    sketch = Sketch(cells)
    twice = sketch.twice.reshape(-1)
    for k, raw in merged_rows.collect():  # the second plane only: at most DEPTH * MAX_WIDTH bits
        twice[k * SEGMENT : (k + 1) * SEGMENT] = np.frombuffer(zlib.decompress(raw), np.uint8)
    return sketch


def _candidates(width: int, gram: int, sketch):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Sketch.__new__(Sketch)
        known.width, known.twice = sketch.value
        for batch, values, found in _blocks(batches, width, gram):
            keep = np.flatnonzero(known.repeated(found.key))
            if not len(keep):
                continue
            start, size = found.start[keep], found.size[keep]
            own = np.repeat(start, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            hashes, ends = span_hash(values, own, own + width), np.cumsum(size)
            yield pa.record_batch(
                [
                    batch.column(0).take(pa.array(found.doc[keep])),
                    batch.column(2).take(pa.array(found.doc[keep])),
                    pa.array(found.at[keep], pa.int64()),
                    pa.array(size, pa.int64()),
                    pa.array(found.key[keep].view(np.int64)),
                    pa.array(found.content[keep].view(np.int64)),
                    pa.array([hashes[e - s : e].view(np.int64) for s, e in zip(size, ends, strict=True)], pa.list_(pa.int64())),
                ],
                ["doc_id", "row", "at", "size", "key", "content", "hashes"],
            )

    return task


def covered_ranges(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = WIDTH, work: str | None = None) -> DataFrame:
    """(doc_id, row, low, high): word ranges covered by windows that also start in a document with a smaller id."""
    spark = documents.sparkSession
    work = work or shared_dir(spark, "substring")
    docs = rows_of(documents, id_column, text_column)
    gram = min(GRAM, width)
    sketch = merged_sketch(docs, width, gram)
    held = spark.sparkContext.broadcast((sketch.width, sketch.twice))
    found = saved(
        docs.mapInArrow(_candidates(width, gram, held), "doc_id long, row long, at long, size long, key long, content long, hashes array<long>"),
        f"{work}/blocks",
    )
    # One copy of each block: the smallest document that has it.
    copies = saved(
        found.groupBy("key", "content").agg(F.min_by(F.struct("doc_id", "size", "hashes"), "doc_id").alias("one")).select("key", "content", F.col("one.doc_id").alias("first_doc"), F.col("one.size").alias("size"), F.col("one.hashes").alias("hashes")),
        f"{work}/copies",
    )
    # Written before it is joined: a join of two plain exchanges can be split at a hot key.
    differing = saved(copies.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), f"{work}/differing")
    single = copies.join(differing, "key").select("key", "content", "first_doc", F.posexplode("hashes").alias("step", "window"))
    single = saved(single, f"{work}/windows")
    earliest = single.groupBy("key", "window").agg(F.min("first_doc").alias("least"), F.max("first_doc").alias("most")).where("least < most").select("key", "window", "least")
    earliest = saved(earliest, f"{work}/earliest")
    partial = single.join(earliest, ["key", "window"]).where("least < first_doc").groupBy("key", "content").agg(F.sort_array(F.collect_list("step")).alias("steps"))
    # An earlier document has the whole block, or some windows of its first copy lie in earlier ones.
    verdict = copies.select("key", "content", "first_doc").join(partial, ["key", "content"], "left")
    judged = found.select("doc_id", "row", "at", "size", "key", "content").join(verdict, ["key", "content"])
    whole = judged.where("doc_id > first_doc").select("doc_id", "row", F.col("at").alias("low"), (F.col("at") + F.col("size") + F.lit(width - 1)).alias("high"))
    some = (
        judged.where("doc_id = first_doc and steps is not null")
        .select("doc_id", "row", "at", F.explode("steps").alias("step"))
        .select("doc_id", "row", (F.col("at") + F.col("step")).alias("low"), (F.col("at") + F.col("step") + F.lit(width)).alias("high"))
    )
    return whole.unionByName(some)


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        buf, offsets = utf8(batch.column(1))
        starts, ends, first = words(buf, offsets, _SPACE)
        raw = buf.tobytes()
        n, gone, text = [], [], []
        for d, ranges in enumerate(batch.column(2).to_pylist()):
            a, b = int(first[d]), int(first[d + 1])
            keep = np.ones(b - a, bool)
            if ranges:
                low, high = merged(np.array([r["low"] for r in ranges]), np.array([r["high"] for r in ranges]))
                for x, y in zip(low, high, strict=True):
                    keep[x:y] = False
            own = a + np.flatnonzero(keep)
            text.append(b" ".join([raw[s:e] for s, e in zip(starts[own].tolist(), ends[own].tolist(), strict=True)]).decode("utf-8", "replace"))
            n.append(b - a)
            gone.append(b - a - len(own))
        yield pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(text, pa.string())], ["doc_id", "n_words", "n_removed", "kept"])


def remove_repeated(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words, joined by one space, of every row."""
    ranges = covered_ranges(documents, id_column, text_column, width).groupBy("doc_id", "row").agg(F.collect_list(F.struct("low", "high")).alias("ranges"))
    return on_row(rows_of(documents, id_column, text_column), ranges).select("doc_id", "text", "ranges").mapInArrow(_kept, "doc_id long, n_words long, n_removed long, kept string")
