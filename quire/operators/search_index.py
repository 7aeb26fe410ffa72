"""Substring search in many texts through a positional index of trigrams.

Every place of a text but its last two begins a trigram. Texts are packed into segments of about SEGMENT characters; a segment's
posting list for a trigram holds its places as differences in variable-length
bytes. A search string is found where the lists of trigrams that cover it, moved
by their offsets, meet: that is exact, so texts are not read again. For strings of
one or two characters there are lists of a segment's texts, without places. A batch of strings is answered
together: by joins on trigrams, then for each string in the segments with all of them
by intersection from the shortest list on, in the task
that the segment's lists go to.

The search ignores case and white space around a string; an empty string is found
everywhere. A null title or text is empty. Segments are bounded but for a single
text that is longer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.text import py_strip

SEGMENT = 1 << 19
#: Stands between texts; no character has this number.
END = (1 << 21) - 1
POSTINGS = "segment long, gram long, n int, places binary"
TEXTS = "segment long, starts array<int>, ids array<long>"


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seven bits a byte, low ones first, the high bit set on all but the last; the bytes, and how many each value takes."""
    size = np.ones(len(values), np.int64)
    for bits in (7, 14, 21, 28):
        size += values >= 1 << bits
    out = np.zeros(int(size.sum()), np.uint8)
    at = np.cumsum(size) - size
    for k in range(5):
        more = size > k
        out[at[more] + k] = ((values[more] >> (7 * k)) & 127) | np.where(size[more] > k + 1, 128, 0)
    return out, size


def unpack(raw: bytes) -> np.ndarray:
    data = np.frombuffer(raw, np.uint8)
    last = np.flatnonzero(data < 128)
    first = np.r_[0, last[:-1] + 1]
    place = np.arange(len(data)) - np.repeat(first, last - first + 1)
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * place), first)


def short_gram(*points: int) -> int:
    """The key of one or two characters; those of trigrams are not negative."""
    return -1 - points[0] if len(points) == 1 else -(1 << 22) - (points[0] << 21 | points[1])


def grams(points: np.ndarray) -> np.ndarray:
    wide = points.astype(np.int64)
    return (wide[:-2] << 42) | (wide[1:-1] << 21) | wide[2:]


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) to posting rows, and a row without trigram for a segment's texts."""
    held: list[tuple[int, np.ndarray]] = []
    size, number, base = 0, 0, TaskContext.get().partitionId() << 32

    def segment() -> pa.RecordBatch:
        mark = np.full(2, END, np.uint32)
        points = np.concatenate([x for _, p in held for x in (p, mark)])
        starts = np.cumsum([0, *(len(p) + 2 for _, p in held)])[:-1]
        owner = np.repeat(np.arange(len(held)), np.diff(np.r_[starts, len(points)]))
        real, wide = points != END, points.astype(np.int64)
        keys, values = [], []
        # A text has a character at least, so a segment's texts are numbered in 20 bits.
        for pair, ok, key in ((wide, real, lambda x: -1 - x), (wide[:-1] << 21 | wide[1:], real[:-1] & real[1:], lambda x: -(1 << 22) - x)):
            own = np.unique(pair[ok] << 20 | owner[: len(ok)][ok])
            keys.append(key(own >> 20))
            values.append(own & (1 << 20) - 1)
        at = np.flatnonzero(real[:-2] & real[1:-1] & real[2:])
        gram = grams(points)[at]
        order = np.argsort(gram, kind="stable")
        key, value = np.concatenate([keys[1], keys[0], gram[order]]), np.concatenate([values[1], values[0], at[order]])
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        step = np.diff(value, prepend=0)
        step[first] = value[first]
        raw, width = pack(step)
        ends = np.r_[0, np.cumsum(width)]
        cuts = ends[np.r_[first, len(key)]].astype(np.int32)
        k = len(first)
        lists = pa.BinaryArray.from_buffers(pa.binary(), k, [None, pa.py_buffer(cuts.tobytes()), pa.py_buffer(raw.tobytes())])
        counts = np.diff(np.r_[first, len(key)]).astype(np.int32)
        none = pa.nulls(1)
        return pa.record_batch(
            [
                pa.array(np.full(k + 1, base + number)),
                pa.concat_arrays([pa.array(key[first]), none.cast(pa.int64())]),
                pa.concat_arrays([pa.array(counts), none.cast(pa.int32())]),
                pa.concat_arrays([lists, none.cast(pa.binary())]),
                pa.array([None] * k + [starts.tolist()], pa.list_(pa.int32())),
                pa.array([None] * k + [[i for i, _ in held]], pa.list_(pa.int64())),
            ],
            ["segment", "gram", "n", "places", "starts", "ids"],
        )

    for batch in batches:
        for id_, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            points = _points(text)
            if held and size + len(points) > SEGMENT:
                yield segment()
                held, size, number = [], 0, number + 1
            held.append((id_, points))
            size += len(points)
    if held:
        yield segment()


class Index:
    """Posting lists and texts' places below a folder."""

    def __init__(self, rows: DataFrame):
        self.postings = rows.where("gram is not null").select("segment", "gram", "n", "places")
        self.texts = rows.where("gram is null").select("segment", "starts", "ids")

    @staticmethod
    def build(documents: DataFrame, path: str, id_column: str = "doc_id", title: str = "title", raw: str = "raw") -> Index:
        """Index the documents and write it to ``path``."""
        empty = F.lit("")
        rows = documents.select(F.col(id_column).cast("long").alias("id"), F.lower(F.concat(F.coalesce(title, empty), F.lit("\n"), F.coalesce(raw, empty))).alias("text"))
        rows.mapInArrow(_indexed, f"{POSTINGS}, starts array<int>, ids array<long>").write.mode("overwrite").option("compression", "zstd").parquet(path)
        return Index.load(documents.sparkSession, path)

    @staticmethod
    def load(spark, path: str) -> Index:
        return Index(spark.read.schema(f"{POSTINGS}, starts array<int>, ids array<long>").parquet(path))

    def search(self, queries: DataFrame, every_row: bool = False) -> DataFrame:
        """(query_id, id) for queries (query_id, text): each id once that has a text with the string, or once for each such text."""
        clean = queries.select("query_id", F.lower(py_strip(F.coalesce("text", F.lit("")))).alias("text"))
        kind = queries.schema["query_id"].dataType.simpleString()
        wanted = clean.where("text <> ''").mapInArrow(_wanted, f"query_id {kind}, place int, gram long, n_grams int")
        heads = self.postings.select("segment", "gram")
        all_there = wanted.join(heads, "gram").groupBy("query_id", "segment").agg(F.count("*").alias("found"), F.first("n_grams").alias("n_grams")).where("found = n_grams").select("query_id", "segment")
        # A list that is needed goes to its segment's task once, before the strings that may be in the segment.
        needed = all_there.join(wanted, "query_id").select("segment", "gram").distinct()
        lists = self.postings.join(needed, ["segment", "gram"], "left_semi").select("segment", "gram", "places")
        parts = wanted.groupBy("query_id").agg(F.collect_list(F.struct("place", "gram")).alias("parts"))
        texts = self.texts.join(all_there.select("segment").distinct(), "segment", "left_semi")
        met = lists.unionByName(texts, allowMissingColumns=True).unionByName(all_there.join(parts, "query_id"), allowMissingColumns=True)
        met = met.select("segment", "gram", "places", "starts", "ids", "query_id", "parts").repartition("segment").sortWithinPartitions("segment", F.col("starts").isNull(), F.col("gram").isNull())
        found = met.mapInArrow(_met, f"query_id {kind}, id long")
        everywhere = clean.where("text = ''").select("query_id").crossJoin(self.texts.select(F.explode("ids").alias("id")))  # the result of an empty string
        both = found.unionByName(everywhere)
        return both if every_row else both.distinct()


def _wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The trigrams that cover each string, with their offsets; for one or two characters their own key, at place -1."""
    for batch in batches:
        out: list[tuple] = []
        for id_, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            points = _points(text)
            n = len(points)
            if n < 3:
                out.append((id_, -1, short_gram(*map(int, points)), 1))
                continue
            own, places = grams(points), sorted({*range(0, n - 2, 3), n - 3})
            out += [(id_, p, int(own[p]), len(places)) for p in places]
        columns = list(zip(*out, strict=True)) or [()] * 4
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (batch.schema.field(0).type, pa.int32(), pa.int64(), pa.int32()), strict=True)], ["query_id", "place", "gram", "n_grams"])


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts where all lists of a string meet. A segment's texts come first, then its lists, then the strings."""
    now: int | None = None
    lists: dict[int, bytes] = {}
    starts, ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        queries, found = [], []
        columns = [batch.column(k) for k in range(7)]
        for k, (segment, gram, query) in enumerate(zip(*(columns[c].to_pylist() for c in (0, 1, 5)), strict=True)):
            if segment != now:
                now, lists = segment, {}
            if columns[3][k].is_valid:
                starts, ids = np.array(columns[3][k].as_py(), np.int64), columns[4][k].as_py()
            elif gram is not None:
                lists[gram] = columns[2][k].as_py()
            else:
                hit = _places(columns[6][k].as_py(), lists, starts)
                found += [ids[t] for t in hit.tolist()]
                queries += [query] * len(hit)
        yield pa.record_batch([pa.array(queries, batch.schema.field(5).type), pa.array(found, pa.int64())], ["query_id", "id"])


def _places(parts: list[dict], lists: dict[int, bytes], starts: np.ndarray) -> np.ndarray:
    """The numbers of the texts that hold a string, by its lists from the shortest on."""
    at: np.ndarray | None = None
    for part in sorted(parts, key=lambda p: len(lists[p["gram"]])):
        own = np.cumsum(unpack(lists[part["gram"]]))
        if part["place"] < 0:
            return own
        own = own - part["place"]
        at = own if at is None else np.intersect1d(at, own, assume_unique=True)
        if not len(at):
            break
    return np.unique(np.searchsorted(starts, at, "right") - 1)
