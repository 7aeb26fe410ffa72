"""Quality rules: cross-document line frequency by host.

Base rules judge a text alone: too few words, or too large a share of words in
repeated windows. Then lines, normalised to their lower-cased words, are hashed,
and distinct documents are counted for each line and host. A line is over the
limit when more than ``max(MIN_DOCS, SHARE * distinct documents of the host)`` of
them hold it; such lines are boilerplate and removed, and a document that
keeps less than ``KEEP`` of its words is depleted and rejected.

Documents are told apart by a hash of the whole set of their lines: copies of a
text count as one document, for a line and for its host alike, so no verdict
depends on how often a text was copied; documents that differ in any line are
counted each.

Copies are merged first, then lines are counted on (host, line), combined before
the shuffle; a line that all documents share is a few partial counts from each task.

Defined results: a null or blank text has no words and fails the base rules; a
null host is a host of its own; equal rows get equal results; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ._common import row_hash, saved, shared_dir, slices, utf8
from ._vector import LOWER, mix, separators, span_hash, words

MIN_WORDS = 20
WINDOW = 8
MAX_REPEATED_PERCENT = 30
MIN_DOCS = 20
SHARE = 0.01
KEEP = 0.25
_SPACE = separators("space")
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
STATS = "doc_id long, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, identity long, mark long, lines array<struct<line:long,n:long>>"


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(flags, dtype=np.int64))
    return total[offsets[1:]] - total[offsets[:-1]]


def _lines(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and documents of all \\n-split lines."""
    breaks = np.flatnonzero(buf == 10)
    starts = np.concatenate([offsets[:-1], breaks + 1])
    order = np.lexsort((np.concatenate([np.zeros(len(offsets) - 1), np.ones(len(breaks))]), starts))
    doc = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, breaks, "right") - 1])
    starts, doc = starts[order], doc[order]
    ends = offsets[doc + 1].copy()
    same = np.flatnonzero(doc[1:] == doc[:-1])
    ends[same] = starts[same + 1] - 1
    return starts, ends, doc


def _first_of(keys: np.ndarray) -> np.ndarray:
    """Flags the first place of each value."""
    _, at = np.unique(keys, return_index=True)
    out = np.zeros(len(keys), bool)
    out[at] = True
    return out


def line_words(buf: np.ndarray, offsets: np.ndarray):
    """Per line with a word: its document, exact hash, normalised hash, first and last word (exclusive), start and end."""
    starts, ends, first = words(buf, offsets, _SPACE)
    at, stop, doc = _lines(buf, offsets)
    low, high = np.searchsorted(starts, at), np.searchsorted(starts, stop)
    own = np.flatnonzero(high > low)
    at, stop, doc, low, high = at[own], stop[own], doc[own], low[own], high[own]
    folded = span_hash(LOWER[buf], starts, ends)
    return doc, span_hash(buf, at, stop), span_hash(folded, low, high), low, high, at, stop, (starts, ends, first)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        buf, offsets = utf8(batch.column(2))
        doc, exact, line, low, high, _, _, (starts, ends, first) = line_words(buf, offsets)
        n = np.diff(first)
        n_docs = len(n)
        salt = mix(np.arange(n_docs).astype(np.uint64) + np.uint64(1))
        chars = _sums(~_SPACE[buf] & ((buf & 0xC0) != 0x80), offsets)
        dup = np.bincount(doc[~_first_of(exact ^ salt[doc])], minlength=n_docs)
        # Words in windows that occur twice or more in the text.
        values = span_hash(buf, starts, ends)
        ok = np.ones(len(values), bool)
        for a, b in zip(np.maximum(first[1:] - WINDOW + 1, first[:-1]), first[1:], strict=True):
            ok[a:b] = False
        begin = np.flatnonzero(ok)
        owner = np.searchsorted(first, begin, "right") - 1
        _, back, count = np.unique(span_hash(values, begin, begin + WINDOW) ^ salt[owner], return_inverse=True, return_counts=True)
        cover = np.zeros(len(values) + 1, np.int64)
        twice = begin[count[back] > 1]
        np.add.at(cover, twice, 1)
        np.add.at(cover, twice + WINDOW, -1)
        repeated = _sums(np.cumsum(cover[:-1]) > 0, first)
        # Distinct lines of each document, and a hash of their set.
        _, at, back = np.unique(line ^ salt[doc], return_index=True, return_inverse=True)
        size = np.bincount(back, weights=high - low).astype(np.int64)
        order = np.lexsort((line[at], doc[at]))
        of, hashed, size = doc[at][order], line[at][order], size[order]
        cut = np.searchsorted(of, np.arange(n_docs + 1))
        total = np.append(np.uint64(0), np.cumsum(mix(hashed), dtype=np.uint64))
        mark = (total[cut[1:]] - total[cut[:-1]]).view(np.int64)
        lists = []
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            lists.append([{"line": x, "n": s} for x, s in zip(hashed[a:b].view(np.int64).tolist(), size[a:b].tolist(), strict=True)])
        yield pa.record_batch(
            [batch.column(0), batch.column(1), *(pa.array(x.astype(np.int64)) for x in (n, chars, _sums(_SYMBOLS[buf], offsets), dup, repeated)), batch.column(3), pa.array(mark), pa.array(lists, pa.list_(pa.struct([("line", pa.int64()), ("n", pa.int64())])))],
            ["doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "identity", "mark", "lines"],
        )


def _identity(host: Column, id_column: str = "doc_id", text_column: str = "text") -> Column:
    """Tells unlike rows apart, also where they share an id."""
    return F.xxhash64(row_hash(id_column, text_column), host)


def measured(documents: DataFrame, host_column: str = "source", id_column: str = "doc_id", text_column: str = "text", work: str | None = None) -> DataFrame:
    """Base figures and hashed lines of every row, written; ``row`` tells rows apart."""
    host = F.coalesce(F.col(host_column).cast("string"), F.lit(""))
    docs = documents.select(F.col(id_column).cast("long").alias("doc_id"), host.alias("host"), F.coalesce(F.col(text_column), F.lit("")).alias("text"), _identity(host, id_column, text_column).alias("identity"))
    work = work or shared_dir(documents.sparkSession, "quality")
    return saved(docs.mapInArrow(_measure, STATS).withColumn("row", F.monotonically_increasing_id()), f"{work}/measured")


def lines_over_limit(stats: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE) -> DataFrame:
    """(host, line, n_docs): lines that too many distinct documents of a host hold."""
    marks = stats.select("host", "mark", F.col("lines.line").alias("lines")).dropDuplicates(["host", "mark"]).select("host", F.explode("lines").alias("line"))
    hosts = stats.where(F.size("lines") > 0).select("host", "mark").distinct().groupBy("host").agg(F.count("*").alias("n_host"))  # the same documents
    return marks.groupBy("host", "line").agg(F.count("*").alias("n_docs")).where(F.col("n_docs") > min_docs).join(hosts, "host").where(F.col("n_docs") > share * F.col("n_host")).select("host", "line", "n_docs")


def quality(documents: DataFrame, host_column: str = "source", id_column: str = "doc_id", text_column: str = "text", min_docs: int = MIN_DOCS, share: float = SHARE, keep: float = KEEP, work: str | None = None) -> DataFrame:
    """Per row: base figures, base_failed, n_boilerplate (words in lines over the limit), boilerplate (their hashes) and kept."""
    work = work or shared_dir(documents.sparkSession, "quality")
    stats = measured(documents, host_column, id_column, text_column, work)
    over = saved(lines_over_limit(stats, min_docs, share), f"{work}/over")
    gone = (
        stats.select("row", "host", F.explode("lines").alias("x")).select("row", "host", "x.line", "x.n")
        .join(over, ["host", "line"])
        .groupBy("row").agg(F.sum("n").alias("n_boilerplate"), F.collect_list("line").alias("boilerplate"))
    )
    n_boilerplate = F.coalesce("n_boilerplate", F.lit(0).cast("long"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    return stats.join(gone, "row", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), n_boilerplate.alias("n_boilerplate"), "boilerplate",
        (~failed & (F.col("n_words") - n_boilerplate >= keep * F.col("n_words"))).alias("kept"), "identity",
    )


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, boilerplate, rest) to (text, rest)."""
    for batch in slices(batches):
        buf, offsets = utf8(batch.column(0))
        raw, found = buf.tobytes(), batch.column(1).to_pylist()
        lines: list[list[bytes]] = [[] for _ in found]
        doc, _, line, _, _, at, stop, _ = line_words(buf, offsets)
        named = [set(x or ()) for x in found]
        for d, x, a, b in zip(doc.tolist(), line.view(np.int64).tolist(), at.tolist(), stop.tolist(), strict=True):
            if x not in named[d]:
                lines[d].append(raw[a:b])
        yield pa.record_batch([pa.array([b"\n".join(x).decode() for x in lines], pa.string()), batch.column(2)], ["text", "rest"])


def without_boilerplate(documents: DataFrame, verdict: DataFrame, host_column: str = "source") -> DataFrame:
    """The kept documents of ``verdict``, less their lines over the limit. Texts without such lines are unchanged; null doc_ids go."""
    columns = documents.columns
    kept = verdict.where("kept").select(F.col("identity").alias("_identity"), F.col("boilerplate").alias("_boilerplate")).dropDuplicates(["_identity"])
    mine = documents.where("doc_id is not null").withColumn("_identity", _identity(F.coalesce(F.col(host_column).cast("string"), F.lit(""))))
    joined = mine.join(kept, "_identity")
    plain = joined.where("_boilerplate is null").select(columns)
    stripped = joined.where("_boilerplate is not null").select("text", F.col("_boilerplate").alias("boilerplate"), F.struct(*(c for c in columns if c != "text")).alias("rest"))
    changed = stripped.mapInArrow(_strip, StructType([stripped.schema["text"], stripped.schema["rest"]])).select("rest.*", "text")
    if "n_chars" in columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType))
    return plain.unionByName(changed.select(columns))
