"""Token ids in word-aligned binary files: Simple-8b with escapes and per-block offsets.

A word of 64 bits has a selector in its top four bits and as many ids as fit in
the other 60. Selector 0 is the escape: the word's low bits count the raw 64-bit
words that follow, for values over 60 bits.

A file is a row of blocks and a footer, each closed by ``MARK``:

    block   "S8BK", counts of documents, ids and words (u32), file number (u64),
            then three coded runs, each headed by its words (u32): doc_id gaps
            (zigzag), lengths, ids
    footer  "S8BF", number of blocks (u32), their offsets in the file (u64),
            the footer's own offset (u64)

Files hold ascending doc_id ranges and are numbered in that order. They are
written by Spark's own committer, so a lost executor leaves no half files, and
read with the binaryFile source; both work on any store that Spark knows.

Defined results: a null text is empty, so only the end id; equal doc_ids keep
all their rows, in any order; an empty table writes no file and gives no rows;
further columns are ignored; null doc_ids are dropped.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import binary, saved, shared_dir, slices, text_of, trim, utf8
from ._vector import separators, span_hash

#: Ids and bits of each selector; fixed values of the coding. Selector 0 is the escape.
PACKING = ((0, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
MARK = "<S8B>\r\n"
BLOCK_IDS = 1 << 16
#: Text bytes that one file takes.
FILE_BYTES = 32 << 20
#: Distinct pieces of text in a generation of an encoder's cache.
CACHE = 50_000
#: Slots of a generation of chunks, as a power of two.
TABLE_BITS = 20
#: Texts, or pieces of them, that the tokenizer gets at once: it makes large objects of them.
GROUP = 4096


_BITS_16 = np.maximum(np.frexp(np.arange(1 << 16, dtype=float))[1], 1).astype(np.uint8)


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits that each value takes, at least one."""
    if values.dtype.itemsize == 2:
        return _BITS_16[values]
    if int(values.max()) < 1 << 32:
        return np.maximum(np.frexp(values.astype(np.float64))[1], 1).astype(np.uint8)
    out = np.ones(len(values), np.uint8)
    for b in range(1, 64):
        out += values >> np.uint64(b) != 0
    return out


def pack(values: np.ndarray) -> np.ndarray:
    """Unsigned values as Simple-8b words; always the selector that takes most values."""
    values = np.asarray(values)
    if values.dtype != np.uint16:
        values = values.astype(np.uint64)
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64)
    padded = np.append(values, np.zeros(60, values.dtype))
    bits = _bits(padded)
    # The widest of the next k values, for each count k of the selectors, from few to many.
    most, widest = {1: bits}, bits
    step, chosen = (bits[:n] <= 60).astype(np.uint8), np.where(bits[:n] <= 60, len(PACKING) - 1, 0).astype(np.uint8)
    have = 1
    for selector in range(len(PACKING) - 2, 0, -1):
        count, room = PACKING[selector]
        while have < count:
            part = max(k for k in most if k <= count - have)
            widest = np.maximum(widest[: len(widest) - part], most[part][have : have + len(widest) - part])
            have += part
            most[have] = widest
        fits = widest[:n] <= room
        if not fits.any():
            break
        step[fits], chosen[fits] = count, selector
    at, i, jump = [], 0, np.maximum(step, 1).tolist()
    while i < n:
        at.append(i)
        i += jump[i]
    at = np.array(at)
    selector = chosen[at]
    escaped = selector == 0
    place = np.arange(len(at)) + np.append(0, np.cumsum(escaped))[:-1]
    out = np.zeros(len(at) + int(escaped.sum()), np.uint64)
    for k in map(int, np.unique(selector)):
        own = selector == k
        if k == 0:
            out[place[own]] = 1
            out[place[own] + 1] = values[at[own]]
            continue
        count, bits = PACKING[k]
        first, word = at[own], np.uint64(k << 60)
        for i in range(count):
            word = word | (padded[first + i].astype(np.uint64) << np.uint64(i * bits))
        out[place[own]] = word
    return out


def unpack(words: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` values of the words."""
    words = np.asarray(words, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    k = 0
    for k in np.flatnonzero(selector == 0).tolist():  # escapes are rare
        if not raw[k]:
            raw[k + 1 : k + 1 + int(words[k] & np.uint64((1 << 60) - 1))] = True
    counts = np.array([c for c, _ in PACKING] + [0])[np.minimum(selector, len(PACKING))]
    counts[raw] = 1
    at = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    out[at[raw]] = words[raw]
    for k in np.unique(selector[~raw]):
        count, bits = PACKING[k] if k else (0, 0)
        if count:
            own = np.flatnonzero((selector == k) & ~raw)
            out[at[own][:, None] + np.arange(count)] = (words[own][:, None] >> (np.arange(count) * bits).astype(np.uint64)) & np.uint64((1 << bits) - 1)
    return out[:n]


def _zigzag(x: np.ndarray) -> np.ndarray:
    return ((x << 1) ^ (x >> 63)).view(np.uint64)


def block(number: int, doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    gaps = _zigzag(np.diff(np.asarray(doc_ids, np.int64), prepend=0))
    runs = [pack(x) for x in (gaps, lengths, ids)]
    head = b"S8BK" + struct.pack("<IIIQ", len(doc_ids), len(ids), sum(map(len, runs)), number)
    return head + b"".join(struct.pack("<I", len(r)) + r.astype("<u8").tobytes() for r in runs)


def read_file(raw: bytes) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(file number, doc_ids, lengths, ids) of each block, found by the footer's offsets."""
    mark = MARK.encode()
    end = len(raw) - len(mark)
    (foot,) = struct.unpack_from("<Q", raw, end - 8)
    if raw[foot : foot + 4] != b"S8BF" or raw[end:] != mark:
        raise ValueError("no token file: its footer is missing")
    (n,) = struct.unpack_from("<I", raw, foot + 4)
    for offset in np.frombuffer(raw, "<u8", n, foot + 8).tolist():
        n_docs, n_ids, _, number = struct.unpack_from("<IIIQ", raw, offset + 4)
        at, runs = offset + 24, []
        for count in (n_docs, n_docs, n_ids):
            (size,) = struct.unpack_from("<I", raw, at)
            runs.append(unpack(np.frombuffer(raw, "<u8", size, at + 4), count))
            at += 4 + 8 * size
        gaps = runs[0]
        doc_ids = np.cumsum((gaps >> np.uint64(1)).astype(np.int64) ^ -(gaps & np.uint64(1)).astype(np.int64))
        yield number, doc_ids, runs[1].astype(np.int64), runs[2]


class PieceEncoder:
    """A tokenizers file applied to pieces of text that its pre-tokenizer never joins, each distinct piece once.

    Pieces end where the byte-level pattern has a boundary in any case: they are
    its own pieces, but for runs of letters and digits, which stay together.
    Texts with x1C-x1F, which only Python counts as white space, or with a
    special token's text go in whole.
    """

    PIECES = re.compile(r"'(?:s|t|re|ve|m|ll|d)| ?[^\W_]+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = re.compile("|".join(["[\x1c\x1d\x1e\x1f]", *special]))
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}  # the generation that is dropped next
        self.spaced = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), bool)
        for token, k in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.spaced[k] = token.startswith("\u0120")  # a space in the byte-level alphabet

    def _learn(self, unseen: list[str]) -> None:
        """Pieces that begin with their only white space go to the tokenizer in one text: each starts at a token with a space."""
        plain = [p for p in unseen if p[0] == " " and len(p) > 1]
        rest = [p for p in unseen if p[0] != " " or len(p) == 1]
        for group in (plain[k : k + GROUP] for k in range(0, len(plain), GROUP)):
            (e,) = self.tokenizer.encode_batch_fast(["".join(group)], add_special_tokens=False)
            ids = np.array(e.ids, self.kind)
            at = np.flatnonzero(self.spaced[ids])
            if len(at) != len(group):
                rest += group
                continue
            raw, width = ids.tobytes(), self.kind.itemsize
            ends = np.append(at[1:], len(ids)) * width
            self.known.update(zip(group, [raw[x:y] for x, y in zip((at * width).tolist(), ends.tolist(), strict=True)], strict=True))
        for group in (rest[k : k + GROUP] for k in range(0, len(rest), GROUP)):
            for p, e in zip(group, self.tokenizer.encode_batch_fast(group, add_special_tokens=False), strict=True):
                self.known[p] = np.array(e.ids, self.kind).tobytes()

    def encode(self, texts: list[str], end: bytes) -> list[bytes]:
        """Ids of each text, packed as ``kind``, with ``end`` appended."""
        odd = self.whole.search("\n".join(texts)) is not None
        pieces = [[t] if odd and self.whole.search(t) else self.PIECES.findall(t) for t in texts]
        if len(self.known) > CACHE:
            self.known, self.before = {}, self.known
        unseen = set().union(*pieces).difference(self.known)
        again = unseen & self.before.keys()
        self.known.update((p, self.before[p]) for p in again)
        self._learn(list(unseen - again))
        look = self.known.__getitem__
        return [b"".join(map(look, own)) + end for own in pieces]


class ChunkTable:
    """Ids of chunks of text by the chunks' 64-bit hash, in flat arrays: open addressing, looked up for a batch at once.

    A chunk's first eight bytes and its length are kept too, and compared by whoever looks it up.
    """

    def __init__(self, kind: np.dtype, bits: int = 16):
        self.kind = kind
        self._clear(bits)

    def _clear(self, bits: int) -> None:
        self.mask = np.uint64((1 << bits) - 1)
        self.keys, self.at, self.size = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.uint32), np.zeros(1 << bits, np.uint32)
        self.ids, self.used, self.held = np.zeros(1 << bits, self.kind), 0, 0
        self.heads = np.zeros(1 << bits, np.uint64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Each hash's slot, -1 if it isn't held."""
        slot = (hashes & self.mask).astype(np.int64)
        out, open_ = np.full(len(hashes), -1), np.arange(len(hashes))
        while len(open_):
            have = self.keys[slot]
            hit = have == hashes[open_]
            out[open_[hit]] = slot[hit]
            go = ~hit & (have != 0)
            open_, slot = open_[go], (slot[go] + 1) & int(self.mask)
        return out

    def add(self, hashes: np.ndarray, raw: np.ndarray, n: np.ndarray, heads: np.ndarray) -> None:
        """Distinct hashes that aren't held, with their ids in a row, each one's number, and what tells chunks of one hash apart."""
        if self.held + len(hashes) > 0.8 * len(self.keys):
            own = np.flatnonzero(self.keys)
            keys, at, size, ids, used, held, before = self.keys[own], self.at[own], self.size[own], self.ids, self.used, self.held, self.heads[own]
            self._clear(int(np.ceil(np.log2((held + len(hashes)) / 0.45))))
            slot = self._place(keys)
            self.at[slot], self.size[slot], self.ids, self.used, self.held, self.heads[slot] = at, size, ids, used, held, before
        if self.used + len(raw) > len(self.ids):
            self.ids = np.append(self.ids[: self.used], np.zeros(max(len(raw), self.used // 4), self.kind))
        self.ids[self.used : self.used + len(raw)] = raw
        slot = self._place(hashes)
        self.at[slot], self.size[slot], self.heads[slot] = self.used + np.cumsum(n) - n, n, heads
        self.used += len(raw)
        self.held += len(hashes)

    def _place(self, hashes: np.ndarray) -> np.ndarray:
        slot = (hashes & self.mask).astype(np.int64)
        open_ = np.arange(len(hashes))
        while len(open_):
            free = open_[self.keys[slot[open_]] == 0]
            self.keys[slot[free]] = hashes[free]
            open_ = open_[self.keys[slot[open_]] != hashes[open_]]
            slot[open_] = (slot[open_] + 1) & int(self.mask)
        return slot

    def gather(self, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all slots in a row, and each slot's number."""
        n = self.size[slot].astype(np.int64)
        ends = np.cumsum(n)
        place = np.repeat(self.at[slot] - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0)
        return self.ids[place], n


_BLANK = separators("space")
#: White space beyond ASCII's in UTF-8, as numbers; and the bytes that it, or x1C-x1F, begins with.
_TWO_BYTES = np.array([0xC285, 0xC2A0])
_WIDE = np.array([0xE19A80, 0xE38080, 0xE2819F, *range(0xE28080, 0xE2808B), 0xE280A8, 0xE280A9, 0xE280AF])
_SUSPECT = np.zeros(256, bool)
_SUSPECT[[0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3]] = True


class BatchEncoder:
    """Ids of the texts of an Arrow batch. Texts are cut before a space between other characters, where
    the pattern has a boundary in any case; each distinct chunk is encoded once and then looked up.

    The chunks are held in two tables of a bounded size. When one is full, the other is dropped, and
    what is still used is taken over from it into a new one, so the memory does not grow with the input."""

    def __init__(self, path: str):
        self.pieces = PieceEncoder(path)
        self.kind = self.pieces.kind
        self.table = ChunkTable(self.kind)
        self.before = ChunkTable(self.kind)  # the generation that is dropped next
        self.special = [t.content.encode() for t in self.pieces.tokenizer.get_added_tokens_decoder().values()]

    def _odd(self, buf: np.ndarray, offsets: np.ndarray, raw: bytes) -> np.ndarray:
        """Texts with white space beyond ASCII's, or with a special token's text."""
        suspect = np.flatnonzero(_SUSPECT[buf])
        at = suspect[buf[suspect] < 0x20]
        rest = suspect[buf[suspect] >= 0x20]
        if len(rest):
            padded = np.append(buf, np.zeros(2, np.uint8))
            code = (padded[rest].astype(np.int64) << 16) | (padded[rest + 1].astype(np.int64) << 8) | padded[rest + 2]
            at = np.append(at, rest[np.isin(code, _WIDE) | np.isin(code >> 8, _TWO_BYTES)])
        for token in self.special:
            k = raw.find(token)
            while k >= 0:
                at, k = np.append(at, k), raw.find(token, k + 1)
        out = np.zeros(len(offsets) - 1, bool)
        out[np.searchsorted(offsets, at, "right") - 1] = True
        return out

    @staticmethod
    def _heads(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The first eight bytes of every chunk and its length, in one number; exact up to eight bytes."""
        padded, size = np.append(buf, np.zeros(8, np.uint8)), ends - starts
        out = size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for k in range(8):
            out += np.where(size > k, padded[starts + k], 0).astype(np.uint64) << np.uint64(8 * k)
        return out

    def encode(self, buf: np.ndarray, offsets: np.ndarray, end: bytes) -> list[bytes]:
        raw, n_docs = buf.tobytes(), len(offsets) - 1
        blank = _BLANK[buf]
        cut = np.zeros(len(buf) + 1, bool)
        cut[1:-2] = (buf[1:-1] == 0x20) & ~blank[:-2] & ~blank[2:] if len(buf) > 2 else False
        last = offsets[1:] - 1
        cut[last[last >= 0]] = False  # a text's last character starts no chunk, nor does its first space but as the text's start
        cut[offsets] = True
        cut[-1] = False
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(buf))
        hashes = span_hash(buf, starts, ends)
        hashes[hashes == 0] = 1
        heads = self._heads(buf, starts, ends)
        slot = self.table.find(hashes)
        unseen = np.flatnonzero(slot < 0)
        if len(unseen):
            new, first = np.unique(hashes[unseen], return_index=True)
            if self.table.held + len(new) > 0.75 * (1 << TABLE_BITS):
                self.before, self.table = self.table, ChunkTable(self.kind)
                new, first = np.unique(hashes, return_index=True)
                unseen = np.arange(len(hashes))
            again = self.before.find(new)
            old, first = again[again >= 0], unseen[first[again < 0]]
            if len(old):
                self.table.add(new[again >= 0], *self.before.gather(old), self.before.heads[old])
            new = new[again < 0]
            for k in range(0, len(new), 4 * GROUP):
                own = first[k : k + 4 * GROUP]
                texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(starts[own].tolist(), ends[own].tolist(), strict=True)]
                pieces = self.pieces.encode(texts, b"")
                sizes = np.array([len(p) for p in pieces]) // self.kind.itemsize
                self.table.add(new[k : k + 4 * GROUP], np.frombuffer(b"".join(pieces), self.kind), sizes, heads[own])
            slot = self.table.find(hashes)
        ids, n = self.table.gather(slot)
        flat, width = ids.tobytes(), self.kind.itemsize
        bound = (np.append(0, np.cumsum(n))[np.searchsorted(starts, offsets)] * width).tolist()
        out = [flat[a:b] + end for a, b in zip(bound[:-1], bound[1:], strict=True)]
        odd = self._odd(buf, offsets, raw)
        clash = starts[self.table.heads[slot] != heads]  # another chunk of the same hash
        odd[np.searchsorted(offsets, clash, "right") - 1] = True
        for d in np.flatnonzero(odd).tolist():
            out[d] = self.pieces.encode([raw[offsets[d] : offsets[d + 1]].decode("utf-8", "replace")], end)[0]
        assert len(out) == n_docs
        return out


@lru_cache(maxsize=1)
def encoder_of(path: str) -> BatchEncoder:
    """One encoder for each Python worker: the chunks it has learnt serve its later tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return BatchEncoder(path)


def _encode(tokenizer: str, end_id: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer)
        end = np.array([end_id], encoder.kind).tobytes()
        for batch in slices(batches):
            yield pa.record_batch([batch.column(0), binary(encoder.encode(*utf8(batch.column(1)), end))], ["doc_id", "ids"])

    return task


def _write(kind: np.dtype):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, at, offsets, docs, lengths, held, total = None, 0, [], [], [], [], 0

        def flush():
            nonlocal at, docs, lengths, held, total
            raw = block(number, np.array(docs), np.array(lengths), np.frombuffer(b"".join(held), kind))
            offsets.append(at)
            at += len(raw) + len(MARK)
            docs, lengths, held, total = [], [], [], 0
            return pa.record_batch([binary([raw])], ["value"])

        for batch in batches:
            for n, doc, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                number, ids = n, ids.as_py()
                docs.append(doc)
                lengths.append(len(ids) // kind.itemsize)
                held.append(ids)
                total += lengths[-1]
                if total >= BLOCK_IDS:
                    yield flush()
        if docs:
            yield flush()
        if offsets:
            trim()
            foot = b"S8BF" + struct.pack("<I", len(offsets)) + np.array(offsets, "<u8").tobytes() + struct.pack("<Q", at)
            yield pa.record_batch([binary([foot])], ["value"])

    return task


def write_tokens(documents: DataFrame, tokenizer: str, path: str, end_id: int = 0, id_column: str = "doc_id", text_column: str = "text", file_bytes: int = FILE_BYTES) -> None:
    """Encode every text with a tokenizers file, append ``end_id``, and write files of ascending doc_id ranges."""
    docs = text_of(documents, id_column, text_column).where("doc_id is not null")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = int(total // file_bytes) + 1
    cuts = docs.select(F.percentile_approx("doc_id", [k / files for k in range(1, files)], 20 * files)).first()[0] if files > 1 else []
    cuts = sorted(set(cuts or []))
    from tokenizers import Tokenizer

    kind = np.dtype("<u2" if Tokenizer.from_file(tokenizer).get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
    bounds = np.array(cuts, np.int64)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _encode(tokenizer, end_id)(batches):
            where = np.searchsorted(bounds, batch.column(0).to_numpy(zero_copy_only=False), "left").astype(np.int32)
            yield pa.record_batch([pa.array(where), *batch.columns], ["file", "doc_id", "ids"])

    coded = docs.mapInArrow(number, "file int, doc_id long, ids binary")
    ranged = coded.repartitionById(len(cuts) + 1, F.col("file")).sortWithinPartitions("doc_id")
    ranged.mapInArrow(_write(kind), "value binary").select(F.col("value").cast("string")).write.mode("overwrite").option("lineSep", MARK).text(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for raw in batch.column(0):
            start = 0
            for number, docs, lengths, ids in read_file(raw.as_py()):
                ends = np.cumsum(lengths)
                wide = ids.astype("<u4").tobytes()
                yield pa.record_batch(
                    [pa.array([number] * len(docs), pa.int64()), pa.array(docs), pa.array(start + ends - lengths), pa.array(lengths), binary([wide[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)])],
                    ["file", "doc_id", "at", "n_tokens", "ids"],
                )
                start += int(lengths.sum())
        trim()


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(file, doc_id, at, n_tokens, ids): a row per document; ids as little-endian unsigned 32-bit integers, ``at`` its place in the file."""
    return _files(spark, path).mapInArrow(_read, "file long, doc_id long, at long, n_tokens long, ids binary")


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).where("length > 0").select("content")


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _read(batches):
        sums = pa.array([zlib.crc32(x.as_py()) for x in batch.column(4)], pa.int64())
        yield pa.record_batch([*batch.columns[:4], sums], ["file", "doc_id", "at", "n_tokens", "ids_crc32"])


def round_trip(documents: DataFrame, tokenizer: str, end_id: int = 0, id_column: str = "doc_id", text_column: str = "text", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the files, read them back, and place every document in the whole sequence of ids."""
    spark = documents.sparkSession
    work = shared_dir(spark, "tokens")
    write_tokens(documents, tokenizer, f"{work}/files", end_id, id_column, text_column, file_bytes)
    rows = saved(_files(spark, f"{work}/files").mapInArrow(_sums, "file long, doc_id long, at long, n_tokens long, ids_crc32 long"), f"{work}/rows")
    sizes = rows.groupBy("file").agg(F.sum("n_tokens").alias("n"))  # a row per file
    before = F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    bases = sizes.select("file", F.coalesce(before, F.lit(0)).alias("before"))
    return rows.join(bases, "file").select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
