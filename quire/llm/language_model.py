"""Language-model scoring by a hierarchical Pitman-Yor model, seated by Gibbs sampling.

Tokens are the words of a text, lower-cased in A-Z, and one end. Every word, and a
text's start, is a context with a restaurant of its own, whose customers are the
training tokens that follow it. Their tables are the customers of one shared
parent, a restaurant of single words, whose base is uniform over the known words
and one unknown. A *cell* is a dish in a restaurant: a (context, word) pair.

1. ``blocks``: about ``BLOCK_BYTES`` of text as its distinct words and the sequence
   of their places. Words are dealt to word parts by their hash and counted there.
2. ``cells``: each block sends its distinct cells to cell parts. A cell part is
   dealt by context; contexts with over a quarter of a part's tokens are dealt by
   cell, so no restaurant has to fit into a task.
3. ``ROUNDS`` of Gibbs: word parts tell cell parts the tables of contexts and the
   parent's probabilities of words; cell parts reseat all customers of each cell
   and tell back how many tables they opened; word parts reseat the parent's
   customers, and draw what the strengths need. Cells with one customer have one
   table, so only the others (``multi``) travel.
4. After the first rounds the drawn strengths and discounts stay, and predictive
   probabilities are averaged over the last ``SAMPLES`` seatings: cell parts send
   each block its cells' shares, word parts its words', and the block adds up the
   log10 probabilities of its texts.

Reseating a cell (``seat``) takes out all its customers and draws their tables
given all other cells: from the exact distribution up to ``EXACT`` customers; beyond,
they sit down one after another (past 128 in groups of a 64th of those that sit),
and of ``TRIES`` such seatings one is taken by its importance weight. Discounts are drawn from
Beta(1 + n1, 1 + 2 n2), n1 and n2 being the cells with one and two customers;
strengths by auxiliary variables (Beta and Bernoulli draws per restaurant, then a
Gamma draw).

Parts depend on the table's size only, and each is seeded by its number and put
in one order, so results don't depend on how the table is partitioned, and a lost
task gives the same seating again. Counts for base_score go by 64-bit hashes of
words; the model's keys are their lower 48 bits.

Defined results: a null or blank text is one end token; every row is scored by its
own text, also where rows share a doc_id; with no training texts every word is
unknown; an empty table gives an empty result; further columns are ignored; null
doc_ids are dropped.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import discard, parts, saved, shared_dir, slices, text_of, trim, unshuffled, utf8
from ._vector import LOWER, mix, separators, span_hash, words

BLOCK_BYTES = 8 << 20
#: Tokens in a cell part, and cell parts to a word part.
PART_TOKENS = 1_000_000
WORD_SHARE = 8
ROUNDS = 4
SAMPLES = 2
#: Customers of a cell whose seating is drawn exactly; beyond, sequential seatings of which one is taken.
EXACT = 32
TRIES = 4
END = np.uint64(0x0E4D0E4D0E4D0E4D)
START = np.uint64(0x57A257A257A257A2)
MASK = np.uint64((1 << 48) - 1)
_SPACE = separators("space")
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 10 == 0


def _part_of(keys: np.ndarray, n: int) -> np.ndarray:
    return (mix((keys & MASK) + np.uint64(1)) % np.uint64(n)).astype(np.int64)


def _i8(raw: pa.Scalar | bytes) -> np.ndarray:
    return np.frombuffer(raw if isinstance(raw, bytes) else raw.as_py(), "<i8")


def _u8(raw) -> np.ndarray:
    return np.frombuffer(raw if isinstance(raw, bytes) else raw.as_py(), "<u8")


def _f8(raw) -> np.ndarray:
    return np.frombuffer(raw if isinstance(raw, bytes) else raw.as_py(), "<f8")


def _rows(schema: str, rows: list[tuple]) -> pa.Table:
    """A table of tuples: longs, ints, doubles and binaries by ``schema``."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary(), "boolean": pa.bool_()}
    fields = [x.split() for x in schema.split(", ")]
    return pa.table({name: pa.array([r[k] for r in rows], kinds[kind]) for k, (name, kind) in enumerate(fields)})


# ---- blocks ------------------------------------------------------------------

BLOCK = "docs binary, train binary, first binary, words binary, seq binary"


def _blocks(word_parts: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=BLOCK_BYTES):
            buf, offsets = utf8(batch.column(1))
            buf = LOWER[buf]
            starts, ends, first = words(buf, offsets, _SPACE)
            first = first + np.arange(len(first))
            tokens = np.full(int(first[-1]), END, np.uint64)
            keep = np.ones(len(tokens), bool)
            keep[first[1:] - 1] = False
            tokens[keep] = span_hash(buf, starts, ends)
            names, seq = np.unique(np.append(tokens, START), return_inverse=True)
            order = np.lexsort((names, names & MASK, _part_of(names, word_parts)))
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            train = np.array([not held_out(i) for i in batch.column(0).to_pylist()], bool)
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8")
            yield from _rows(BLOCK, [(ids.tobytes(), train.tobytes(), first.astype("<u4").tobytes(), names[order].tobytes(), place[seq[:-1]].astype("<u4").tobytes())]).to_batches()

    return task


@dataclass
class Block:
    """Texts as sequences of places in ``words``, which are in the order of their word parts; START is one of them."""

    docs: np.ndarray
    train: np.ndarray
    first: np.ndarray
    words: np.ndarray
    seq: np.ndarray

    @classmethod
    def of(cls, row: dict) -> Block:
        return cls(_i8(row["docs"]), np.frombuffer(row["train"], bool), np.frombuffer(row["first"], "<u4").astype(np.int64), _u8(row["words"]), np.frombuffer(row["seq"], "<u4").astype(np.int64))

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.docs)), np.diff(self.first))

    def counts(self) -> np.ndarray:
        """Training tokens of each word; of START, training texts."""
        n = np.bincount(self.seq[self.train[self.owner()]], minlength=len(self.words))
        n[self.words == START] = self.train.sum()
        return n

    def contexts(self) -> np.ndarray:
        out = np.empty(len(self.seq), np.int64)
        out[1:] = self.seq[:-1]
        out[self.first[:-1]] = int(np.flatnonzero(self.words == START)[0])
        return out

    def cells(self, hot: np.ndarray, n_parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Context, word and part of each distinct cell, in the order of parts, and each token's cell."""
        cell, back = np.unique(self.contexts() * len(self.words) + self.seq, return_inverse=True)
        u, w = cell // len(self.words), cell % len(self.words)
        ku, kw = self.words[u] & MASK, self.words[w] & MASK
        part = np.where(np.isin(ku, hot), _part_of(ku ^ mix(kw), n_parts), _part_of(ku, n_parts))
        order = np.argsort(part, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return u[order], w[order], part[order], place[back]


def _each_block(work: Callable[[int, Block], Iterator[pa.RecordBatch]]):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                yield from work(row["block"], Block.of(row))
                del row
                trim()

    return task


def _cuts(part: np.ndarray) -> list[tuple[int, int, int]]:
    """(part, from, to) of ascending parts."""
    if not len(part):
        return []
    at = np.append(0, np.flatnonzero(part[1:] != part[:-1]) + 1)
    return list(zip(part[at].tolist(), at.tolist(), np.append(at[1:], len(part)).tolist(), strict=True))


ASKED = "part int, block long, words binary, n binary"


def _asked_words(word_parts: int, counted: bool):
    def each(block: int, x: Block) -> Iterator[pa.RecordBatch]:
        n = x.counts().astype("<u4") if counted else np.zeros(0, "<u4")
        yield from _rows(ASKED, [(p, block, x.words[a:b].tobytes(), n[a:b].tobytes()) for p, a, b in _cuts(_part_of(x.words, word_parts))]).to_batches()

    return _each_block(each)


# ---- words -------------------------------------------------------------------

#: A word part: words, their training tokens, contexts and followers (kinds of cells), and what the last round made of them.
STATS = ("tokens", "known", "customers", "tables", "ones", "twos", "opened", "waited")
WORDS = "part int, words binary, n binary, follows binary, precedes binary, below binary, above binary, seated binary, " + ", ".join(f"{x} double" for x in STATS)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, held, counts = None, [], []
    for batch in batches:
        for p, _, names, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            part = p
            held.append(_u8(names))
            counts.append(np.frombuffer(n, "<u4"))
    if held:
        names, back = np.unique(np.concatenate(held), return_inverse=True)
        n = np.bincount(back, weights=np.concatenate(counts), minlength=len(names)).astype("<i8")
        order = np.lexsort((names, names & MASK))
        names, n = names[order][n[order] > 0], n[order][n[order] > 0]
        own, none = n[names != START], np.zeros(len(n), "<i8").tobytes()
        yield from _rows(WORDS, [(part, names.tobytes(), n.tobytes(), none, none, none, none, none, float(own.sum()), float(len(own)), *([0.0] * 6))]).to_batches()


@dataclass(frozen=True)
class Totals:
    """What all parts share: known words, the parent's customers and tables, discounts and strengths of both levels."""

    known: int = 0
    customers: float = 0.0
    tables: float = 0.0
    d1: float = 0.5
    d0: float = 0.5
    s1: float = 1.0
    s0: float = 1.0

    def base(self) -> float:
        """The weight of a new table in the parent."""
        return (self.s0 + self.d0 * self.tables) / (self.known + 1)

    def parent(self, above: np.ndarray, seated: np.ndarray) -> np.ndarray:
        """Probabilities of words with so many customers and tables in the parent."""
        return (np.maximum(above - self.d0 * seated, 0) + self.base()) / (self.s0 + max(self.customers, 0))


def _ways(most: int, d: float) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers: how n customers fill t tables, the tables' weights included."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[1, 1] = 0.0
    for n in range(1, most):
        t = np.arange(1, n + 1)
        out[n + 1, 1 : n + 1] = out[n, 1 : n + 1] + np.log(n - d * t)
        out[n + 1, 1:] = np.logaddexp(out[n + 1, 1:], out[n, :-1])
    return out


def seat(n: np.ndarray, fresh: np.ndarray, d: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of cells with ``n`` customers each, drawn with all of them taken out; ``fresh``: the weight of a new table.

    t tables have probability in proportion to fresh ** t times the ways to fill
    them, which is drawn from exactly up to EXACT customers. Beyond, customers sit
    down one after another, TRIES times, and one seating is taken by importance.
    """
    n, fresh = n.astype(np.int64), np.maximum(fresh.astype(float), 1e-300)
    out = np.minimum(n, 1)
    ways = _ways(EXACT, d)
    for k in range(2, EXACT + 1):
        own = np.flatnonzero(n == k)
        for low in range(0, len(own), 1 << 16):
            at = own[low : low + (1 << 16)]
            weight = ways[k, 1 : k + 1] + np.arange(1, k + 1) * np.log(fresh[at])[:, None]
            out[at] = 1 + np.argmax(weight + rng.gumbel(size=weight.shape), axis=1)
    own = np.flatnonzero(n > EXACT)
    own = own[np.argsort(-n[own], kind="stable")]
    out[own] = _in_turn(n[own], fresh[own], d, rng)
    return out


def _in_turn(n: np.ndarray, fresh: np.ndarray, d: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of cells with descending ``n``, customer by customer."""
    best, score = np.ones(len(n), np.int64), np.full(len(n), -np.inf)
    for _ in range(TRIES):
        t, weight, i = np.ones(len(n), np.int64), np.zeros(len(n)), 1
        while (active := int(np.searchsorted(-n, -i, "left"))) > 0:
            step = i // 64 if i >= 128 else 1
            a, now = fresh[:active], t[:active]
            total = a + i - d * now
            take = np.minimum(n[:active] - i, step)
            weight[:active] += take * np.log(total)
            now += (take * a / total + rng.random(active)).astype(np.int64)
            i += step
        better = weight + rng.gumbel(size=len(n))
        won = better > score
        best[won], score[won] = t[won], better[won]
    return np.minimum(best, n)


def _aux(customers: np.ndarray, tables: np.ndarray, d: float, s: float, rng: np.random.Generator) -> tuple[float, float]:
    """Auxiliary draws of restaurants for the strength: Bernoulli successes, and - log of Beta draws, summed."""
    some = customers > 1
    waited = float(-np.log(np.maximum(rng.beta(s + 1, customers[some] - 1), 1e-300)).sum()) if some.any() else 0.0
    t, opened = np.sort(tables)[::-1], 0.0
    for i in range(1, 65):
        k = int(np.searchsorted(-t, -i, "left"))
        if not k:
            break
        opened += rng.binomial(k, s / (s + d * i))
    rest = t[t > 65].astype(float)
    opened += float((s / d * np.log((s / d + rest) / (s / d + 65))).sum())
    return opened, waited


UPDATE = "kind int, part int, a binary, b binary, c binary, d binary"


def _update_words(totals: Totals, seed: int, first: bool):
    """The word part after a round: tables of contexts, the parent's customers and their tables."""

    def task(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _rows(WORDS, [])
        row = left.to_pylist()[0]
        names, n = _u8(row["words"]), _i8(row["n"])
        keys = names & MASK
        more, further = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
        for x in right.to_pylist():
            at = np.searchsorted(keys, _u8(x["a"]))
            np.add.at(more, at, np.frombuffer(x["b"], "<u4"))
            np.add.at(further, at, np.frombuffer(x["c"], "<u4"))
        follows, precedes = (more, further) if first else (_i8(row["follows"]), _i8(row["precedes"]))
        below, above = (follows, precedes) if first else (follows + more, precedes + further)
        rng = np.random.default_rng((seed, row["part"]))
        seated = seat(above, np.full(len(above), totals.base()), totals.d0, rng)
        opened, waited = _aux(n[below > 0], below[below > 0], totals.d1, totals.s1, rng)
        stats = (row["tokens"], row["known"], float(above.sum()), float(seated.sum()), float((above == 1).sum()), float((above == 2).sum()), opened, waited)
        return _rows(WORDS, [(row["part"], row["words"], row["n"], *(x.astype("<i8").tobytes() for x in (follows, precedes, below, above, seated)), *stats)])

    return task


# ---- cells -------------------------------------------------------------------

def _six(keys: np.ndarray) -> bytes:
    """The lower six bytes of every key."""
    return np.ascontiguousarray(keys.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from_six(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").reshape(-1)


PIECE = "part int, block long, contexts binary, runs binary, low binary, high binary, n binary"
CELLS = "part int, blocks binary, sizes binary, contexts binary, runs binary, low binary, high binary, n binary"


def _cell_pieces(hot, n_parts: int):
    def each(block: int, x: Block) -> Iterator[pa.RecordBatch]:
        u, w, part, place = x.cells(hot.value, n_parts)
        n = np.bincount(place[x.train[x.owner()]], minlength=len(u)).astype("<u4")
        kw = x.words[w] & MASK
        low, high = (kw & np.uint64(0xFFFFFFFF)).astype("<u4"), (kw >> np.uint64(32)).astype("<u2")
        out = []
        for p, a, b in _cuts(part):
            at = np.append(0, np.flatnonzero(u[a + 1 : b] != u[a : b - 1]) + 1)
            runs = np.diff(np.append(at, b - a)).astype("<u4")
            out.append((p, block, _six(x.words[u[a:b][at]]), runs.tobytes(), low[a:b].tobytes(), high[a:b].tobytes(), n[a:b].tobytes()))
        yield from _rows(PIECE, out).to_batches()

    return _each_block(each)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for a part, its pieces one after the other."""
    part, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            part = row[0]
            held.append(row[1:])
    if held:
        held.sort()
        blocks, sizes = np.array([r[0] for r in held], "<i8"), np.array([len(r[3]) // 4 for r in held], "<u4")
        yield from _rows(CELLS, [(part, blocks.tobytes(), sizes.tobytes(), *(b"".join(r[k] for r in held) for k in range(1, 6)))]).to_batches()


@dataclass
class Part:
    """Distinct cells of a part in one order, with their training counts; ``back``: the cell of each asked one."""

    ku: np.ndarray
    kw: np.ndarray
    n: np.ndarray
    back: np.ndarray
    blocks: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, row: dict) -> Part:
        ku = np.repeat(_from_six(row["contexts"]), np.frombuffer(row["runs"], "<u4"))
        kw = np.frombuffer(row["low"], "<u4").astype(np.uint64) | (np.frombuffer(row["high"], "<u2").astype(np.uint64) << np.uint64(32))
        _, at, back = np.unique(mix(mix(ku) + kw), return_index=True, return_inverse=True)
        n = np.bincount(back, weights=np.frombuffer(row["n"], "<u4"), minlength=len(at)).astype(np.int64)
        return cls(ku[at], kw[at], n, back, _i8(row["blocks"]), np.frombuffer(row["sizes"], "<u4").astype(np.int64))


def _kinds(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(keys, return_counts=True)


def _both(u: np.ndarray, v: np.ndarray, cu: np.ndarray, cv: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of either, with the count of each side."""
    keys, back = np.unique(np.append(u, v), return_inverse=True)
    return keys, np.bincount(back[: len(u)], weights=cu, minlength=len(keys)).astype("<u4"), np.bincount(back[len(u) :], weights=cv, minlength=len(keys)).astype("<u4")


def _by_word_part(keys: np.ndarray, x: np.ndarray, y: np.ndarray, n: int) -> list[tuple]:
    where = _part_of(keys, n)
    order = np.argsort(where, kind="stable")
    keys, x, y = keys[order], x[order], y[order]
    return [(1, p, keys[a:b].tobytes(), x[a:b].tobytes(), y[a:b].tobytes(), b"") for p, a, b in _cuts(where[order])]


def _first_look(word_parts: int):
    """Kind 0: a part's cells of two or more customers, as places in a list of keys. Kind 1: kinds of cells by context and by word. Kind 2: cells of one, and of two."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                x = Part.of(row)
                some = x.n > 0
                (u, cu), (w, cw) = _kinds(x.ku[some]), _kinds(x.kw[some])
                out = _by_word_part(*_both(u, w, cu, cw), word_parts)
                many = x.n > 1
                ku, kw = x.ku[many], x.kw[many]
                keys = np.unique(np.append(ku, kw))
                keys = keys[np.argsort(_part_of(keys, word_parts), kind="stable")]
                rank = np.argsort(keys)
                place = [rank[np.searchsorted(keys[rank], k)].astype("<u4").tobytes() for k in (ku, kw)] if len(keys) else [b"", b""]
                out.append((2, row["part"], np.array([(x.n == 1).sum(), (x.n == 2).sum()], "<f8").tobytes(), b"", b"", b""))
                out.append((0, row["part"], keys.tobytes(), *place, x.n[many].astype("<u4").tobytes()))
                yield from _rows(UPDATE, out).to_batches()
                del row, x
                trim()

    return task


def _pairs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([_f8(x) for x in batch.column("a")]).reshape(-1, 2)
        yield pa.record_batch([pa.array(found[:, 0]), pa.array(found[:, 1])], ["ones", "twos"])


NEED = "part int, shard int, keys binary"


def _needs(word_parts: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, raw in zip(batch.column("part").to_pylist(), batch.column("a"), strict=True):
                keys = _u8(raw)
                yield from _rows(NEED, [(p, shard, keys[a:b].tobytes()) for p, a, b in _cuts(_part_of(keys, word_parts))]).to_batches()

    return task


TOLD = "shard int, part int, tables binary, p binary"


def _tell(totals: Totals):
    def task(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _rows(TOLD, [])
        row = right.to_pylist()[0]
        keys, below = _u8(row["words"]) & MASK, _i8(row["below"])
        p = totals.parent(_i8(row["above"]), _i8(row["seated"]))
        out = []
        for x in left.to_pylist():
            at = np.searchsorted(keys, _u8(x["keys"]))
            out.append((x["shard"], x["part"], below[at].astype("<f8").tobytes(), p[at].astype("<f8").tobytes()))
        return _rows(TOLD, out)

    return task


def _reseat(totals: Totals, seed: int, word_parts: int):
    """Kind 0: tables of a part's cells. Kind 1: tables beyond the first, by context and by word."""

    def task(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _rows(UPDATE, [])
        row, told = left.to_pylist()[0], sorted(right.to_pylist(), key=lambda x: x["part"])
        keys, n = _u8(row["a"]), np.frombuffer(row["d"], "<u4").astype(np.int64)
        u, w = (np.frombuffer(row[c], "<u4").astype(np.int64) for c in "bc")
        tables, p = (np.concatenate([_f8(x[c]) for x in told]) for c in ("tables", "p"))
        t = seat(n, (totals.s1 + totals.d1 * tables[u]) * p[w], totals.d1, np.random.default_rng((seed, 1, row["part"])))
        out: list[tuple] = [(0, row["part"], t.astype("<u4").tobytes(), b"", b"", b"")]
        more = [np.bincount(x, weights=t - 1, minlength=len(keys)).astype("<u4") for x in (u, w)]
        some = (more[0] > 0) | (more[1] > 0)
        out += _by_word_part(keys[some], more[0][some], more[1][some], word_parts)
        return _rows(UPDATE, out)

    return task


# ---- scores ------------------------------------------------------------------

ANSWER = "block long, kind int, part int, a binary, b binary, c binary"


def _cell_shares(d1: float):
    """For every block, customers less discounts of its cells, averaged over the samples."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                x = Part.of(row)
                tables = (x.n > 0).astype(float)
                if row["seatings"]:
                    tables[x.n > 1] = np.mean([np.frombuffer(t, "<u4") for t in row["seatings"]], axis=0)
                share = (x.n - d1 * tables).astype("<f4")[x.back]
                cut = np.append(0, np.cumsum(x.sizes))
                yield from _rows(ANSWER, [(b, 0, row["part"], share[cut[k] : cut[k + 1]].tobytes(), b"", b"") for k, b in enumerate(x.blocks.tolist())]).to_batches()
                del row, x
                trim()

    return task


def _word_answers(samples: list[Totals]):
    """For every block, its words' training tokens, tables as contexts, and probabilities in the parent, by sample."""

    def task(left: pa.Table, right: pa.Table) -> pa.Table:
        rounds = [x for x in sorted(right.to_pylist(), key=lambda x: x["round"]) if x["words"]]
        keys = _u8(rounds[0]["words"]) if rounds else np.zeros(0, np.uint64)
        known = keys & MASK
        out = []
        for x in left.to_pylist():
            asked = _u8(x["words"])
            key = asked & MASK
            at = np.minimum(np.searchsorted(known, key), max(len(known) - 1, 0))
            while len(known):  # words that share a key stand together
                go = (at + 1 < len(known)) & (known[at] == key) & (keys[at] != asked)
                go[go] = known[at[go] + 1] == key[go]
                if not go.any():
                    break
                at[go] += 1
            hit = keys[at] == asked if len(keys) else np.zeros(len(asked), bool)
            n = np.where(hit, _i8(rounds[0]["n"])[at], 0) if rounds else np.zeros(len(asked), np.int64)
            tables, p = [], []
            for s, row in zip(samples, rounds or [None] * len(samples), strict=True):
                below, above, seated = (np.where(hit, _i8(row[c])[at], 0) for c in ("below", "above", "seated")) if row else [np.zeros(len(asked), np.int64)] * 3
                tables.append(below.astype("<f8").tobytes())
                p.append(s.parent(above, seated).astype("<f8").tobytes())
            out.append((x["block"], 1, x["part"], n.astype("<i8").tobytes(), b"".join(tables), b"".join(p)))
        return _rows(ANSWER, out)

    return task


def predictive(share: np.ndarray, context: np.ndarray, word: np.ndarray, n: np.ndarray, tables: np.ndarray, p: np.ndarray, s1: float, d1: float) -> np.ndarray:
    """Averaged probabilities of tokens: their cells' ``share``, and by word its customers as a context, tables and parent probability (samples x words)."""
    backed = np.mean([(s1 + d1 * tables[s][context]) * p[s][word] for s in range(len(p))], axis=0)
    return (share + backed) / (s1 + n[context])


def _score(totals: Totals, n_samples: int, n_train: int, hot, n_parts: int):
    def task(left: pa.Table, right: pa.Table) -> pa.Table:
        x = Block.of(left.to_pylist()[0])
        told = sorted(right.to_pylist(), key=lambda r: (r["kind"], r["part"]))
        share = np.concatenate([np.frombuffer(r["a"], "<f4") for r in told if r["kind"] == 0]).astype(float)
        by_word = [r for r in told if r["kind"] == 1]
        n = np.concatenate([_i8(r["a"]) for r in by_word])
        tables, p = (np.concatenate([_f8(r[c]).reshape(n_samples, -1) for r in by_word], axis=1) for c in "bc")
        place = x.cells(hot.value, n_parts)[3]
        probability = predictive(share[place], x.contexts(), x.seq, n, tables, p, totals.s1, totals.d1)
        base = np.log10((n + 0.1) / (n_train + 0.1 * (totals.known + 1)))
        owner = x.owner()
        sums = [np.bincount(owner, weights=v, minlength=len(x.docs)) for v in ((n > 0)[x.seq], base[x.seq], np.log10(probability))]
        names = [f.split()[0] for f in RESULT.split(", ")]
        return pa.table(dict(zip(names, (pa.array(x.docs), pa.array(~x.train), pa.array(np.diff(x.first)), pa.array(sums[0].astype(np.int64)), pa.array(np.full(len(x.docs), n_train)), pa.array(sums[1]), pa.array(sums[2])), strict=True)))

    return task


def _beta(rng: np.random.Generator, ones: float, twos: float) -> float:
    return float(np.clip(rng.beta(1 + ones, 1 + 2 * twos), 0.05, 0.95))


def _bucketed(df: DataFrame, path: str, column: str, names: list[str]) -> DataFrame:
    """Written in buckets, so that joins on ``column`` don't move it again; the table's name goes to ``names``, to be dropped in the end."""
    names.append(f"quire_lm_{uuid.uuid4().hex}")
    with unshuffled(df.sparkSession):
        df.write.bucketBy(parts(df.sparkSession), column).format("parquet").option("path", path).option("compression", "zstd").saveAsTable(names[-1])
    return df.sparkSession.table(names[-1])


def score(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", part_tokens: int = PART_TOKENS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    spark = documents.sparkSession
    work = shared_dir(spark, "lm")
    docs = text_of(documents, id_column, text_column).where("doc_id is not null")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_parts = int(size // 6 // part_tokens) + 1  # about six bytes of text to a token
    word_parts = n_parts // WORD_SHARE + 1
    names: list[str] = []
    try:
        blocks = docs.mapInArrow(_blocks(word_parts), BLOCK).withColumn("block", F.monotonically_increasing_id())
        blocks = _bucketed(blocks, f"{work}/blocks", "block", names)
        return saved(_fit_and_score(blocks, work, n_parts, word_parts, names), f"{work}/scores")
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def _fit_and_score(blocks: DataFrame, work: str, n_parts: int, word_parts: int, names: list[str]) -> DataFrame:
    spark = blocks.sparkSession

    def dealt(df: DataFrame, n: int) -> DataFrame:
        return df.repartitionById(n, F.col("part"))

    state = saved(dealt(blocks.mapInArrow(_asked_words(word_parts, True), ASKED), word_parts).mapInArrow(_count_words, WORDS), f"{work}/words", compression="zstd")
    tokens, known = state.agg(F.coalesce(F.sum("tokens"), F.lit(0.0)), F.coalesce(F.sum("known"), F.lit(0.0))).first()
    limit = max(1.0, tokens / n_parts / 4)

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for names, n in zip(batch.column(0), batch.column(1), strict=True):
                yield pa.record_batch([pa.array((_u8(names) & MASK)[_i8(n) > limit].view(np.int64))], ["key"])

    # At most 4 * n_parts words have more than a quarter of a part's tokens each.
    hot = np.sort(np.array([r[0] for r in state.select("words", "n").mapInArrow(frequent, "key long").collect()], np.int64).view(np.uint64))
    held = spark.sparkContext.broadcast(hot)
    cells = _bucketed(dealt(blocks.mapInArrow(_cell_pieces(held, n_parts), PIECE), n_parts).mapInArrow(_pack, CELLS), f"{work}/cells", "part", names)
    looked = saved(cells.mapInArrow(_first_look(word_parts), UPDATE), f"{work}/first", compression="zstd")
    multi = saved(looked.where("kind = 0"), f"{work}/multi", compression="zstd")
    totals, rng = Totals(known=int(known)), np.random.default_rng(9)
    ones, twos = (x or 0.0 for x in looked.where("kind = 2").mapInArrow(_pairs_of, "ones double, twos double").agg(F.sum("ones"), F.sum("twos")).first())
    totals = replace(totals, d1=_beta(rng, ones, twos))
    updates, kept, seatings = looked.where("kind = 1"), [], None
    for k in range(ROUNDS + 1):
        update = _update_words(totals, k, first=k == 0)
        state = saved(state.groupBy("part").cogroup(updates.groupBy("part")).applyInArrow(update, WORDS), f"{work}/words{k}", compression="zstd")
        # Read for the last time: the state before, and what this one was made from, but for the sampled seatings.
        old = [f"{work}/words{k - 1}"] if k and k - 1 <= ROUNDS - SAMPLES else [f"{work}/words"] if not k else []
        discard(spark, *old, *([f"{work}/first"] if not k else [f"{work}/round{k - 1}"] if k - 1 < ROUNDS - SAMPLES else []))
        sums = {c: x or 0.0 for c, x in zip(STATS, state.agg(*(F.sum(c) for c in STATS)).first(), strict=True)}
        totals = replace(totals, customers=sums["customers"], tables=sums["tables"])
        if k <= ROUNDS - SAMPLES:  # drawn anew while burning in
            totals = replace(
                totals, d1=_beta(rng, ones, twos), d0=_beta(rng, sums["ones"], sums["twos"]),
                s1=float(rng.gamma(1 + round(sums["opened"], 3), 1 / (1 + round(sums["waited"], 3)))) + 1e-3,
            )
            opened, waited = _aux(np.array([totals.customers]), np.array([totals.tables]), totals.d0, totals.s0, rng)
            totals = replace(totals, s0=float(rng.gamma(1 + opened, 1 / (1 + waited))) + 1e-3)
        if k > ROUNDS - SAMPLES:
            kept.append((k, totals, state))
        if k < ROUNDS:
            told = multi.mapInArrow(_needs(word_parts), NEED).groupBy("part").cogroup(state.groupBy("part")).applyInArrow(_tell(totals), TOLD)
            seated = saved(multi.groupBy("part").cogroup(told.groupBy("shard")).applyInArrow(_reseat(totals, k, word_parts), UPDATE), f"{work}/round{k}", compression="zstd")
            updates = seated.where("kind = 1")
            if k >= ROUNDS - SAMPLES:
                own = seated.where("kind = 0").select("part", F.col("a").alias("t"))
                seatings = own if seatings is None else seatings.unionByName(own)
    shares = cells.join(seatings.groupBy("part").agg(F.collect_list("t").alias("seatings")), "part", "left").mapInArrow(_cell_shares(totals.d1), ANSWER)
    rounds = None
    for k, _, one in kept:
        one = one.select("part", F.lit(k).alias("round"), "words", "n", "below", "above", "seated")
        rounds = one if rounds is None else rounds.unionByName(one)
    asked = blocks.mapInArrow(_asked_words(word_parts, False), ASKED)
    answers = shares.unionByName(asked.groupBy("part").cogroup(rounds.groupBy("part")).applyInArrow(_word_answers([t for _, t, _ in kept]), ANSWER))
    answers = saved(answers, f"{work}/answers", compression="zstd")
    discard(spark, f"{work}/cells", f"{work}/multi")
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_score(totals, len(kept), int(tokens), held, n_parts), RESULT)
