"""Suffix-array dedup: bytes covered by a long string that starts more than once are removed.

Texts are cut into window blocks by minimisers (``_repeats``): windows that share
the smallest hash of a 32-byte gram, the key, at one place. A window reaches at
least ``half = (width - 32) // 2`` bytes beyond its key's gram on one side, so
equal windows agree in the key and in the ``half`` bytes on its left, or in those
on its right. Blocks are dealt by (key, side, hash of those bytes). What stands
alone there cannot be repeated and goes no further. Blocks that occur twice in
whole are repeated in whole; one copy of each of them, and all others, are dealt
to shards of a bounded size. Bunches of few blocks that stand in one stretch of
a row go to one shard, where blocks of a row that share bytes are one text; blocks
alone would bring each byte some five times. Each shard gets a generalised suffix
array by linear grouping construction (``suffix_array``):

* groups of suffixes with one Lyndon prefix are processed in descending order;
  previous-smaller pointers tell which earlier suffixes a group extends;
* the groups' order within is then emitted in one ascending pass over next
  smaller suffixes, without recursive renaming.

The array is sparse: suffixes start at symbol boundaries (after white space, or
anywhere after 32 bytes without it), which only the 32 bytes before a place
decide, so equal windows have equal boundaries from their 32nd byte on. A window
is repeated if, at its first such boundary, another suffix of the same interval
of common prefixes has the same bytes before it.

More than ``HOT`` unlike blocks that share a key and a side (over 200 bytes)
would be one long task; their windows are grouped exactly by hash over all tasks
instead. Where two widths are asked for, the rows that hold such blocks are taken
once more, for each width by itself: equal windows of a bunch stand in these rows.

``remove_repeated`` also reports ``n_shared``: bytes covered by a string of
``SHARED`` bytes that also starts in another row. It finds passages of some fifty
words that are too short for the removal. It removes nothing. Both are found in one
pass: a repeated string begins with a repeated string of the shorter width, so the
blocks are those of the shorter width, their contents go on as far as the longer
strings that start in them, and one suffix array tells the windows of both widths.

Defined results: a null text is empty; texts shorter than a window lose nothing;
equal rows repeat each other (also under one doc_id) and get equal results, but
share nothing with each other; unlike rows with one doc_id, and rows with a null
doc_id, are texts like any other; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import binary, discard, on_row, rows_of, saved, shared_dir, slices, utf8
from ._repeats import blocks, merged
from ._vector import Spans, mix, separators, span_hash

WIDTH = 400
#: Width of the strings that n_shared counts: fifty words, and short ones, of most languages.
SHARED = 288
GRAM = 32
#: Bytes without white space after which every byte starts a symbol.
REACH = 32
SHARD_BYTES = 1 << 20
HOT = 1500
#: Bunches of at most so many blocks go to a shard by the stretch of a row they stand in.
FEW = 64
STRETCH = 1 << 11
_SPACE = separators("space")


def suffix_array(symbols: list[int]) -> list[int]:
    """Suffixes of ``symbols`` (non-negative) in ascending order, by grouping Lyndon prefixes.

    The end of the text counts as a symbol smaller than all others.
    """
    n = len(symbols)
    values = np.asarray([*symbols, -1], np.int64)
    order = np.argsort(values, kind="stable")
    cut = np.flatnonzero(np.append(True, np.diff(values[order]) != 0))
    listed, edges = order.tolist(), [*cut.tolist(), n + 1]
    members: list[list[int]] = [listed[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
    length = [1] * len(members)  # of the prefix that a group's suffixes share
    under = list(range(-1, len(members) - 1))  # the next lower group
    above = [*range(1, len(members)), -1]
    label = np.empty(n + 1, np.int64)
    label[order] = np.repeat(np.arange(len(members)), np.diff(np.append(cut, n + 1)))
    group: list[int] = label.tolist()
    left = list(range(-1, n))  # towards the nearest earlier suffix of a lower group
    alive = [True] * (n + 1)  # not yet in a processed group
    count = [len(m) for m in members]
    descending: list[int] = []
    g = len(members) - 1
    while g >= 0:
        own = members[g] = [i for i in members[g] if group[i] == g]
        descending.append(g)
        for i in own:
            alive[i] = False
        times: dict[int, int] = {}  # how often the group follows a lower one's prefix
        for i in own:
            j = left[i]
            while j >= 0 and not alive[j]:
                up = left[j]
                if up >= 0 and not alive[up]:
                    up = left[j] = left[up]
                j = up
            left[i] = j
            if j >= 0:
                times[j] = times.get(j, 0) + 1
        size = length[g]
        if len(times) == 1:
            ((j, k),) = times.items()
            parted = [((group[j], k), [j])]
        else:
            split: dict[tuple[int, int], list[int]] = {}
            for j, k in times.items():
                split.setdefault((group[j], k), []).append(j)
            parted = sorted(split.items()) if len(split) > 1 else split.items()
        last = -1
        for (old, k), moved in parted:  # right above the group they leave, by the count
            if old != last:
                last = low = old
                if count[old] == len(moved):  # all of it goes on together
                    length[old] += k * size
                    continue
            new, high = len(members), above[low]
            members.append(moved)
            count.append(len(moved))
            count[old] -= len(moved)
            length.append(length[old] + k * size)
            for j in moved:
                group[j] = new
            under.append(low)
            above.append(high)
            above[low] = under[high] = low = new
        g = under[g]
    # Each group's first free place, then one ascending pass over next smaller suffixes.
    place, at = [0] * len(members), 0
    for g in reversed(descending):
        place[g] = at
        at += len(members[g])
    smaller = np.arange(n + 1) + np.asarray(length)[np.asarray(group)]
    by = np.argsort(smaller, kind="stable")
    begin = np.searchsorted(smaller[by], np.arange(n + 2)).tolist()
    children = by.tolist()
    out = [-1] * (n + 1)
    out[0] = n
    for r in range(n + 1):
        i = out[r]
        for j in children[begin[i] : begin[i + 1]]:
            g = group[j]
            out[place[g]] = j
            place[g] += 1
    return out[1:]


def _boundaries(buf: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Starts of symbols. Apart from the first places of a text (``edges``), a place's last REACH bytes decide."""
    blank = _SPACE[buf]
    seen = np.where(blank, np.arange(len(buf)), -1)
    last = np.maximum.accumulate(seen)  # the last white space up to each byte
    at = np.zeros(len(buf), bool)
    at[1:] = blank[:-1] | (np.arange(1, len(buf)) - last[:-1] > REACH)
    at[edges] = True
    return np.flatnonzero(at)


def repeated_windows(texts: list[bytes], width: int = WIDTH, owners: np.ndarray | None = None, wanted: np.ndarray | None = None) -> list[np.ndarray]:
    """For every text the starts of windows that also start elsewhere in these texts, with ``owners`` in a text of another owner.

    ``wanted`` marks the bytes of all texts, end to end, at which a window may start.
    """
    return repeated_of_widths(texts, [(width, owners)], wanted)[0]


def repeated_of_widths(texts: list[bytes], asked: list[tuple[int, np.ndarray | None]], wanted: np.ndarray | None = None) -> list[list[np.ndarray]]:
    """``repeated_windows`` for several (width, owners), by one suffix array."""
    width, most = min(w for w, _ in asked), max(w for w, _ in asked)
    need = width - 2 * REACH - 1  # of common prefix at a window's first usable boundary, at least
    size = np.array([len(t) for t in texts], np.int64)
    stop = np.cumsum(size)
    buf = np.frombuffer(b"".join(texts), np.uint8)
    if len(buf) <= width:
        return [[np.zeros(0, np.int64) for _ in texts] for _ in asked]
    starts = _boundaries(buf, (stop - size)[size > 0])
    ends = np.append(starts[1:], len(buf))
    owner = np.searchsorted(stop, starts, "right")
    # Symbols as ranks in byte order.
    raw = buf.tobytes()
    spelled = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    rank = {x: k + 1 for k, x in enumerate(sorted(set(spelled)))}
    symbol = np.fromiter(map(rank.__getitem__, spelled), np.int64, len(spelled))
    keep = _possible(symbol, ends - starts, owner, width)
    # A kept run goes with the symbol after it, which may be repeated in part; then one below all others.
    tail = np.zeros(len(keep), bool)
    tail[1:] = keep[:-1] & ~keep[1:] & (owner[1:] == owner[:-1])
    own = np.flatnonzero(keep | tail)
    if not len(own):
        return [[np.zeros(0, np.int64) for _ in texts] for _ in asked]
    gap = np.flatnonzero((own[1:] != own[:-1] + 1) | (owner[own][1:] != owner[own][:-1]) | tail[own][:-1]) + 1
    position = np.insert(starts[own], gap, -1)
    suffixes = position[np.asarray(suffix_array(np.insert(symbol[own], gap, 0).tolist()), np.int64)]
    suffixes = suffixes[suffixes >= 0]
    limit = stop[np.searchsorted(stop, suffixes, "right")]
    span = Spans(buf).alike
    common = _common_prefix(span, suffixes, limit, need, most)  # with the suffix before it; 0 for the first
    longest = np.maximum(common, np.append(common[1:], 0))
    before = np.zeros(len(buf) + 1, np.int64)
    before[starts[1:]] = np.where(owner[1:] == owner[:-1], starts[1:] - starts[:-1], 0)
    out = []
    for width, owners in asked:
        whose = None if owners is None else np.asarray(owners, np.int64)
        near = np.flatnonzero(longest >= width - 2 * REACH - 1)
        text = np.searchsorted(stop, suffixes[near], "right")
        reach, begins, room = before[suffixes[near]], suffixes[near] - (stop - size)[text], limit[near] - suffixes[near]
        hits = []
        for d in range(REACH, 2 * REACH + 2):
            rest = width - d
            own = np.flatnonzero((begins >= d) & (room >= rest) & (reach > d - REACH) & (longest[near] >= rest))
            if wanted is not None:
                own = own[wanted[suffixes[near[own]] - d]]
            if not len(own):
                continue
            interval = np.cumsum(common < rest)[near[own]]
            at = suffixes[near[own]] - d
            key = mix(mix(span(at, d)) + interval.astype(np.uint64))
            order = np.argsort(key) if whose is None else np.lexsort((whose[text[own]], key))
            sorted_ = key[order]
            first = np.append(0, np.flatnonzero(sorted_[1:] != sorted_[:-1]) + 1)
            last = np.append(first[1:], len(order)) - 1
            again = first < last if whose is None else whose[text[own[order[first]]]] != whose[text[own[order[last]]]]
            hits.append(at[order[np.repeat(again, last - first + 1)]])
        found = np.sort(np.concatenate(hits)) if hits else np.zeros(0, np.int64)
        cuts = np.searchsorted(found, np.append(stop - size, len(buf)))
        out.append([found[a:b] - base for a, b, base in zip(cuts[:-1], cuts[1:], stop - size, strict=True)])
    return out


def _possible(symbol: np.ndarray, size: np.ndarray, owner: np.ndarray, width: int) -> np.ndarray:
    """Symbols that a repeated window may hold: all runs of ``run`` symbols within such a window occur twice or more.

    Stretches of them that are too short for a window, even with parts of the
    symbols next to them, go as well; that makes more runs single, and so on.
    """
    n, run = len(symbol), min(8, max(1, (width - 2 * REACH - 2) // (REACH + 1)))  # at least so many symbols lie in a window in whole
    if n < run:
        return np.zeros(n, bool)
    gram = symbol.astype(np.uint64)
    for k in range(1, run):
        gram = mix(gram[: n - run + 1] * np.uint64(0x9E3779B97F4A7C15) + symbol[k : n - run + 1 + k].astype(np.uint64))
    _, name = np.unique(gram, return_inverse=True)
    inside = owner[: n - run + 1] == owner[run - 1 :]
    total = np.append(0, np.cumsum(size))
    begins = np.searchsorted(owner, owner, "left")
    ends = np.searchsorted(owner, owner, "right")
    keep = np.ones(n, bool)
    while True:
        held = np.append(0, np.cumsum(keep))
        live = inside & (held[run:] - held[:-run] == run)
        count = np.bincount(name[live], minlength=int(name.max()) + 1)
        good = live & (count[name] > 1)
        edge = np.diff(np.concatenate([[0], good.astype(np.int8), [0]]))
        # A step between texts ends a stretch too: runs do not reach over it, so it shows as run - 1 places that are not good.
        a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + run - 1
        if run == 1 and len(a):
            step = np.flatnonzero(good[1:] & good[:-1] & (owner[1:] != owner[:-1])) + 1
            a, b = np.sort(np.append(a, step)), np.sort(np.append(b, step))
        room = total[b] - total[a]
        before, after = np.maximum(a - 1, 0), np.minimum(b, n - 1)
        room += np.where(a > begins[np.minimum(a, n - 1)], size[before], 0) + np.where(b < ends[np.minimum(a, n - 1)], size[after], 0)
        wide = room + 2 * REACH + 2 >= width
        now = np.zeros(n + 1, np.int64)
        np.add.at(now, a[wide], 1)
        np.add.at(now, b[wide], -1)
        now = np.cumsum(now[:-1]) > 0
        if (now == keep).all():
            return keep
        keep = now


def _common_prefix(span: Callable[..., np.ndarray], suffixes: np.ndarray, limit: np.ndarray, least: int, most: int) -> np.ndarray:
    """Length of the common prefix, up to ``most`` bytes, of each suffix with the one before it; 0 if under ``least``."""
    out = np.zeros(len(suffixes), np.int64)
    room = np.minimum(most, limit - suffixes)
    own = 1 + np.flatnonzero(np.minimum(room[1:], room[:-1]) >= least)
    own = own[span(suffixes[own - 1], least) == span(suffixes[own], least)]
    one, two = suffixes[own - 1], suffixes[own]
    low, high = np.full(len(own), least), np.minimum(room[own], room[own - 1])
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            break
        middle = (low[open_] + high[open_] + 1) // 2
        same = span(one[open_], middle) == span(two[open_], middle)
        low[open_[same]] = middle[same]
        high[open_[~same]] = middle[~same] - 1
    out[own] = low
    return out


def _find(width: int, gram: int, longer: int):
    half = (width - gram) // 2

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            buf, offsets = utf8(batch.column(1))
            out, names = [], []
            for found in blocks(buf, offsets, width, gram, longer):
                sides = []
                for low, high, whole in (
                    (found.gram - half, found.gram + gram, found.gram - found.start >= half),
                    (found.gram, found.gram + gram + half, found.gram + gram + half <= found.start + found.size + width - 1),
                ):
                    own = np.flatnonzero(whole)
                    side = np.zeros(len(whole), np.int64)
                    side[own] = found.spans.hash(low[own] - found.low, gram + half).view(np.int64) >> 32
                    sides.append(pa.array(side.astype(np.int32), mask=~whole))
                rows, wide = pa.array(found.doc), np.clip(offsets[found.doc + 1] - found.start - longer + 1, 0, found.size)
                out.append([batch.column(0).take(rows), batch.column(2).take(rows), pa.array(found.at, pa.int64()), pa.array(found.size, pa.int32()), pa.array(wide, pa.int32()), pa.array(found.gram - found.start, pa.int32()), pa.array(found.key.view(np.int64)), pa.array(found.content.view(np.int64)), *sides])
                names.append((found.doc, found.content))
            if not out:
                continue
            # Blocks that their own row holds again.
            doc, content = (np.concatenate(x) for x in zip(*names, strict=True))
            order = np.lexsort((content, doc))
            same = (doc[order][1:] == doc[order][:-1]) & (content[order][1:] == content[order][:-1])
            within = np.zeros(len(doc), bool)
            within[order[1:][same]] = within[order[:-1][same]] = True
            ends = np.cumsum([len(d) for d, _ in names])
            for columns, end in zip(out, ends.tolist(), strict=True):
                yield pa.record_batch([*columns, pa.array(within[end - len(columns[0]) : end])], ["doc_id", "row", "at", "size", "wide", "gram", "key", "content", "left", "right", "within"])

    return task


_CUT = ["place", "size", "bunch", "once", "hot", "owner"]
CUT = "doc_id long, row long, place long, size int, bunch long, once boolean, hot boolean, owner long, bytes binary"


def _listed(column: pa.Array) -> tuple[np.ndarray, list[pa.Array]]:
    """The structs of a column of lists in a row: the row each stands in, and their fields."""
    counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(column)), counts), column.flatten().flatten()


def _cut(width: int):
    """The bytes of the blocks that are wanted of each text, as far as windows of ``width`` reach."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            buf, offsets = utf8(batch.column(1))
            raw = buf.tobytes()
            doc, fields = _listed(batch.column(3))
            rows = pa.array(doc, pa.int64())
            begin = offsets[doc] + fields[0].to_numpy()
            end = np.minimum(begin + fields[1].to_numpy() + width - 1, offsets[doc + 1])
            yield pa.record_batch(
                [batch.column(0).take(rows), batch.column(2).take(rows), *fields, binary([raw[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)])],
                ["doc_id", "row", *_CUT, "bytes"],
            )

    return task


RANGES = "doc_id long, row long, low long, high long, longer boolean"


def _runs(table: pa.Table, apart: bool) -> tuple[list[bytes], np.ndarray, list[int], np.ndarray]:
    """Blocks of one row (with ``apart`` of one owner) that share bytes as one text.

    Gives the texts, the bytes at which their blocks' windows start, a block of
    each (one that stands once, if there is any), and where the texts begin in their rows.
    """
    place, size, row, owner, once = (table[c].to_numpy() for c in ("place", "size", "row", "owner", "once"))
    ids = table["doc_id"].fill_null(0).to_numpy()
    order = np.lexsort((place, owner, row, ids) if apart else (place, row, ids))
    keys = [k[order] for k in ((row, owner, ids) if apart else (row, ids))]
    begin = place[order]
    end = begin + pc.binary_length(table["bytes"]).to_numpy()[order]
    new = np.ones(len(order), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    group = np.cumsum(new) - 1
    head = np.flatnonzero(new)
    far = np.empty(len(order), np.int64)
    for a, b in zip(head.tolist(), [*head[1:].tolist(), len(order)], strict=True):
        far[a:b] = np.maximum.accumulate(end[a:b])
    new[1:] |= (group[1:] == group[:-1]) & (begin[1:] >= far[:-1])
    raw = table["bytes"].to_pylist()
    cuts = [*np.flatnonzero(new).tolist(), len(order)]
    texts, wanted, named = [], [], []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        pieces, to = [], int(begin[a])
        for k in range(a, b):
            if end[k] > to:
                pieces.append(raw[order[k]][to - int(begin[k]) :])
                to = int(end[k])
        texts.append(b"".join(pieces))
        starts = np.zeros(to - int(begin[a]) + 1, np.int64)
        np.add.at(starts, begin[a:b] - begin[a], 1)
        np.add.at(starts, begin[a:b] - begin[a] + size[order[a:b]], -1)
        wanted.append(np.cumsum(starts[:-1]) > 0)
        named.append(int(order[a + int(np.argmax(once[order[a:b]]))]))
    return texts, np.concatenate(wanted), named, begin[cuts[:-1]]


def _sort_shard(width: int, apart: bool, longer: int | None = None):
    def task(table: pa.Table) -> pa.Table:
        texts, wanted, named, places = _runs(table, apart)
        rows = np.array(named, np.int64)
        owners = table["owner"].to_numpy()[rows] if apart else None
        both = repeated_of_widths(texts, [(width, owners), (longer, None)], wanted) if longer else [repeated_windows(texts, width, owners, wanted)]
        once = table["once"].to_numpy()[rows]
        at, low, high, which = [], [], [], []
        for kind, found in enumerate(both):
            for k, (place, starts) in enumerate(zip(places.tolist(), found, strict=True)):
                if once[k] and len(starts):
                    a, b = merged(starts, starts + (longer if kind else width))
                    at += [named[k]] * len(a)
                    low += (a + place).tolist()
                    high += (b + place).tolist()
                    which += [kind == 1] * len(a)
        rows = pa.array(at, pa.int64())
        return pa.table({"doc_id": table["doc_id"].take(rows), "row": table["row"].take(rows), "low": pa.array(low, pa.int64()), "high": pa.array(high, pa.int64()), "longer": pa.array(which, pa.bool_())})

    return task


def _hash_windows(width: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "bytes", 1 << 16):
            buf, offsets = utf8(batch.column(8).cast(pa.large_binary()).view(pa.large_string()))
            size = np.maximum(np.diff(offsets) - width + 1, 0)
            row = np.repeat(np.arange(len(size)), size)
            step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            at, rows = offsets[:-1][row] + step, pa.array(row)
            yield pa.record_batch(
                [*(batch.column(k).take(rows) for k in (0, 1)), pa.array(batch.column(2).to_numpy()[row] + step, pa.int64()), batch.column(4).take(rows), pa.array(span_hash(buf, at, at + width).view(np.int64)), batch.column(5).take(rows), batch.column(7).take(rows)],
                ["doc_id", "row", "at", "bunch", "window", "once", "owner"],
            )

    return task


def covered_ranges(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = WIDTH, apart: bool = False, shard_bytes: int = SHARD_BYTES, hot: int = HOT, longer: int | None = None) -> DataFrame:
    """(doc_id, row, low, high, longer): byte ranges covered by strings of ``width`` bytes that start more than once, with ``apart`` in more than one row.

    ``longer`` is another width over ``width``; rows with that flag are the ranges of its strings, which start more than once, in whatever row.
    """
    if width <= 3 * REACH:
        raise ValueError(f"width must be over {3 * REACH} bytes")
    if longer and longer <= width:
        raise ValueError("the longer width must be over the other")
    reach = longer or width
    work = shared_dir(documents.sparkSession, "suffix")
    docs = rows_of(documents, id_column, text_column)
    found = saved(docs.mapInArrow(_find(width, min(GRAM, width), reach), "doc_id long, row long, at long, size int, wide int, gram int, key long, content long, left int, right int, within boolean"), f"{work}/blocks")
    # One copy of each block, any (its columns are of one row). Its owner is its row, or 0 if several rows hold it.
    owner = F.when(F.min("row") == F.max("row"), F.min("row")).otherwise(0)
    copies = saved(
        found.groupBy("key", "content").agg(F.count("*").alias("copies"), owner.alias("owner"), *(F.first(c).alias(c) for c in ("row", "doc_id", "at", "size", "gram", "left", "right"))),
        f"{work}/copies",
    )
    several = (F.col("owner") == 0) if apart else (F.col("copies") > 1)
    # The block's windows that reach far to the left of the gram, and those that do not and so reach far to the right.
    cut = F.greatest(F.col("gram") - F.lit((width - min(GRAM, width)) // 2 - 1), F.lit(0))
    sides = [
        F.when(F.col(c).isNotNull() & (n > 0), F.struct(F.xxhash64("key", F.lit(c), c).alias("bunch"), (F.col("at") + low).alias("place"), n.cast("int").alias("size")))
        for c, low, n in (("left", F.lit(0), F.least(cut, "size")), ("right", F.least(cut, "size"), F.col("size") - F.least(cut, "size")))
    ]

    def deal(of: DataFrame, once: Column) -> DataFrame:
        return of.select("owner", once.alias("once"), "doc_id", "row", F.explode(F.filter(F.array(*sides), lambda x: x.isNotNull())).alias("x")).select("owner", "once", "doc_id", "row", "x.*")

    dealt = deal(copies, ~several)
    # Written before they are joined: a join of two plain exchanges can be split at a hot key.
    unlike = F.count("*").alias("unlike")
    # Neighbouring bunches mostly have the same rows, so the least hash of their members' stretches takes them to one shard.
    near = F.min(F.hash("row", F.floor(F.col("place") / STRETCH))).cast("long").alias("near")
    unit = F.when(F.col("unlike") <= min(FEW, hot), F.col("near")).otherwise(F.col("bunch")).alias("unit")
    bunches = saved(dealt.groupBy("bunch").agg(unlike, near, F.max("once").alias("open")).where("unlike > 1 and open").select("bunch", "unlike", unit), f"{work}/unlike")
    # What is repeated in whole; the ranges of the longer strings do not ask for another row.
    kinds = F.array(
        F.when(several, F.struct(F.col("size").alias("n"), F.lit(width).alias("width"), F.lit(False).alias("longer"))),
        *([F.when((F.col("copies") > 1) & (F.col("wide") > 0), F.struct(F.col("wide").alias("n"), F.lit(longer).alias("width"), F.lit(True).alias("longer")))] if longer else []),
    )
    whole = (
        found.join(copies.where(F.col("copies") > 1 if longer else several).select("key", "content", "copies", "owner").hint("shuffle_hash"), ["key", "content"])
        .select("doc_id", "row", "at", F.explode(F.filter(kinds, lambda x: x.isNotNull())).alias("x"))
        .select("doc_id", "row", F.col("at").alias("low"), (F.col("at") + F.col("x.n") + F.col("x.width") - 1).alias("high"), "x.longer")
    )
    if apart:  # other rows may share a part of a block that one row holds at several places
        within = copies.where("copies > 1 and owner <> 0").select("key", "content", "owner", F.col("at").alias("first"))
        dealt = dealt.unionByName(deal(found.where("within").join(within.hint("shuffle_hash"), ["key", "content"]).where("at <> first"), F.lit(True)))
    wanted = (
        dealt.join(bunches.hint("shuffle_hash"), "bunch")
        .groupBy("doc_id", "row")
        .agg(F.collect_list(F.struct("place", "size", F.col("unit").alias("bunch"), "once", (F.col("unlike") > hot).alias("hot"), "owner")).alias("wanted"))
    )
    texts = saved(on_row(docs, wanted, "inner").select("doc_id", "text", "row", "wanted").mapInArrow(_cut(reach), CUT), f"{work}/texts")
    total = texts.where("not hot").agg(F.sum("size"), F.count("*")).first()
    shards = max(1, ((total[0] or 0) + reach * total[1]) // shard_bytes)
    sorted_ = (
        texts.where("not hot")
        .groupBy(F.pmod(F.xxhash64("bunch"), F.lit(shards)).alias("shard"))
        .applyInArrow(_sort_shard(width, apart, longer), RANGES)
    )
    ranges = whole.unionByName(sorted_)
    if longer:
        # Blocks whose contents go on are often unlike where those of one width are alike, so the rows of hot bunches take each width by itself.
        rows = saved(texts.where("hot").select("doc_id", "row").distinct(), f"{work}/hot")
        if not rows.isEmpty():
            few = saved(on_row(docs, rows, "inner").select("doc_id", "text"), f"{work}/few")
            of = {"shard_bytes": shard_bytes, "hot": hot}
            ranges = ranges.unionByName(covered_ranges(few, width=width, apart=apart, **of)).unionByName(covered_ranges(few, width=longer, **of).withColumn("longer", F.lit(True)))
    else:
        windows = texts.where("hot").mapInArrow(_hash_windows(width), "doc_id long, row long, at long, bunch long, window long, once boolean, owner long")
        again = F.min("owner") < F.max("owner") if apart else F.count("*") > 1
        again = saved(windows.groupBy("bunch", "window").agg(again.alias("again")).where("again").select("bunch", "window"), f"{work}/again")
        spread = windows.where("once").join(again, ["bunch", "window"])
        ranges = ranges.unionByName(spread.select("doc_id", "row", F.col("at").alias("low"), (F.col("at") + F.lit(width)).alias("high"), F.lit(False).alias("longer")))
    ranges = saved(ranges, f"{work}/ranges")
    discard(documents.sparkSession, *(f"{work}/{x}" for x in ("blocks", "copies", "unlike", "texts", "again", "hot", "few")))
    return ranges


def _ranges(column: pa.Array, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The unions of the rows' ranges: the row of each, and its ends in the buffer of all texts."""
    doc, (low, high) = _listed(column)
    apart = offsets[doc] + doc  # a byte between the texts, so that their ranges do not touch
    low, high = merged(low.to_numpy() + apart, high.to_numpy() + apart)
    doc = np.searchsorted(offsets[:-1] + np.arange(len(column)), low, "right") - 1
    return doc, low - doc, high - doc


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        buf, offsets = utf8(batch.column(1))
        n, size = batch.num_rows, np.diff(offsets)
        gone, shared = np.zeros(n, np.int64), np.zeros(n, np.int64)
        doc, low, high = _ranges(batch.column(2), offsets)
        np.add.at(gone, doc, high - low)
        edge = np.zeros(len(buf) + 1, np.int8)
        edge[low] += 1
        edge[high] -= 1
        rest = buf[np.cumsum(edge[:-1], dtype=np.int8) == 0]
        ends = np.append(0, np.cumsum(size - gone)).astype(np.int32)
        kept = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(rest)])
        other, low, high = _ranges(batch.column(3), offsets)
        np.add.at(shared, other, high - low)
        spans = np.bincount(doc, minlength=n)
        yield pa.record_batch([batch.column(0), pa.array(size), pa.array(gone), pa.array(spans, pa.int64()), kept, pa.array(shared)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "n_shared"])


def remove_repeated(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = WIDTH, shared: int = SHARED, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, the remaining bytes, and n_shared, of every row."""
    if shared < width:
        ranges = covered_ranges(documents, id_column, text_column, shared, apart=True, longer=width, **options)
    else:
        removed = covered_ranges(documents, id_column, text_column, width, **options).withColumn("longer", F.lit(True))
        ranges = removed.unionByName(covered_ranges(documents, id_column, text_column, shared, apart=True, **options))
    of = F.struct("low", "high")
    both = ranges.groupBy("doc_id", "row").agg(F.collect_list(F.when(F.col("longer"), of)).alias("ranges"), F.collect_list(F.when(~F.col("longer"), of)).alias("others"))
    found = on_row(rows_of(documents, id_column, text_column), both)
    return found.select("doc_id", "text", "ranges", "others").mapInArrow(_kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, n_shared long")
