"""BPE encoding as a streaming transducer with bounded lookahead, and decoding as a state machine.

``Encoder`` takes text in parts of any size and holds back only what later text
can still change: an open special token, an open piece, and, inside a piece that
has grown long, the symbols within the merge list's sufficient lookahead.

Sufficient lookahead (``sufficient_lookahead``): whether a merge (u, v) happens
can depend on what stands to the right of v only if a merge of lower rank takes
a symbol on v's right edge away, which in turn depends on what stands right of
that merge's right side, and so on with falling ranks. The longest such chain,
computed once over the merge list, bounds how far right a token boundary
depends on the text. A token that ends further from the end of the text read so
far is stable and is emitted; boundaries part the rest from it for good.

Pieces mostly end before that, so they are looked up in a bounded cache.

The file's parts that are supported: NFC, lower-casing and white-space
replacement; its split pattern with removed gaps; byte-level symbols; a suffix at
the end of a word; special tokens found in the raw text.
"""

from __future__ import annotations

import codecs
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ._common import binary, slices, text_of

#: Characters of text taken at once.
PART = 1 << 16
#: Characters after which an open piece is encoded as far as it is stable.
LONG = 1 << 12
#: Distinct pieces in a generation of the cache.
CACHE = 150_000


def byte_alphabet() -> list[str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, others follow from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def sufficient_lookahead(merges: list[tuple[str, str]]) -> int:
    """Symbols to the right of a place that can decide whether a token ends there."""
    made: dict[str, str] = {}  # a token's right part
    furthest: dict[str, int] = {}  # per left part, of the merges so far
    longest = 1
    for left, right in merges:  # by rank
        edge, chain = right, 0
        while edge:
            chain = max(chain, furthest.get(edge, 0))
            edge = made.get(edge, "")
        reach = len(right) + chain
        furthest[left] = max(furthest.get(left, 0), reach)
        made.setdefault(left + right, right)
        longest = max(longest, reach)
    return longest


class Model:
    """What a tokenizers file of this kind holds."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        steps = [x["type"] for x in (spec["normalizer"] or {"normalizers": []})["normalizers"]]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        if steps != ["NFC", "Replace", "Lowercase"] or split["behavior"] != "Removed" or not split["invert"] or level["type"] != "ByteLevel" or level["add_prefix_space"] or level["use_regex"]:
            raise ValueError("this tokenizer file has parts that are not supported")
        self.vocab: dict[str, int] = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.lookahead = sufficient_lookahead([(a, b.removesuffix(self.suffix) or b) for a, b in merges]) + 1
        self.rank = {(self.vocab[a], self.vocab[b]): (k, self.vocab[a + b]) for k, (a, b) in reversed(list(enumerate(merges)))}
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = regex.compile("|".join(regex.escape(t) for t in self.special)) if self.special else None
        alphabet = byte_alphabet()
        self.symbol = [self.vocab[c] for c in alphabet]
        self.final = [self.vocab[c + self.suffix] for c in alphabet]
        self.tokens = np.full(max([*self.vocab.values(), *self.special.values()]) + 1, "", object)
        for token, k in [*self.vocab.items(), *self.special.items()]:
            self.tokens[k] = token
        self.sizes = np.array([len(t.removesuffix(self.suffix)) for t in self.tokens])  # in bytes

    def merge(self, symbols: list[int]) -> list[int]:
        """All merges, by rank, then from the left."""
        rank = self.rank
        if len(symbols) > 100:
            return self._merge_long(symbols)
        while len(symbols) > 1:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                found = rank.get((symbols[i], symbols[i + 1]))
                if found is not None and (best is None or found < best):
                    best, at = found, i
            if best is None:
                break
            symbols[at : at + 2] = [best[1]]
        return symbols

    def _merge_long(self, symbols: list[int]) -> list[int]:
        import heapq

        n = len(symbols)
        after, before = [*range(1, n), -1], list(range(-1, n - 1))
        heap = [(f[0], i, symbols[i], symbols[i + 1], f[1]) for i in range(n - 1) if (f := self.rank.get((symbols[i], symbols[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != a or j < 0 or symbols[j] != b:
                continue
            symbols[i], symbols[j] = new, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x in (before[i], i):
                if x >= 0 and after[x] >= 0 and (f := self.rank.get((symbols[x], symbols[after[x]]))):
                    heapq.heappush(heap, (f[0], x, symbols[x], symbols[after[x]], f[1]))
        return [s for s in symbols if s >= 0]

    def word(self, raw: bytes, ended: bool = True) -> list[int]:
        symbols = [self.symbol[b] for b in raw]
        if ended and raw:
            symbols[-1] = self.final[raw[-1]]
        return self.merge(symbols)


@lru_cache(maxsize=2)
def load(path: str) -> Model:
    return Model(path)


def normalised(text: str) -> str:
    """NFC and lower case, character by character (a final sigma is like any other)."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
    return text.lower()


class Encoder:
    """push() text, take the ids that are stable; finish() gives the rest and starts anew."""

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self._start()

    def _start(self) -> None:
        self.raw = ""  # not yet normalised
        self.open = ""  # normalised, the last piece's text, if the text may go on with it
        self.tail = b""  # of a long piece: bytes that follow its emitted tokens
        self.inside = None  # the class of a long piece whose tokens have been emitted in part

    def _pieces(self, pieces: list[str]) -> bytes:
        known = self.known
        for p in set(pieces).difference(known):
            found = self.before.get(p)
            known[p] = np.array(self.model.word(p.encode()), "<u4").tobytes() if found is None else found
        out = b"".join(map(known.__getitem__, pieces))
        if len(known) > CACHE:
            self.known, self.before = {}, known
        return out

    def push(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        out = []
        for k in range(0, len(text), PART):
            self.raw += text[k : k + PART]
            if len(self.raw) >= PART:
                out.append(self._some())
        return b"".join(out)

    def _some(self) -> bytes:
        """Takes the raw text up to a place where neither a special token nor a composed character can be parted."""
        hold = max([len(t) for t in self.model.special], default=1) + 4
        for at in range(len(self.raw) - hold, 0, -1):
            if self.raw[at].isspace() and self.raw[at].isascii():
                break
        else:
            at = len(self.raw) - hold
            while at > 0 and not (self.raw[at].isascii() and "'" not in self.raw[at - 2 if at > 1 else 0 : at + 1]):
                at -= 1
            for found in self.model.special_pattern.finditer(self.raw) if self.model.special_pattern else ():
                if found.start() < at < found.end():
                    at = found.start()
        if at <= 0:
            return b""
        part, self.raw = self.raw[:at], self.raw[at:]
        return self._take(part, False)

    def _take(self, part: str, last: bool) -> bytes:
        model, out, at = self.model, [], 0
        if model.special_pattern and "<" in part:
            for found in model.special_pattern.finditer(part):
                out += [self._plain(part[at : found.start()], True), np.array([model.special[found[0]]], "<u4").tobytes()]
                at = found.end()
        out.append(self._plain(part[at:], last))
        return b"".join(out)

    def _class(self, c: str) -> str:
        return "L" if regex.match(r"\p{L}", c) else "other"

    def _plain(self, part: str, ended: bool) -> bytes:
        text = self.open + normalised(part)
        self.open, out = "", []
        if self.inside is not None:
            # A long piece goes on while its class lasts.
            run = regex.match(r"\p{L}*" if self.inside == "L" else r"[^\s\p{L}\p{N}]*", text)[0]
            self.tail += run.encode()
            text = text[len(run) :]
            if not text and not ended:
                return self._stable()
            out.append(np.array(self.model.word(self.tail), "<u4").tobytes())
            self.inside, self.tail = None, b""
        pieces = self.model.pattern.findall(text)
        if not ended and pieces and text.endswith(pieces[-1]):
            self.open = pieces.pop()
        out.append(self._pieces(pieces))
        if len(self.open) > LONG and not self.open.startswith("'"):
            self.inside, self.tail, self.open = self._class(self.open[0]), self.open.encode(), ""
            out.append(self._stable())
        return b"".join(out)

    def _stable(self) -> bytes:
        ids = self.model.word(self.tail, False)
        ends = np.cumsum(self.model.sizes[ids])
        n = int(np.searchsorted(ends, len(self.tail) - self.model.lookahead, "right"))
        if n:
            self.tail = self.tail[int(ends[n - 1]) :]
        return np.array(ids[:n], "<u4").tobytes()

    def finish(self) -> bytes:
        out = self._take(self.raw, True)
        self._start()
        return out

    def encode(self, text: str) -> bytes:
        return self.push(text) + self.finish()


class Decoder:
    """Ids to text as the file decodes them: without a decoder of its own, tokens joined by a space.

    With ``byte_level`` tokens are bytes, and an incremental UTF-8 decoder gives
    each character as soon as its last byte has come, U+FFFD for what is none.
    """

    def __init__(self, model: Model, byte_level: bool = False):
        self.tokens = model.tokens
        self.bytes = {c: b for b, c in enumerate(byte_alphabet())} if byte_level else None
        self.suffix = model.suffix
        self.state = codecs.getincrementaldecoder("utf-8")("replace")
        self.first = True

    def push(self, ids: np.ndarray) -> str:
        tokens = self.tokens[ids].tolist()
        if self.bytes is None:
            text = " ".join(tokens)
            if tokens and not self.first:
                text = " " + text
            self.first = self.first and not tokens
            return text
        raw = b"".join(bytes(self.bytes[c] for c in t.removesuffix(self.suffix)) + b" " * (bool(self.suffix) and t.endswith(self.suffix)) for t in tokens)
        return self.state.decode(raw)

    def finish(self) -> str:
        rest = self.state.decode(b"", True) if self.bytes is not None else ""
        self.state.reset()
        self.first = True
        return rest


def _task(path: str):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        encoder, decoder = Encoder(model), Decoder(model)
        for batch in slices(batches):
            ids = [encoder.encode(t) for t in batch.column(1).to_pylist()]
            text = [decoder.push(np.frombuffer(x, "<u4")) + decoder.finish() for x in ids]
            yield pa.record_batch([batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), binary(ids), pa.array(text, pa.string())], ["doc_id", "n_tokens", "ids", "decoded"])

    return task


def encode_decode(documents: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit integers) and the decoded text of every row.

    Defined results: a null text is empty and has no ids; equal rows get equal
    results; an empty table gives an empty result; further columns are ignored.
    """
    return text_of(documents, id_column, text_column).mapInArrow(_task(tokenizer), "doc_id long, n_tokens long, ids binary, decoded string")
