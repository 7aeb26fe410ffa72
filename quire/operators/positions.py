"""Where a chunk comes from: its lines in the chapter, and in the book as it was before normalisation.

Normalisation only takes characters away, so a mark at the head of every line, with
the line's number, can go through the same steps: a word that is joined takes the
marks within it along, squeezed blank lines leave the marks of those that stay. What
is left at the head of a line names the raw line that it begins in. Chunks are
packed from units that know the lines of their blocks, and meet the raw lines by
joins on (book, line).

A unit's lines are those of its block: an item of a list that was split has its
own, a part of a paragraph that was split has the paragraph's. The range of raw
lines ends where the chunk's last line begins. Characters U+E000 and U+E001 in a
book count as U+FFFD for its map.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import LIST_MARKER, SPACE, WORD_CHAR, let, lines, py_strip
from quire.operators import chapters as C
from quire.operators import normalize as N
from quire.operators.blocks import placed_array
from quire.operators.chunking import MAX_CHARS, group_starts, units_of_blocks, validate_max_chars

OPEN, CLOSE = "\ue000", "\ue001"
_MARK = f"{OPEN}[0-9]+{CLOSE}"


def _marked(md: Column, config: N.NormalizationConfig) -> Column:
    """``md`` normalised, with the number of its raw line at the head of every line."""
    numbered = F.transform(lines(F.translate(md, OPEN + CLOSE, "\ufffd\ufffd")), lambda x, i: F.struct((i + 1).cast("string").alias("no"), x.alias("line")))
    if config.remove_page_numbers:
        numbered = F.filter(numbered, lambda s: ~py_strip(s["line"]).rlike(N.PAGE_NUMBER))
    head = lambda s, text: F.concat(F.lit(OPEN), s["no"], F.lit(CLOSE), text)

    def joined(rows: Column) -> Column:
        if not config.remove_headers_footers:
            return F.array_join(F.transform(rows, lambda s: head(s, s["line"])), "\n")
        patterns = N.header_footer_patterns(F.array_join(F.transform(rows, lambda s: s["line"]), "\n"), protect_code=config.protect_code)
        return let(patterns, lambda p: F.array_join(F.transform(rows, lambda s: head(s, F.when(F.array_contains(p, s["line"]), "").otherwise(s["line"]))), "\n"))

    out = let(numbered, joined)
    if config.join_hyphenated:
        out = F.regexp_replace(out, rf"({WORD_CHAR})-\n(?:{_MARK}|[{SPACE}])*({WORD_CHAR})", "$1$2")
    return F.regexp_replace(out, rf"((?:\n{_MARK}){{2}})(?:\n{_MARK})+(\n{_MARK})", "$1$2")


def with_origin(books: DataFrame, config: N.NormalizationConfig = N.NormalizationConfig()) -> DataFrame:
    """(book_id, md, origin): the normalised text, and for each of its lines the raw line that it begins in."""
    number = lambda x: F.regexp_extract(x, f"^{OPEN}([0-9]+){CLOSE}", 1).try_cast("int")  # noqa: E731  none in a book without lines
    parts = let(_marked(F.col("md"), config), lambda m: F.struct(F.regexp_replace(m, _MARK, "").alias("md"), F.transform(lines(m), number).alias("origin")))
    return books.select("book_id", parts.alias("p")).select("book_id", "p.md", "p.origin")


def line_map(normalized: DataFrame) -> DataFrame:
    """(book_id, line, raw_line) of every line of the normalised books."""
    return normalized.select("book_id", F.posexplode("origin").alias("k", "raw_line")).select("book_id", (F.col("k") + 1).alias("line"), "raw_line")


def _placed_units(blocks: Column, max_chars: int) -> Column:
    """array<struct<text, first, last>>: units with the lines of the chapter that they come from."""

    def of_block(units: Column, i: Column) -> Column:
        b, before = F.get(blocks, i), F.get(blocks, i - 1)
        end = b["line"] + F.size(lines(b["content"])) - 1
        led = (i > 0) & F.coalesce(before["type"] == "heading", F.lit(False)) & (b["type"] == "paragraph")
        marks = F.filter(F.transform(lines(b["content"]), lambda x, k: F.when(x.rlike(f"^{LIST_MARKER}"), k)), lambda k: k.isNotNull())
        split = (b["type"] == "list") & (F.length(b["content"]) > max_chars)

        def unit(u: Column, k: Column, at: Column) -> Column:
            first = F.when(split, b["line"] + F.get(at, k)).when(led & (k == 0), before["line"]).otherwise(b["line"])
            last = F.when(split, F.coalesce(b["line"] + F.get(at, k + 1) - 1, end)).otherwise(end)
            return F.struct(u.alias("text"), first.alias("first"), last.alias("last"))

        return let(marks, lambda at: F.transform(units, lambda u, k: unit(u, k, at)))

    return F.filter(F.flatten(F.transform(units_of_blocks(blocks, max_chars), of_block)), lambda u: py_strip(u["text"]) != "")


def chunk_lines(chapters: DataFrame, max_chars: int = MAX_CHARS) -> DataFrame:
    """(book_id, chapter_pos, chapter_id, chunk_id, sequence, first_line, last_line): the lines of the book that the chapters were cut from."""
    validate_max_chars(max_chars)
    base = ("book_id", "chapter_pos", "chapter_id", "start_line")
    units = chapters.select(*base, placed_array(F.col("content")).alias("blocks")).select(*base, let(F.col("blocks"), lambda b: _placed_units(b, max_chars)).alias("units"))

    def spans(us: Column) -> Column:
        at = group_starts(F.transform(us, lambda u: F.length(u["text"])), max_chars, 2)
        return let(at, lambda s: F.transform(s, lambda a, k: F.struct(F.get(us, a)["first"].alias("first"), F.get(us, F.coalesce(F.get(s, k + 1), F.size(us)) - 1)["last"].alias("last"))))

    found = units.select(*base, F.posexplode(let(F.col("units"), spans)).alias("k", "s"))
    sequence = F.col("k") + 1
    return found.select(
        "book_id", "chapter_pos", "chapter_id", F.concat("chapter_id", F.lit("_"), F.format_string("%04d", sequence)).alias("chunk_id"), sequence.alias("sequence"),
        (F.col("start_line") + F.col("s.first") - 1).alias("first_line"), (F.col("start_line") + F.col("s.last") - 1).alias("last_line"),
    )


def chunk_positions(books: DataFrame, config: N.NormalizationConfig = N.NormalizationConfig(), max_chars: int = MAX_CHARS) -> DataFrame:
    """chunk_lines of raw ``books`` (book_id, md), and raw_first, raw_last: the lines of the raw book."""
    normalized = with_origin(books, config)
    chunks = chunk_lines(C.split_auto(normalized.select("book_id", "md")), max_chars)
    raw = line_map(normalized)
    first = raw.select("book_id", F.col("line").alias("first_line"), F.col("raw_line").alias("raw_first"))
    last = raw.select("book_id", F.col("line").alias("last_line"), F.col("raw_line").alias("raw_last"))
    return chunks.join(first, ["book_id", "first_line"]).join(last, ["book_id", "last_line"]).select(*chunks.columns, "raw_first", "raw_last")


def excerpts(books: DataFrame, positions: DataFrame) -> DataFrame:
    """(book_id, chapter_pos, chunk_id, excerpt): the raw lines of each chunk, by an interval join within the book."""
    held = books.select("book_id", lines("md").alias("raw"))
    return positions.join(held, "book_id").select("book_id", "chapter_pos", "chunk_id", F.array_join(F.slice("raw", F.col("raw_first"), F.col("raw_last") - F.col("raw_first") + 1), "\n").alias("excerpt"))
