"""Packing of blocks into chunks that keep headings, lists and code whole.

Greedy packing is an ordered fold. It carries the running length and the places
where chunks begin, so it needs no growing text and an entry per chunk, not per unit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import collapse, let, py_strip
from quire.operators.blocks import block_array, list_items

MAX_CHARS = 6000


def validate_max_chars(max_chars: int) -> None:
    if max_chars <= 0:
        raise ValueError("max_chars must be greater than zero")


def group_starts(sizes: Column, limit: int, gap: int) -> Column:
    """Where greedy packing opens a group: a unit joins the group before it if that stays within the limit."""
    start = F.struct(F.lit(0).alias("at"), F.lit(-1).alias("length"), F.array().cast("array<int>").alias("out"))

    def step(seen: Column, n: Column) -> Column:
        joins = (seen["length"] >= 0) & (seen["length"] + gap + n <= limit)
        out = F.when(joins, seen["out"]).otherwise(F.concat(seen["out"], F.array(seen["at"])))
        return F.struct((seen["at"] + 1).alias("at"), F.when(joins, seen["length"] + gap + n).otherwise(n).alias("length"), out.alias("out"))

    return F.aggregate(sizes, start, step, lambda x: x["out"])


def _grouped(units: Column, limit: int, gap: str) -> Column:
    def joined(us: Column, at: Column) -> Column:
        return F.transform(at, lambda a, k: F.array_join(F.slice(us, a + 1, F.coalesce(F.get(at, k + 1), F.size(us)) - a), gap))

    return let(units, lambda us: let(group_starts(F.transform(us, F.length), limit, len(gap)), lambda at: joined(us, at)))


def split_paragraph(content: Column, max_chars: int) -> Column:
    """Words packed into parts of at most max_chars; a longer word is a part of its own."""

    def parts(text: Column) -> Column:
        words = F.filter(F.split(text, " ", -1), lambda w: w != "")
        return F.when(F.length(text) <= max_chars, F.array(text)).otherwise(_grouped(words, max_chars, " "))

    return let(collapse(content), parts)


def units_of_blocks(blocks: Column, max_chars: int) -> Column:
    """For each block its units: a heading goes with the first part of a paragraph right after it; long lists and paragraphs are split."""

    def unit(b: Column, i: Column) -> Column:
        before, after = F.get(blocks, i - 1), F.get(blocks, i + 1)
        led = (i > 0) & F.coalesce(before["type"] == "heading", F.lit(False))
        parts = split_paragraph(b["content"], max_chars)
        glued = F.transform(parts, lambda p, k: F.when(k == 0, F.concat(py_strip(before["content"]), F.lit("\n\n"), p)).otherwise(p))
        stripped = py_strip(b["content"])
        return (
            F.when((b["type"] == "heading") & F.coalesce(after["type"] == "paragraph", F.lit(False)), F.array().cast("array<string>"))
            .when((b["type"] == "paragraph") & led, glued)
            .when((b["type"] == "list") & (F.length(b["content"]) > max_chars), F.transform(list_items(b["content"]), py_strip))
            .when((b["type"] == "paragraph") & (F.length(b["content"]) > max_chars), parts)
            .otherwise(F.array(stripped))
        )

    return F.transform(blocks, unit)


def chunk_units(blocks: Column, max_chars: int) -> Column:
    """All units in order."""
    return F.filter(F.flatten(units_of_blocks(blocks, max_chars)), lambda u: u != "")


def pack_units(units: Column, max_chars: int) -> Column:
    """Chunk texts: units joined by an empty line, each ending with a line end."""
    return F.transform(_grouped(F.filter(units, lambda u: py_strip(u) != ""), max_chars, "\n\n"), ensure_newline)


def ensure_newline(x: Column) -> Column:
    return F.when(x.endswith("\n"), x).otherwise(F.concat(x, F.lit("\n")))


def join_blocks(texts: Column) -> Column:
    return F.array_join(F.filter(F.transform(texts, py_strip), lambda x: x != ""), "\n\n")


def chunk(chapters: DataFrame, max_chars: int = MAX_CHARS) -> DataFrame:
    """(book_id, chapter_pos, chapter_id, chunk_id, sequence, content, char_count, status)."""
    validate_max_chars(max_chars)
    units = chapters.select("book_id", "chapter_pos", "chapter_id", block_array(F.col("content")).alias("blocks")).select("book_id", "chapter_pos", "chapter_id", let(F.col("blocks"), lambda b: chunk_units(b, max_chars)).alias("units"))
    return pack(units, max_chars)


def pack(units: DataFrame, max_chars: int = MAX_CHARS) -> DataFrame:
    """Chunks of rows (book_id, chapter_pos, chapter_id, units)."""
    found = units.select("book_id", "chapter_pos", "chapter_id", F.posexplode(pack_units(F.col("units"), max_chars)).alias("k", "content"))
    sequence = F.col("k") + 1
    return found.select(
        "book_id", "chapter_pos", "chapter_id", F.concat("chapter_id", F.lit("_"), F.format_string("%04d", sequence)).alias("chunk_id"), sequence.alias("sequence"), "content", F.length("content").alias("char_count"), F.lit("pending").alias("status"),
    )


def chunk_metadata(chunks: DataFrame) -> DataFrame:
    """A chunk's metadata row; the time of writing is left to the sink."""
    base = F.concat(F.lit("chunks/"), "chapter_id", F.lit("/"), F.format_string("%04d", "sequence"))
    return chunks.select("book_id", "chunk_id", "chapter_id", "sequence", "char_count", "status", F.concat(base, F.lit(".en.md")).alias("source_path"), F.concat(base, F.lit(".ru.md")).alias("translated_path"))


def chapter_counts(chapters: DataFrame, chunks: DataFrame) -> DataFrame:
    """(book_id, chapter_pos, chapter_id, chunk_count, status): every chapter, chunked."""
    n = chunks.groupBy("book_id", "chapter_pos").agg(F.count("*").alias("chunk_count"))
    return chapters.select("book_id", "chapter_pos", "chapter_id").join(n, ["book_id", "chapter_pos"], "left").select("book_id", "chapter_pos", "chapter_id", F.coalesce("chunk_count", F.lit(0).cast("long")).alias("chunk_count"), F.lit("chunked").alias("status"))


def write_chunks(chunks: DataFrame, path: str, force: bool = False) -> None:
    """A partition per book, since the driver moves and lists each; an existing table is refused unless forced, then only the books at hand are replaced, and whole."""
    chunks.write.mode("overwrite" if force else "errorifexists").option("partitionOverwriteMode", "dynamic").partitionBy("book_id").parquet(path)
