"""Normalisation of extracted markdown: page numbers, running headers, broken words, blank lines.

A book is normalised within its row. Repeated lines are found by sorting the
book's lines, so the corpus is one narrow projection without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import SPACE, WORD_CHAR, blank, let, lines, py_strip

PAGE_NUMBER = rf"^(?:[Pp]age[{SPACE}]+\p{{Nd}}+|\p{{Nd}}+[{SPACE}]*\||\|[{SPACE}]*\p{{Nd}}+|-[{SPACE}]*\p{{Nd}}+[{SPACE}]*-|\p{{Nd}}{{1,4}})$"
HEADING_1 = rf"(?d)^#[{SPACE}]+(.+)$"


@dataclass(frozen=True)
class NormalizationConfig:
    remove_page_numbers: bool = True
    remove_headers_footers: bool = True
    join_hyphenated: bool = True
    #: Heading and list lines are never touched by the steps above, so these two change nothing, as before.
    preserve_headings: bool = True
    preserve_lists: bool = True
    #: Never blank the fences of code blocks as repeated lines.
    protect_code: bool = False


def remove_page_numbers(md: Column) -> Column:
    """Drops lines that are a page number; blank lines stay."""
    return F.array_join(F.filter(lines(md), lambda x: ~py_strip(x).rlike(PAGE_NUMBER)), "\n")


def header_footer_patterns(md: Column, min_repetitions: int = 3, protect_code: bool = False) -> Column:
    """Stripped lines of under 80 characters, no headings, that occur at least so often, in text order of their first place."""

    def repeated(ordered: Column) -> Column:
        ahead = F.slice(ordered, F.lit(min_repetitions), F.greatest(F.size(ordered) - F.lit(min_repetitions - 1), F.lit(0)))
        pairs = F.zip_with(F.slice(ordered, F.lit(1), F.size(ahead)), ahead, lambda a, b: F.when(a == b, a))
        return F.array_distinct(F.filter(pairs, lambda x: x.isNotNull()))

    def found(usable: Column) -> Column:
        return let(let(F.sort_array(usable), repeated), lambda r: F.array_intersect(usable, r))

    stripped = F.transform(lines(md), py_strip)
    return let(F.filter(stripped, lambda x: (x != "") & (F.length(x) < 80) & ~x.startswith("#") & (~x.rlike("^(```|~~~)") if protect_code else F.lit(True))), found)


def blank_patterns(md: Column, patterns: Column) -> Column:
    """Blanks lines equal to a pattern, without stripping them."""
    return let(patterns, lambda p: F.array_join(F.transform(lines(md), lambda x: F.when(F.array_contains(p, x), "").otherwise(x)), "\n"))


def join_hyphenated_words(md: Column) -> Column:
    return F.regexp_replace(md, rf"({WORD_CHAR})-\n[{SPACE}]*({WORD_CHAR})", "$1$2")


def squeeze_blank_lines(md: Column) -> Column:
    return F.regexp_replace(md, "\n{4,}", "\n\n\n")


def normalize(books: DataFrame, config: NormalizationConfig = NormalizationConfig()) -> DataFrame:
    """books with md normalised: page numbers, then headers found in what is left, broken words, blank lines."""
    out = books
    if config.remove_page_numbers:
        out = out.withColumn("md", remove_page_numbers(F.col("md")))
    if config.remove_headers_footers:
        out = out.withColumn("md", let(F.col("md"), lambda md: blank_patterns(md, header_footer_patterns(md, protect_code=config.protect_code))))
    if config.join_hyphenated:
        out = out.withColumn("md", join_hyphenated_words(F.col("md")))
    return out.withColumn("md", squeeze_blank_lines(F.col("md")))


def detect_headers_footers(books: DataFrame, min_repetitions: int = 3) -> DataFrame:
    """(book_id, pattern, n, first_pos): repeated lines of each book, counted before the shuffle."""
    found = books.select("book_id", F.posexplode(lines("md")).alias("pos", "line")).select("book_id", "pos", py_strip("line").alias("pattern"))
    found = found.where((F.length("pattern") > 0) & (F.length("pattern") < 80) & ~F.col("pattern").startswith("#"))
    return found.groupBy("book_id", "pattern").agg(F.count("*").alias("n"), F.min("pos").cast("long").alias("first_pos")).where(F.col("n") >= min_repetitions)


def section_type(line: Column) -> Column:
    """What a level-1 heading opens; the keyword ends at white space or the line's end."""
    low = F.lower(line)

    def opens(words: str, end: str = "") -> Column:
        return low.rlike(rf"(?d)^#[{SPACE}]+(?:{words})(?:[{SPACE}{end}]|$)")

    return (
        F.when(opens("foreword|preface|introduction"), "foreword")
        .when(opens("acknowledgments?|acknowledgements?|thanks"), "acknowledgments")
        .when(opens("appendix|appendices", r":\p{Nd}"), "appendix")
        .when(opens("notes?|endnotes?|references?"), "notes")
        .otherwise("chapter")
    )


def boundary_array(md: Column) -> Column:
    """array<struct<line_number, title, heading_text, chapter_type>> of level-1 headings."""
    marked = F.filter(F.transform(lines(md), lambda x, i: F.struct((i + 1).alias("line_number"), x.alias("line"))), lambda s: s["line"].rlike(HEADING_1))
    return F.transform(marked, lambda s: F.struct(s["line_number"].alias("line_number"), py_strip(F.regexp_extract(s["line"], HEADING_1, 1)).alias("title"), s["line"].alias("heading_text"), section_type(s["line"]).alias("chapter_type")))


def chapter_boundaries(books: DataFrame) -> DataFrame:
    return books.select("book_id", F.inline(boundary_array(F.col("md"))))


def boundary_type_counts(books: DataFrame) -> DataFrame:
    return chapter_boundaries(books).groupBy("book_id", "chapter_type").agg(F.count("*").alias("n"))


def normalization_stats(books: DataFrame, config: NormalizationConfig = NormalizationConfig()) -> DataFrame:
    """(book_id, lines_before, lines_after, lines_removed, n_patterns, n_boundaries); patterns of the raw text."""
    raw = books.withColumn("raw", F.col("md"))
    out = normalize(raw, config)
    before, after = F.size(lines("raw")), F.size(lines("md"))
    return out.select("book_id", before.cast("long").alias("lines_before"), after.cast("long").alias("lines_after"), (before - after).cast("long").alias("lines_removed"), F.size(header_footer_patterns(F.col("raw"))).cast("long").alias("n_patterns"), F.size(boundary_array(F.col("md"))).cast("long").alias("n_boundaries"))


def report(stats: DataFrame, types: DataFrame) -> DataFrame:
    """(book_id, report): the normalisation report as markdown, one small row per book."""
    kinds = types.groupBy("book_id").agg(F.array_join(F.array_sort(F.collect_list(F.format_string("- %s: %d", "chapter_type", "n"))), "\n").alias("kinds"))
    text = F.format_string(
        "# Normalization report\n\n- Lines before: %d\n- Lines after: %d\n- Lines removed: %d\n- Repeated line patterns: %d\n- Chapter boundaries: %d\n\n## Boundaries by type\n\n%s\n",
        "lines_before", "lines_after", "lines_removed", "n_patterns", "n_boundaries", F.coalesce("kinds", F.lit("- none")),
    )
    return stats.join(kinds, "book_id", "left").select("book_id", text.alias("report"))


def blank_books(books: DataFrame) -> DataFrame:
    """Books without text; extraction has failed for them."""
    return books.where(blank("md")).select("book_id")
