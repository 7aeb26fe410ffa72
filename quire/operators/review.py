"""Quality review of translations: every check gives rows of issues; the score follows from them.

Issues are (book_id, check_id, chapter_id, category, severity, message). Chapters
are compared within a joined row (book_id, chapter_pos, chapter_id, source, translated).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import blank, count_list_items, count_quotes, count_words, heading_levels, image_references, let, py_strip, split_lines
from quire.operators.term_search import absent_terms

PENALTY = {"error": 10, "warning": 5}
OTHER_PENALTY = 1
ISSUE = "book_id string, check_id string, chapter_id string, category string, severity string, message string"
#: Letters on both sides make a word; a boundary is any other character.
_ASCII_WORD = r"(?U)\b[A-Za-z]{4,}\b"


def pairs(source: DataFrame, translated: DataFrame) -> DataFrame:
    """Chapters with both texts; translated is null where there is none."""
    other = translated.select("book_id", "chapter_pos", F.col("content").alias("translated"))
    return source.select("book_id", "chapter_pos", "chapter_id", F.col("content").alias("source")).join(other, ["book_id", "chapter_pos"], "left")


def _said(condition: Column, check: str, category: str, severity: str, message: Column) -> Column:
    return F.when(condition, F.struct(F.lit(check).alias("check_id"), F.lit(category).alias("category"), F.lit(severity).alias("severity"), message.alias("message")))


def _issues(rows: DataFrame, *said: Column) -> DataFrame:
    """All checks of a row in one pass over it."""
    return rows.select("book_id", "chapter_id", F.inline(F.array_compact(F.array(*said)))).select("book_id", "check_id", "chapter_id", "category", "severity", "message")


def structural(both: DataFrame) -> DataFrame:
    """Missing or empty translations, headings, lists, quotes and size."""
    counts = F.struct(
        *(F.struct(heading_levels(x).alias("levels"), count_list_items(x).alias("lists"), count_quotes(x).alias("quotes"), count_words(x).alias("words")).alias(k) for k, x in (("a", F.col("source")), ("b", F.col("translated"))))
    )
    there, compared = F.col("translated").isNotNull(), F.col("translated").isNotNull() & F.col("source").isNotNull()

    def checks(c: Column) -> Column:
        a, b = c["a"], c["b"]
        count_a, count_b = F.size(a["levels"]), F.size(b["levels"])
        return F.array_compact(F.array(
            _said(~there, "missing", "structure", "error", F.lit("Translation is missing")),
            _said(there & blank("translated"), "empty", "structure", "error", F.lit("Translation is empty")),
            _said(compared & (count_a != count_b), "heading_count", "structure", "warning", F.format_string("Heading count differs: source=%d translated=%d", count_a, count_b)),
            _said(compared & (count_a == count_b) & (a["levels"] != b["levels"]), "heading_levels", "structure", "warning", F.lit("Heading levels differ")),
            _said(compared & (a["lists"] > 0) & (b["lists"] == 0), "lists", "structure", "warning", F.lit("List items are lost")),
            _said(compared & (a["quotes"] > 0) & (b["quotes"] == 0), "quotes", "structure", "warning", F.lit("Block quotes are lost")),
            _said(compared & (a["words"] > 0) & (b["words"] > 3 * a["words"]), "size", "structure", "warning", F.format_string("Translation is far longer: source=%d translated=%d", a["words"], b["words"])),
        ))

    return both.select("book_id", "chapter_id", F.inline(let(counts, checks))).select("book_id", "check_id", "chapter_id", "category", "severity", "message")


def english_fragments(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, line_number, n_words, words): lines with five or more English words, their first eight."""

    def found(line: Column, pos: Column) -> Column:
        none = F.lit(None).cast("struct<line_number:int,w:array<string>>")
        words = let(F.regexp_extract_all(line, F.lit(_ASCII_WORD), F.lit(0)), lambda w: F.when(F.size(w) >= 5, F.struct((pos + 1).alias("line_number"), w.alias("w"))).otherwise(none))
        # Five words of four letters take 24 characters; the strip runs for lines that may begin with a mark alone.
        return F.when(F.length(line) >= 24, F.when(~py_strip(line).rlike("^(```|http)"), words)).otherwise(none)

    rows = texts.select(*keys, F.inline(F.array_compact(F.transform(split_lines(text), found))))
    return rows.select(*keys, "line_number", F.size("w").alias("n_words"), F.array_join(F.slice("w", 1, 8), " ").alias("words"))


def terminology(glossary: DataFrame, translated: DataFrame) -> DataFrame:
    absent = absent_terms(glossary, translated).withColumn("chapter_id", F.lit(None).cast("string"))
    lines = english_fragments(translated.where(F.col("content").isNotNull()), ["book_id", "chapter_id"], "content")
    return _issues(absent, _said(F.lit(True), "term_absent", "terminology", "info", F.format_string("Term is not used: %s -> %s", "english", "russian"))).unionByName(
        _issues(lines, _said(F.lit(True), "english", "terminology", "warning", F.format_string("English text on line %d: %s", "line_number", "words")))
    )


def completeness(chunks: DataFrame, both: DataFrame) -> DataFrame:
    state = F.coalesce("status", F.lit("pending"))
    lost = both.where(F.col("source").isNotNull() & F.col("translated").isNotNull()).select("book_id", "chapter_id", F.explode(lost_images(F.col("source"), F.col("translated"))).alias("image"))
    of_chunks = _issues(
        chunks,
        _said(~state.isin("translated", "approved"), "chunk_status", "completeness", "error", F.format_string("Chunk %s is %s", "chunk_id", state)),
        _said(blank("translation"), "chunk_text", "completeness", "error", F.format_string("Chunk %s has no text", "chunk_id")),
    )
    return of_chunks.unionByName(_issues(lost, _said(F.lit(True), "image", "completeness", "warning", F.concat(F.lit("Image is lost: "), "image"))))


def lost_images(source: Column, translated: Column) -> Column:
    """Sorted set difference of image references."""
    return F.array_sort(F.array_except(image_references(source), image_references(translated)))


def score(issues: DataFrame, books: DataFrame | None = None) -> DataFrame:
    """(book_id, n_issues, score): 100 less ten for an error, five for a warning, one for others, at least zero."""
    cost = F.lit(OTHER_PENALTY)
    for severity, n in PENALTY.items():
        cost = F.when(F.col("severity") == severity, n).otherwise(cost)
    found = issues.groupBy("book_id").agg(F.count("*").alias("n_issues"), F.sum(cost).alias("penalty"))
    if books is not None:
        found = books.select("book_id").join(found, "book_id", "left").na.fill(0, ["n_issues", "penalty"])
    return found.select("book_id", "n_issues", F.greatest(F.lit(0.0), 100.0 - F.col("penalty")).alias("score"))


def review(source: DataFrame, translated: DataFrame, chunks: DataFrame, glossary: DataFrame) -> DataFrame:
    """All issues of all checks."""
    both = pairs(source, translated)
    return structural(both).unionByName(terminology(glossary, translated)).unionByName(completeness(chunks, both))


def report(issues: DataFrame, scores: DataFrame) -> DataFrame:
    """(book_id, report): the quality report as markdown."""
    line = F.format_string("- [%s] %s: %s", "severity", F.coalesce("chapter_id", F.lit("book")), "message")
    listed = issues.groupBy("book_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("category", "check_id", line.alias("line")))), lambda x: x["line"]), "\n").alias("lines"))
    return scores.join(listed, "book_id", "left").select("book_id", F.format_string("# Quality report\n\nScore: %.1f\nIssues: %d\n\n%s\n", "score", "n_issues", F.coalesce("lines", F.lit("- none"))).alias("report"))
