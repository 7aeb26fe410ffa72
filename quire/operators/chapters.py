"""Chapters: spans between headings, or spans that rules describe.

A chapter's text is cut from its book within the book's row, so each line is
copied once and nothing is shuffled.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import count_markdown_words, let, lines
from quire.operators.normalize import boundary_array

SHORT, LONG = 100, 10_000
#: Numbers before the first appendix and the first notes.
FIRST = {"appendix": 15, "notes": 18}


def _chapter_id(kind: Column, n: Column) -> Column:
    return (
        F.when(kind == "foreword", "00_foreword")
        .when(kind == "acknowledgments", "00_acknowledgments")
        .when(kind == "appendix", F.format_string("%02d_appendix", n + FIRST["appendix"]))
        .when(kind == "notes", F.format_string("%02d_notes", n + FIRST["notes"]))
        .otherwise(F.format_string("%02d_chapter", n))
    )


def split_auto(books: DataFrame) -> DataFrame:
    """(book_id, chapter_pos, chapter_id, title, chapter_type, start_line, end_line, content).

    A chapter goes from its level-1 heading to the line before the next one. Text
    before the first heading is left out; a book without headings is one chapter.
    ``chapter_pos`` is the key; two forewords share a chapter_id.
    """

    def spans(s: Column) -> Column:
        found, text = s["found"], s["text"]
        return F.when(F.size(found) == 0, whole(text)).otherwise(F.transform(found, lambda x, i: chapter(found, text, x, i)))

    def chapter(found: Column, text: Column, x: Column, i: Column) -> Column:
        start = x["line_number"]
        end = F.coalesce(F.get(found, i + 1)["line_number"] - 1, F.size(text))
        n = F.size(F.filter(F.slice(found, F.lit(1), i + 1), lambda y: y["chapter_type"] == x["chapter_type"]))
        return F.struct(
            (i + 1).alias("chapter_pos"), _chapter_id(x["chapter_type"], n).alias("chapter_id"), x["title"].alias("title"), x["chapter_type"].alias("chapter_type"),
            start.alias("start_line"), end.alias("end_line"), F.array_join(F.slice(text, start, end - start + 1), "\n").alias("content"),
        )

    def whole(text: Column) -> Column:
        return F.array(F.struct(F.lit(1).alias("chapter_pos"), F.lit("01_chapter").alias("chapter_id"), F.lit("Chapter 1").alias("title"), F.lit("chapter").alias("chapter_type"), F.lit(1).alias("start_line"), F.size(text).alias("end_line"), F.array_join(text, "\n").alias("content")))
    # One value per book is computed first: named again, md would be computed again.
    parts = let(F.col("md"), lambda md: let(F.struct(lines(md).alias("text"), boundary_array(md).alias("found")), spans))
    return books.select("book_id", F.inline(parts))


@dataclass(frozen=True)
class ChapterRule:
    id: str
    title: str
    start_pattern: str
    end_pattern: str | None = None


def load_rules(text: str) -> list[ChapterRule]:
    """Rules from a rules file's JSON; ValueError says what is wrong with it."""
    try:
        data = json.loads(text)
    except json.JSONDecodeError as error:
        raise ValueError(f"rules are not valid JSON: {error}") from error
    if not isinstance(data, dict) or "chapters" not in data:
        raise ValueError("rules have no 'chapters' key")
    if not data["chapters"]:
        raise ValueError("rules list no chapters")
    rules = []
    for k, item in enumerate(data["chapters"], 1):
        missing = [key for key in ("id", "title", "start_pattern") if not item.get(key)]
        if missing:
            raise ValueError(f"rule {k} lacks {', '.join(missing)}")
        rules.append(ChapterRule(item["id"], item["title"], item["start_pattern"], item.get("end_pattern")))
    return rules


def rules_problem(text: Column) -> Column:
    """What is wrong with a rules file's JSON, null if nothing is; for tables of rules files."""
    listed = F.get_json_object(text, "$.chapters")
    fields = ("id", "title", "start_pattern")
    rules = F.from_json(listed, "array<struct<id:string,title:string,start_pattern:string>>")
    lacking = F.transform(rules, lambda r, k: F.struct((k + 1).alias("k"), F.array_join(F.array_compact(F.array(*(F.when(F.coalesce(r[f], F.lit("")) == "", f) for f in fields))), ", ").alias("lacks")))
    first = F.get(F.filter(lacking, lambda x: x["lacks"] != ""), F.lit(0))
    return (
        F.when(F.get_json_object(text, "$").isNull(), "rules are not valid JSON")
        .when(listed.isNull(), "rules have no 'chapters' key")
        .when(F.size(rules) <= 0, "rules list no chapters")
        .when(first.isNotNull(), F.concat(F.lit("rule "), first["k"].cast("string"), F.lit(" lacks "), first["lacks"]))
    )


def _find(text: Column, pattern: str) -> Column:
    """Characters before the first multiline match, null if there is none."""
    at = F.regexp_instr(text, F.lit(f"(?md){pattern}"))
    return F.when(at > 0, at - 1)


def _line_ends(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))


def split_manual(books: DataFrame, rules: list[ChapterRule]) -> DataFrame:
    """(book_id, chapter_pos, chapter_id, title, start_line, end_line, content, problem), a row for each book and rule.

    A chapter starts at the first match in the whole text. It ends before the
    first match, searched from its start, of its end pattern or of the next
    rule's start pattern, or at the text's end. Whole lines are taken. A pattern
    that is not found gives a row with a problem.
    """
    return books.select("book_id", F.inline(let(F.col("md"), lambda md: _by_rules(md, rules))))


def _by_rules(text: Column, rules: list[ChapterRule]) -> Column:
    each = []
    for k, rule in enumerate(rules):
        start = _find(text, rule.start_pattern)
        rest = F.substring(text, start + 1, F.length(text))
        until = rule.end_pattern or (rules[k + 1].start_pattern if k + 1 < len(rules) else None)
        stop = start + _find(rest, until) if until else F.length(text)
        start_line = _line_ends(F.substring(text, F.lit(1), start)) + 1
        end_line = _line_ends(F.substring(text, F.lit(1), stop)) if until else F.size(lines(text))
        kind = "End" if rule.end_pattern else "Start"
        problem = F.when(start.isNull(), f"Start pattern not found: {rule.start_pattern}").when(stop.isNull(), f"{kind} pattern not found: {until}")
        content = F.array_join(F.slice(lines(text), start_line, F.greatest(end_line - start_line + 1, F.lit(0))), "\n")
        each.append(F.struct(F.lit(k + 1).alias("chapter_pos"), F.lit(rule.id).alias("chapter_id"), F.lit(rule.title).alias("title"), start_line.alias("start_line"), end_line.alias("end_line"), content.alias("content"), problem.alias("problem")))
    return F.array(*each)


def ambiguous(chapters: DataFrame, mode: str = "auto") -> DataFrame:
    """(book_id, chapter_id, chapter_pos, warning): short, long, generic title, overlap with the next chapter by start."""
    sized = chapters.withColumn("words", count_markdown_words("content"))
    generic = F.col("title").rlike(r"(?id)^(?:(?:chapter|section|part) \p{Nd}+|untitled)$") if mode == "auto" else F.lit(False)
    ahead = F.lead("start_line").over(Window.partitionBy("book_id").orderBy("start_line", "chapter_pos"))
    found = sized.select(
        "book_id", "chapter_id", "chapter_pos",
        F.array_compact(F.array(F.when(F.col("words") < SHORT, "short"), F.when(F.col("words") > LONG, "long"), F.when(generic, "generic_title"), F.when(F.col("end_line") >= ahead, "overlap"))).alias("w"),
    )
    return found.select("book_id", "chapter_id", "chapter_pos", F.explode("w").alias("warning"))


def chapter_metadata(chapters: DataFrame) -> DataFrame:
    """The metadata row of each chapter as it is written."""
    return chapters.select(
        "book_id", "chapter_pos", "chapter_id", "title",
        F.concat(F.lit("chapters/"), "chapter_id", F.lit(".md")).alias("source_path"), F.concat(F.lit("translated/"), "chapter_id", F.lit(".md")).alias("translated_path"),
        F.lit("chunked").alias("status"), count_markdown_words("content").alias("word_count"), F.lit(0).alias("chunk_count"),
    )


def write_chapters(chapters: DataFrame, path: str, force: bool = False) -> None:
    """Refuses to touch an existing table unless forced."""
    chapters.write.mode("overwrite" if force else "errorifexists").partitionBy("book_id").parquet(path)
