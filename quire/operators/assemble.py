"""Assembly of chapters from translated chunks, with what is missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import blank, py_strip

WAITING = ("pending", "chunked", "error")
KEYS = ("book_id", "chapter_id")


def missing_sequences(chunks: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """(keys, sequence): gaps from 1 to each chapter's largest sequence."""
    want = chunks.groupBy(*keys).agg(F.max("sequence").alias("top")).select(*keys, F.explode(F.sequence(F.lit(1), F.col("top"))).alias("sequence"))
    return want.join(chunks.select(*keys, "sequence"), [*keys, "sequence"], "left_anti")


def assemble(chunks: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """(keys, content, missing, success) per chapter; what is there is assembled even if some is missing.

    ``missing`` lists gaps, waiting chunks and chunks without text, in order and
    once each. One pass: the chapter's chunks are collected as an ordered array,
    which is as large as the chapter.
    """
    label = F.concat("chapter_id", F.lit("_"), F.format_string("%04d", "sequence"))
    state = F.coalesce("status", F.lit("pending"))
    notes = F.array_compact(F.array(
        F.when(state.isin(*WAITING), F.concat(label, F.lit(": status is "), state)),
        F.when(F.col("translation").isNull(), F.concat(label, F.lit(": missing text"))).when(blank("translation"), F.concat(label, F.lit(": empty translation"))),
    ))
    text = F.when(~blank("translation"), py_strip("translation"))
    rows = chunks.select(*keys, F.struct("sequence", text.alias("text"), notes.alias("notes")).alias("c"))
    found = rows.groupBy(*keys).agg(F.array_sort(F.collect_list("c")).alias("c"))
    have = F.transform("c", lambda c: c["sequence"])
    gaps = F.array_except(F.sequence(F.lit(1), F.greatest(F.array_max(have), F.lit(1))), have)
    named = F.transform(gaps, lambda g: F.concat("chapter_id", F.lit("_"), F.format_string("%04d", g), F.lit(": missing chunk")))
    missing = F.array_distinct(F.concat(named, F.flatten(F.transform("c", lambda c: c["notes"]))))
    texts = F.filter(F.transform("c", lambda c: c["text"]), lambda t: t.isNotNull())
    content = F.when(F.size(texts) > 0, F.concat(F.array_join(texts, "\n\n"), F.lit("\n")))
    return found.select(*keys, content.alias("content"), missing.alias("missing")).withColumn("success", (F.size("missing") == 0) & F.col("content").isNotNull())


def with_untouched(chapters: DataFrame, assembled: DataFrame, existing: DataFrame | None = None, force: bool = False) -> DataFrame:
    """Every chapter: those without chunks miss them; those already assembled are refused unless forced."""
    out = chapters.select("book_id", "chapter_id").join(assembled, list(KEYS), "left")
    none = F.array(F.concat("chapter_id", F.lit(": no chunks")))
    out = out.select("book_id", "chapter_id", "content", F.coalesce("missing", none).alias("missing"), F.coalesce("success", F.lit(False)).alias("success"), F.lit(None).cast("string").alias("warning"))
    if existing is None or force:
        return out
    there = existing.select(*KEYS, F.lit(True).alias("there")).distinct()
    out = out.join(there, list(KEYS), "left")
    kept = F.col("there").isNotNull()
    return out.select(*KEYS, F.when(~kept, F.col("content")).alias("content"), F.when(kept, F.array().cast("array<string>")).otherwise(F.col("missing")).alias("missing"), (~kept & F.col("success")).alias("success"), F.when(kept, "already assembled").alias("warning"))


def statuses(assembled: DataFrame, metadata: DataFrame) -> DataFrame:
    """(keys, status): translated on success, else chunked unless the chapter is in error."""
    joined = metadata.select(*KEYS, "status").join(assembled.select(*KEYS, "success"), list(KEYS), "left")
    return joined.select(*KEYS, F.when(F.col("success").isNull(), F.col("status")).when(F.col("success"), "translated").when(F.col("status") == "error", "error").otherwise("chunked").alias("status"))


def project_stage(assembled: DataFrame) -> DataFrame:
    """(book_id, stage): done if all chapters succeeded."""
    return assembled.groupBy("book_id").agg(F.when(F.bool_and("success"), "done").otherwise("error").alias("stage"))


def missing_report(assembled: DataFrame) -> DataFrame:
    """(keys, section) of incomplete chapters."""
    items = F.array_join(F.transform("missing", lambda m: F.concat(F.lit("- "), m)), "\n")
    return assembled.where(F.size("missing") > 0).select(*KEYS, F.concat(F.lit("## "), "chapter_id", F.lit("\n\n"), items, F.lit("\n")).alias("section"))


def stable_distinct(items: Column) -> Column:
    return F.array_distinct(items)
