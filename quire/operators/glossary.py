"""Glossaries: markdown tables, and the merge of a project's over a shared one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import SPACE, lines, py_strip

SEPARATOR = rf"^[{SPACE}]*\|?[{SPACE}\-:|]+\|?[{SPACE}]*$"
NONE = "- no glossary terms"


def split_row(line: Column) -> Column:
    """Cells of a table row, stripped; one outer bar on each side is not a border of cells."""
    bare = F.regexp_replace(F.regexp_replace(py_strip(line), r"^\|", ""), r"\|$", "")
    return F.transform(F.split(bare, r"\|", -1), py_strip)


def parse_tables(glossaries: DataFrame, key: str = "book_id", text: str = "md") -> DataFrame:
    """(key, pos, english, russian, notes) of all tables that name both languages in their header.

    A table goes on until a blank line, a line without a bar, or a heading.
    """
    w = Window.partitionBy(key).orderBy("pos")
    rows = glossaries.select(key, F.posexplode(lines(text)).alias("pos", "line")).withColumn("line", py_strip("line"))
    table = (F.col("line") != "") & F.col("line").contains("|") & ~F.col("line").startswith("#")
    low = F.transform(split_row(F.col("line")), F.lower)

    def place(test) -> Column:
        """The last matching cell."""
        at = F.filter(F.transform(low, lambda c, i: F.when(test(c), i)), lambda i: i.isNotNull())
        return F.when(F.size(at) > 0, F.element_at(at, -1))

    def russian(c: Column) -> Column:
        return ~c.contains("english") & (c.contains("russian") | c.contains("русский"))

    def note(c: Column) -> Column:
        return ~c.contains("english") & ~russian(c) & (c.contains("note") | c.contains("usage") | c.contains("правило"))

    rows = rows.withColumn("table", table & ~F.col("line").startswith("<!--"))
    rows = rows.withColumn("run", F.sum(F.when(table, 0).otherwise(1)).over(w))
    names = F.struct(place(lambda c: c.contains("english")).alias("e"), place(russian).alias("r"), place(note).alias("n"))
    rows = rows.withColumn("names", F.when(F.col("table") & names["e"].isNotNull() & names["r"].isNotNull(), names))
    head = F.first("names", ignorenulls=True).over(Window.partitionBy(key, "run").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1))
    body = rows.withColumn("head", head).where(table & F.col("head").isNotNull() & ~F.col("line").rlike(SEPARATOR)).withColumn("cells", split_row(F.col("line")))
    body = body.where(F.size("cells") > F.greatest("head.e", "head.r"))
    cell = lambda k: F.get("cells", F.col(f"head.{k}"))
    return body.select(key, "pos", cell("e").alias("english"), cell("r").alias("russian"), F.coalesce(cell("n"), F.lit("")).alias("notes")).where((F.col("english") != "") | (F.col("russian") != ""))


def usable(entries: DataFrame) -> DataFrame:
    """Terms with both languages."""
    return entries.where((F.col("english") != "") & (F.col("russian") != ""))


def _latest(entries: DataFrame, order: str) -> DataFrame:
    """The last entry of each term, by its lower-cased English."""
    return entries.groupBy(F.lower("english").alias("term")).agg(F.max_by(F.struct("english", "russian", "notes"), order).alias("g")).select("term", "g.*")


def merge(root: DataFrame, project: DataFrame, order: str = "pos") -> DataFrame:
    """(term, english, russian, notes, source): the project's entry where it has one."""
    a, b = _latest(root, order).alias("a"), _latest(project, order).alias("b")
    own = F.col("b.term").isNotNull()
    joined = a.join(b, F.col("a.term") == F.col("b.term"), "full")
    return joined.select(F.coalesce("b.term", "a.term").alias("term"), *(F.when(own, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c) for c in ("english", "russian", "notes")), F.when(own, "project").otherwise("root").alias("source"))


def conflicts(root: DataFrame, project: DataFrame, order: str = "pos") -> DataFrame:
    """(term, conflict): terms that the project translates otherwise."""
    a, b = _latest(root, order).alias("a"), _latest(project, order).alias("b")
    return a.join(b, F.col("a.term") == F.col("b.term")).where(F.col("a.russian") != F.col("b.russian")).select(F.col("a.term").alias("term"), F.format_string("%s: root='%s' project='%s'", "b.english", "a.russian", "b.russian").alias("conflict"))


def prompt_text(merged: DataFrame) -> DataFrame:
    """One row: the glossary as it stands in a prompt, sorted by term."""
    line = F.concat(F.lit("- "), "english", F.lit(" -> "), "russian", F.when(F.col("notes") != "", F.concat(F.lit(" ("), "notes", F.lit(")"))).otherwise(""))
    return merged.agg(F.coalesce(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("term", line.alias("line")))), lambda x: x["line"]), "\n"), F.lit("")).alias("glossary")).select(F.when(F.col("glossary") == "", NONE).otherwise(F.col("glossary")).alias("glossary"))
