"""Markdown blocks: an ordered scan of a chapter's lines with one line of look-ahead.

The scan is stateful, so it runs as a Python function of a text; what can be said
about a line alone is a Catalyst expression elsewhere. The function goes row by row:
an Arrow batch would hold 10,000 texts or 64 MB of them, and as much again in blocks,
for each core; a pickled one holds 100 rows (spark.sql.execution.python.udf.maxRecordsPerBatch).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from quire.functions.text import LIST_MARKER, blank, collapse, let, lines, py_strip

BLOCK = ArrayType(StructType().add("pos", "integer").add("type", "string").add("content", "string").add("level", "integer"))
_HEADING = re.compile(r"(#{1,6})\s+(.+)$")
_HEADING_START = re.compile(r"#{1,6}\s+")
_ITEM = re.compile(r"(\s*)(?:[-*+]|\d+\.)\s+")
FENCES = ("```", "~~~")


class _Scanner:
    """A cursor over lines; each take_* method consumes one block."""

    def __init__(self, text: str):
        self.rows = text.split("\n")
        self.bare = [r.strip() for r in self.rows]
        self.at = 0

    def _while(self, keeps) -> str:
        start = self.at
        while self.at < len(self.rows) and keeps(self.at):
            self.at += 1
        return "\n".join(self.rows[start : self.at])

    def opens(self, k: int) -> str | None:
        """The kind of block that line k opens, None for a paragraph or blank line."""
        bare = self.bare[k]
        if bare.startswith(FENCES):
            return "code_block"
        if _HEADING.match(self.rows[k]):
            return "heading"
        if bare.startswith(">"):
            return "quote"
        return "list" if _ITEM.match(self.rows[k]) else None

    def take_code(self) -> str:
        fence, start = self.bare[self.at][:3], self.at
        close = next((k for k in range(start + 1, len(self.rows)) if self.bare[k].startswith(fence)), len(self.rows) - 1)
        self.at = close + 1
        return "\n".join(self.rows[start : self.at])

    def take_list(self) -> str:
        indent = " " * (len(_ITEM.match(self.rows[self.at])[1]) + 2)

        def belongs(k: int) -> bool:
            return bool(_ITEM.match(self.rows[k])) or (self.rows[k].startswith(indent) and bool(self.bare[k]))

        return self._while(lambda k: belongs(k) or (not self.bare[k] and k + 1 < len(self.rows) and belongs(k + 1)))

    def take_paragraph(self) -> str:
        first = self.at
        return self._while(lambda k: k == first or (self.bare[k] and self.opens(k) is None and not _HEADING_START.match(self.rows[k])))

    def blocks(self) -> Iterator[tuple[str, str, int | None]]:
        while self.at < len(self.rows):
            kind = self.opens(self.at)
            if kind == "heading":
                row = self.rows[self.at]
                self.at += 1
                yield kind, row, len(_HEADING.match(row)[1])
            elif kind == "code_block":
                yield kind, self.take_code(), None
            elif kind == "quote":
                yield kind, self._while(lambda k: self.bare[k].startswith(">")), None
            elif kind == "list":
                yield kind, self.take_list(), None
            elif not self.bare[self.at]:
                self.at += 1
            else:
                yield "paragraph", self.take_paragraph(), None


def parse_blocks(text: str | None) -> list[tuple[str, str, int | None]]:
    """(type, content, level) of every block of a text."""
    return list(_Scanner(text).blocks()) if text and text.strip() else []


def parse_placed(text: str | None) -> list[tuple[str, str, int]]:
    """(type, content, first line, from one) of every block of a text."""
    if not text or not text.strip():
        return []
    scan = _Scanner(text)
    return [(kind, content, scan.at - content.count("\n")) for kind, content, _ in scan.blocks()]


PLACED = ArrayType(StructType().add("type", "string").add("content", "string").add("line", "integer"))


@F.udf(PLACED, useArrow=False)
def placed_array(text: str | None) -> list[tuple]:
    return parse_placed(text)


@F.udf(BLOCK, useArrow=False)
def block_array(text: str | None) -> list[tuple]:
    return [(k, *block) for k, block in enumerate(parse_blocks(text))]


def markdown_blocks(chapters: DataFrame, text: str = "content") -> DataFrame:
    """The rows' other columns with (pos, type, content, level) of each block."""
    keys = [c for c in chapters.columns if c != text]
    return chapters.select(*keys, F.inline(block_array(F.col(text))))


def list_items(content: Column, kind: Column | None = None) -> Column:
    """Items of a list block: each marker line starts one, also nested; lines before the first are dropped. Other blocks are one item."""

    def cut(s: Column) -> Column:
        rows, marks = s["rows"], s["marks"]
        return F.transform(marks, lambda m, k: F.array_join(F.slice(rows, m + 1, F.coalesce(F.get(marks, k + 1), F.size(rows)) - m), "\n"))

    def marked(rows: Column) -> Column:
        return F.filter(F.transform(rows, lambda x, i: F.when(x.rlike(f"^{LIST_MARKER}"), i)), lambda i: i.isNotNull())

    items = let(lines(content), lambda rows: let(F.struct(rows.alias("rows"), marked(rows).alias("marks")), cut))
    return items if kind is None else F.when(kind == "list", items).otherwise(F.array(content))


def paragraphs(text: Column) -> Column:
    """Paragraphs between empty lines, white space collapsed, without headings and fences."""
    found = F.transform(F.split(text, "\n\n", -1), py_strip)
    return F.transform(F.filter(found, lambda x: ~blank(x) & ~x.startswith("#") & ~x.startswith("```")), collapse)
