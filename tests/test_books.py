"""Normalisation, chapters, blocks and chunks."""

import pytest
from pyspark.sql import functions as F

from quire.operators import blocks as B
from quire.operators import chapters as C
from quire.operators import chunking as H
from quire.operators import normalize as N


def book(spark, *texts):
    return spark.createDataFrame([(f"b{k}", t) for k, t in enumerate(texts)], "book_id string, md string")


def of(spark, expression, md):
    return book(spark, md).select(expression.alias("x")).first()[0]


@pytest.mark.parametrize(
    "line, gone",
    [("Page 4", True), ("page 12", True), ("  7 |", True), ("| 8", True), ("- 9 -", True), ("1234", True), ("12345", False), ("PAGE 4", False), ("Page four", False), ("", False), ("4.", False)],
)
def test_page_numbers(spark, line, gone):
    assert of(spark, N.remove_page_numbers(F.col("md")), f"a\n{line}\nb") == ("a\nb" if gone else f"a\n{line}\nb")


@pytest.mark.parametrize("text, want", [("exam-\nple", "example"), ("сло-\n  во", "слово"), ("a-\nb-\nc", "ab-\nc"), ("well-known", "well-known"), ("end -\nnext", "end -\nnext"), ("a-\n\n b", "ab")])
def test_hyphens(spark, text, want):
    assert of(spark, N.join_hyphenated_words(F.col("md")), text) == want


def test_headers_are_found_stripped_and_blanked_as_they_stand(spark):
    md = "Head\none\nHead\ntwo\n Head \nthree\n# T\n# T\n# T\n" + "\n".join(["x" * 85] * 3)
    found = {tuple(r) for r in N.detect_headers_footers(book(spark, md)).select("pattern", "n", "first_pos").collect()}
    assert found == {("Head", 3, 0)}
    out = of(spark, N.blank_patterns(F.col("md"), N.header_footer_patterns(F.col("md"))), md).split("\n")
    assert out[:6] == ["", "one", "", "two", " Head ", "three"]


def test_patterns_keep_the_order_of_the_text(spark):
    assert of(spark, N.header_footer_patterns(F.col("md")), "z\na\nz\na\nz\na\nb") == ["z", "a"]
    assert of(spark, N.header_footer_patterns(F.col("md")), "a\nb") == []


def test_normalize_whole(spark):
    md = "Header\nText one-\ntwo\nPage 1\nHeader\n\n\n\n\n\nEnd\nHeader"
    assert N.normalize(book(spark, md)).first()["md"] == "\nText onetwo\n\n\nEnd\n"  # blanked lines join the empty ones
    assert N.normalize(book(spark, md), N.NormalizationConfig(False, False, False)).first()["md"] == md.replace("\n\n\n\n\n\n", "\n\n\n")
    assert N.normalize(book(spark, "")).first()["md"] == ""


def test_code_fences_can_be_protected(spark):
    md = "```\na\n```\nx\n```\nb\n```"
    assert "```" not in N.normalize(book(spark, md)).first()["md"]
    assert N.normalize(book(spark, md), N.NormalizationConfig(protect_code=True)).first()["md"] == md


@pytest.mark.parametrize(
    "line, kind",
    [("# Foreword", "foreword"), ("# PREFACE to it", "foreword"), ("# Introduction to X", "foreword"), ("# Foreword: X", "chapter"), ("# Acknowledgements", "acknowledgments"), ("# Thanks all", "acknowledgments"), ("# Appendix: A", "appendix"), ("# Appendix1", "appendix"), ("# Appendixes", "chapter"), ("# Notes", "notes"), ("# Endnote", "notes"), ("# Глава 1", "chapter")],
)
def test_section_types(spark, line, kind):
    row = N.chapter_boundaries(book(spark, f"x\n{line}\n## sub\n#no")).first()
    assert (row["line_number"], row["chapter_type"], row["title"]) == (2, kind, line[2:])


BOOK = "lost\n# Foreword\nf\n# Acknowledgments\n# One\n## s\nx\n# Two\n# Appendix A\na\n# Appendix B\n# Notes\nn\n"


def test_chapters_and_ids(spark):
    rows = C.split_auto(book(spark, BOOK)).orderBy("chapter_pos").collect()
    assert [r["chapter_id"] for r in rows] == ["00_foreword", "00_acknowledgments", "01_chapter", "02_chapter", "16_appendix", "17_appendix", "19_notes"]
    assert [(r["start_line"], r["end_line"]) for r in rows] == [(2, 3), (4, 4), (5, 7), (8, 8), (9, 10), (11, 11), (12, 14)]
    assert "\n".join(r["content"] for r in rows) == BOOK.partition("\n")[2]


def test_book_without_headings_is_one_chapter(spark):
    row = C.split_auto(book(spark, "a\nb")).first()
    assert (row["chapter_id"], row["title"], row["start_line"], row["end_line"], row["content"]) == ("01_chapter", "Chapter 1", 1, 2, "a\nb")


def test_manual_rules(spark):
    rules = [C.ChapterRule("a", "A", "^PART 1"), C.ChapterRule("b", "B", "^PART 2", "^END"), C.ChapterRule("c", "C", "^PART 3")]
    md = "x\nPART 1\none\nPART 2\ntwo\nEND\nPART 3\nz"
    rows = C.split_manual(book(spark, md), rules).orderBy("chapter_pos").collect()
    assert [(r["start_line"], r["end_line"], r["content"]) for r in rows] == [(2, 3, "PART 1\none"), (4, 5, "PART 2\ntwo"), (7, 8, "PART 3\nz")]
    row = C.split_manual(book(spark, md), [C.ChapterRule("d", "D", "^NO")]).first()
    assert row["problem"] == "Start pattern not found: ^NO"
    row = C.split_manual(book(spark, md), [C.ChapterRule("d", "D", "^PART 1", "^NO")]).first()
    assert row["problem"] == "End pattern not found: ^NO"


@pytest.mark.parametrize("text, said", [("{", "not valid JSON"), ("{}", "no 'chapters'"), ('{"chapters": []}', "no chapters"), ('{"chapters": [{"id": "a", "title": "t"}]}', "lacks start_pattern")])
def test_bad_rules(text, said):
    with pytest.raises(ValueError, match=said):
        C.load_rules(text)


def test_good_rules():
    assert C.load_rules('{"chapters": [{"id": "a", "title": "t", "start_pattern": "^x"}]}') == [C.ChapterRule("a", "t", "^x")]


def test_ambiguous(spark):
    rows = [("b", "1", 1, "Chapter 3", 1, 10, "few words"), ("b", "2", 2, "Own title", 5, 20, "w " * 10001), ("b", "3", 3, "untitled", 30, 40, "w " * 200)]
    found = C.ambiguous(spark.createDataFrame(rows, "book_id string, chapter_id string, chapter_pos int, title string, start_line int, end_line int, content string"))
    assert {tuple(r) for r in found.select("chapter_id", "warning").collect()} == {("1", "short"), ("1", "generic_title"), ("1", "overlap"), ("2", "long"), ("3", "generic_title")}


def test_blocks():
    md = "# T\npara one\npara two\n- a\n  - b\n\n- c\n    more\n\n> q1\n> q2\n```py\n# no\n\n~~~\n```\n1. x\ntext\n~~~\nopen"
    assert [(a, c) for a, _, c in B.parse_blocks(md)] == [("heading", 1), ("paragraph", None), ("list", None), ("quote", None), ("code_block", None), ("list", None), ("paragraph", None), ("code_block", None)]
    assert B.parse_blocks(md)[2][1] == "- a\n  - b\n\n- c\n    more"
    assert B.parse_blocks(md)[-1][1] == "~~~\nopen"
    assert B.parse_blocks(" \n ") == [] and B.parse_blocks(None) == []


def test_blocks_in_a_table(spark):
    rows = B.markdown_blocks(book(spark, "# A\n\nx", None), "md").orderBy("pos").collect()
    assert [(r["book_id"], r["pos"], r["type"], r["level"]) for r in rows] == [("b0", 0, "heading", 1), ("b0", 1, "paragraph", None)]


def test_list_items(spark):
    assert of(spark, B.list_items(F.col("md")), "lead\n- a\n  - b\n    c\n2. d") == ["- a", "  - b\n    c", "2. d"]
    assert of(spark, B.list_items(F.col("md"), F.lit("quote")), "> x") == ["> x"]


def greedy(units, limit, gap):
    out = []
    for u in units:
        if out and len(out[-1]) + len(gap) + len(u) <= limit:
            out[-1] += gap + u
        else:
            out.append(u)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_packing_is_greedy(spark, seed):
    import random

    rng = random.Random(seed)
    units = ["x" * rng.randint(1, 60) for _ in range(rng.randint(0, 40))]
    frame = spark.createDataFrame([(units,)], "u array<string>")
    assert frame.select(H.pack_units(F.col("u"), 50)).first()[0] == [g + "\n" for g in greedy(units, 50, "\n\n")]
    text = " ".join(units)
    assert book(spark, text).select(H.split_paragraph(F.col("md"), 50)).first()[0] == (greedy(units, 50, " ") if len(text) > 50 else [text])


def chapter(spark, content):
    return spark.createDataFrame([("b", 1, "01_chapter", content)], "book_id string, chapter_pos int, chapter_id string, content string")


def test_chunks_keep_headings_with_paragraphs(spark):
    rows = H.chunk(chapter(spark, "# T\n\n" + "word " * 30 + "\n\n- one item here\n- two item here\n\n```\ncode stays whole even if it is long\n```"), 40).orderBy("sequence").collect()
    assert [r["chunk_id"] for r in rows][:2] == ["01_chapter_0001", "01_chapter_0002"]
    assert rows[0]["content"].startswith("# T\n\nword")
    assert all(r["char_count"] == len(r["content"]) and r["content"].endswith("\n") for r in rows)
    assert any("code stays whole" in r["content"] and r["content"].count("```") == 2 for r in rows)
    assert H.chunk(chapter(spark, ""), 40).count() == 0
    with pytest.raises(ValueError):
        H.chunk(chapter(spark, "x"), 0)


def test_counts_and_writes(spark, tmp_path):
    ch = chapter(spark, "# T\n\ntext")
    chunks = H.chunk(ch)
    assert H.chapter_counts(ch, chunks).first()["chunk_count"] == 1
    assert H.chunk_metadata(chunks).first()["translated_path"] == "chunks/01_chapter/0001.ru.md"
    H.write_chunks(chunks, f"file://{tmp_path}/c")
    with pytest.raises(Exception, match="exist"):
        H.write_chunks(chunks, f"file://{tmp_path}/c")
    H.write_chunks(chunks, f"file://{tmp_path}/c", force=True)
    assert spark.read.parquet(f"file://{tmp_path}/c").count() == 1


def test_texts_go_to_python_in_bounded_batches(spark):
    from quire.operators import positions, render

    rows = spark.createDataFrame([("b", 1, "01", 1, "# A\n\ntext")], "book_id string, chapter_pos int, chapter_id string, start_line int, content string")
    for found in (H.chunk(rows), B.markdown_blocks(rows), positions.chunk_lines(rows), rows.select(render.markdown_to_html("content"))):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan


def test_a_book_is_replaced_whole(spark, tmp_path):
    rows = spark.createDataFrame([(b, c, 1, f"{b} {c}") for b in ("a", "b") for c in ("01", "02")], "book_id string, chapter_id string, sequence int, content string")
    H.write_chunks(rows, f"file://{tmp_path}/c")
    assert len(list(tmp_path.glob("c/*/*.parquet"))) >= 2 and not list(tmp_path.glob("c/*/chapter_id=*"))
    H.write_chunks(rows.where("book_id = 'a' AND chapter_id = '01'"), f"file://{tmp_path}/c", force=True)
    assert sorted(r["content"] for r in spark.read.parquet(f"file://{tmp_path}/c").collect()) == ["a 01", "b 01", "b 02"]
