"""Glossaries, translation, assembly, review, publishing, state, pipeline."""

import json

import pytest
from pyspark.sql import functions as F

from quire.operators import assemble as A
from quire.operators import glossary as G
from quire.operators import publish as P
from quire.operators import render
from quire.operators import review as R
from quire.operators import state as L
from quire.operators import translate as TR
from quire.plans.pipeline import Pipeline, main
from quire.sources import books as S
from quire.streaming.incremental import CHUNK, translate_stream

CHUNK_ROW = "book_id string, chapter_id string, chunk_id string, sequence int, content string, status string, translation string"


def chunk_rows(spark, *rows):
    """(sequence, status, translation)"""
    return spark.createDataFrame([("b", "01", f"01_{n:04d}", n, f"p{n} one\n\nlast of {n}", s, t) for n, s, t in rows], CHUNK_ROW)


def test_glossary_tables(spark):
    md = "# G\n\n| English | Русский | Usage |\n|---|---|---|\n| C++ | Си | n |\n| | | |\n| Short |\n| Only | | x |\n\ntext | no\n| Russian | English |\n| раз | one |\n# end\n| Notes | x |"
    rows = G.parse_tables(spark.createDataFrame([("b", md)], "book_id string, md string")).orderBy("pos").collect()
    assert [(r["english"], r["russian"], r["notes"]) for r in rows] == [("C++", "Си", "n"), ("Only", "", "x"), ("one", "раз", "")]


def test_glossary_merge(spark):
    schema = "pos int, english string, russian string, notes string"
    root = spark.createDataFrame([(0, "Job", "a", ""), (1, "job", "b", "n"), (2, "Only", "c", "")], schema)
    own = spark.createDataFrame([(0, "JOB", "d", ""), (1, "New", "e", "")], schema)
    merged = {r["term"]: (r["english"], r["russian"], r["source"]) for r in G.merge(root, own).collect()}
    assert merged == {"job": ("JOB", "d", "project"), "only": ("Only", "c", "root"), "new": ("New", "e", "project")}
    assert [r["conflict"] for r in G.conflicts(root, own).collect()] == ["JOB: root='b' project='d'"]
    assert G.prompt_text(G.merge(root, own)).first()[0].split("\n")[0] == "- JOB -> d"
    assert G.prompt_text(G.merge(root.limit(0), own.limit(0))).first()[0] == G.NONE


def test_context_is_the_neighbours_source(spark):
    rows = TR.with_context(chunk_rows(spark, (1, "pending", None), (2, "pending", None), (3, "pending", None))).orderBy("sequence").collect()
    assert [(r["previous_summary"], r["next_summary"]) for r in rows] == [(None, "p2 one"), ("last of 1", "p3 one"), ("last of 2", None)]


def test_truncation(spark):
    out = spark.createDataFrame([("a" * 498 + "  bcd",), ("short",)], "t string").select(TR.truncate_context(F.col("t"))).collect()
    assert out[0][0] == "a" * 498 + "…" and out[1][0] == "short"


def test_eligibility(spark):
    rows = chunk_rows(spark, (1, "pending", None), (2, "error", ""), (3, "approved", None), (4, "pending", "text"), (5, None, " "))
    s, t = F.col("status"), F.col("translation")
    assert [r[0] for r in rows.where(TR.should_translate(s, t)).orderBy("sequence").select("sequence").collect()] == [1, 5]
    assert [r[0] for r in rows.where(TR.should_translate(s, t, retry_failed=True)).orderBy("sequence").select("sequence").collect()] == [1, 2, 5]
    assert rows.where(TR.should_translate(s, t, force=True)).count() == 5
    status = TR.chat_status(rows).first()
    assert (status["total"], status["translated"], status["pending"], status["error"], status["next_chunk_id"]) == (5, 2, 2, 1, "01_0001")
    assert TR.select_chunk(rows)["sequence"] == 1 and TR.select_chunk(rows, "01_0003")["sequence"] == 3
    with pytest.raises(ValueError):
        TR.select_chunk(rows, "none")
    with pytest.raises(ValueError):
        TR.select_chunk(rows.limit(0))


class Failing:
    def translate(self, prompt):
        if "p2" in prompt:
            raise RuntimeError("down")
        return "ok\n"


def test_a_failing_chunk_is_a_row(spark):
    rows = chunk_rows(spark, (1, "pending", None), (2, "pending", None))
    done = TR.translate(rows.select("book_id", "chunk_id", F.col("content").alias("prompt")), Failing)
    assert sorted(tuple(r) for r in done.select("chunk_id", "translation", "status", "error").collect()) == [("01_0001", "ok\n", "translated", None), ("01_0002", None, "error", "down")]
    after = TR.apply_updates(rows, done, ["book_id", "chunk_id"])
    assert TR.chapter_statuses(after).first()["status"] == "error"
    assert TR.error_report(done).count() == 1


def test_echo_is_the_same_natively_and_as_a_provider(spark):
    prompt = TR.prompt(F.lit("g"), F.lit("t"), F.lit(None).cast("string"), F.lit(" "), F.col("content"))
    row = chunk_rows(spark, (1, "pending", None)).select(prompt.alias("p"), TR.echo(F.col("content")).alias("e")).first()
    assert TR.EchoProvider().translate(row["p"]) == row["e"]
    assert TR.FIRST in row["p"] and TR.LAST in row["p"]
    with pytest.raises(ValueError):
        TR.prompt(F.lit(""), F.lit(""), F.lit(""), F.lit(""), F.lit(""), "loud")


def test_providers(monkeypatch):
    assert isinstance(TR.create_provider("echo"), TR.EchoProvider)
    with pytest.raises(ValueError):
        TR.create_provider("nobody")
    monkeypatch.setenv("LOCAL_LLM_URL", "http://127.0.0.1:9/")
    with pytest.raises(RuntimeError):
        TR.create_provider("local").translate("x")


def test_saving_by_hand(spark):
    rows = chunk_rows(spark, (1, "pending", None), (2, "pending", None))
    out = TR.save_translation(rows, ["book_id", "chunk_id"], ("b", "01_0002"), " text ").orderBy("sequence").collect()
    assert [(r["status"], r["translation"], r["translation_mode"]) for r in out] == [("pending", None, None), ("translated", "text\n", "chat")]
    with pytest.raises(ValueError):
        TR.save_translation(rows, ["chunk_id"], ("x",), " ")


def test_latest_event_counts(spark):
    events = spark.createDataFrame([("c", "old", 1), ("c", "new", 2), ("d", "x", 1)], "chunk_id string, translation string, at int")
    assert {r["chunk_id"]: r["translation"] for r in TR.current_state(events, ["chunk_id"]).collect()} == {"c": "new", "d": "x"}


def test_assembly(spark):
    rows = chunk_rows(spark, (1, "translated", " a "), (3, "pending", ""), (4, "translated", None))
    row = A.assemble(rows).first()
    assert row["content"] == "a\n" and not row["success"]
    assert row["missing"] == ["01_0002: missing chunk", "01_0003: status is pending", "01_0003: empty translation", "01_0004: missing text"]
    assert [r["sequence"] for r in A.missing_sequences(rows).collect()] == [2]
    good = A.assemble(chunk_rows(spark, (1, "translated", "a"), (2, "approved", "b\n")))
    assert good.first()["content"] == "a\n\nb\n" and good.first()["success"]
    chapters = spark.createDataFrame([("b", "01", "chunked"), ("b", "02", "error")], "book_id string, chapter_id string, status string")
    every = A.with_untouched(chapters, good)
    assert {r["chapter_id"]: r["success"] for r in every.collect()} == {"01": True, "02": False}
    assert {r["chapter_id"]: r["status"] for r in A.statuses(every, chapters).collect()} == {"01": "translated", "02": "error"}
    assert A.project_stage(every).first()["stage"] == "error"
    again = A.with_untouched(chapters, good, existing=good).where("chapter_id = '01'").first()
    assert not again["success"] and again["warning"] and again["missing"] == []
    assert A.with_untouched(chapters, good, existing=good, force=True).where("chapter_id = '01'").first()["success"]
    assert A.missing_report(every).first()["section"].startswith("## 02")


PAIR = "book_id string, chapter_pos int, chapter_id string, content string"


def issues_of(spark, source, translated):
    a = spark.createDataFrame([("b", 1, "01", source)], PAIR)
    b = spark.createDataFrame([("b", 1, "01", translated)] if translated is not None else [], PAIR)
    return sorted(r["check_id"] for r in R.structural(R.pairs(a, b)).collect())


@pytest.mark.parametrize(
    "source, translated, found",
    [("# A", None, ["missing"]), ("# A", " ", ["empty", "heading_count"]), ("# A\n## B", "# A", ["heading_count"]), ("# A\n## B", "# A\n# B", ["heading_levels"]), ("- a", "a", ["lists"]), ("> a", "a", ["quotes"]), ("a", "a b c d", ["size"]), ("# A\n- x", "# Б\n- y", [])],
)
def test_structural_checks(spark, source, translated, found):
    assert issues_of(spark, source, translated) == found


def test_review_and_score(spark):
    a = spark.createDataFrame([("b", 1, "01", "# A ![x](i.png) ![y](j.png)")], PAIR)
    b = spark.createDataFrame([("b", 1, "01", "# A ![x](i.png)\nthese are five English words left here\nhttp://skip these many English words please")], PAIR)
    terms = spark.createDataFrame([("Job", "Работа"), ("English", "x"), ("", "z")], "english string, russian string")
    chunks = chunk_rows(spark, (1, "pending", None), (2, "approved", "ok"))
    issues = R.review(a, b, chunks, terms)
    assert sorted(r["check_id"] for r in issues.collect()) == ["chunk_status", "chunk_text", "english", "image", "term_absent"]
    books = spark.createDataFrame([("b", ""), ("c", "")], "book_id string, md string")
    assert {r["book_id"]: r["score"] for r in R.score(issues, books).collect()} == {"b": 69.0, "c": 100.0}
    assert "Score: 69.0" in R.report(issues, R.score(issues)).first()["report"]
    many = issues.crossJoin(spark.range(50)).drop("id")
    assert R.score(many).first()["score"] == 0.0


def test_published(spark):
    rows = spark.createDataFrame([("b", 1, "00_foreword", "F", "# Intro\nx y"), ("b", 2, "01_chapter", "One", "no title"), ("b", 3, "16_appendix", "A", "t"), ("b", 4, "extra", "E", "t")], "book_id string, chapter_pos int, chapter_id string, title string, content string")
    out = P.neighbours(P.published(rows)).orderBy("chapter_pos").collect()
    assert [(r["label"], r["title"], r["previous_id"], r["next_id"]) for r in out] == [("00", "Intro", None, "01_chapter"), ("01", "One", "00_foreword", "16_appendix"), ("A16", "A", "01_chapter", "extra"), ("04", "E", "16_appendix", None)]
    assert P.search(P.published(rows), " INTRO ").count() == 1 and P.search(P.published(rows), "").count() == 4
    with pytest.raises(Exception, match="no translation"):
        P.published(rows.withColumn("content", F.lit(None).cast("string"))).collect()


def test_figures(spark):
    md = "![Figure 2](x)\n**Рис. 1. a**\n**Рис. 1. b**\n**Рис. 2. c**\n**Рис. 40. d**"
    out = spark.createDataFrame([(md,)], "md string").select(P.inject_figures(F.col("md"))).first()[0]
    assert out == md.replace("**Рис. 1. a**", "![Рис. 1](images/imageFile2.png)\n\n**Рис. 1. a**")
    rows = spark.createDataFrame([("b", 1, "![alt](<a b.png>)\n\n**Рис. 3.** Some  text**\n![z](q.png)")], "book_id string, chapter_pos int, raw string")
    assert [(r["alt"], r["src"], r["caption"]) for r in P.figures(rows).orderBy("line_number").collect()] == [("alt", "a b.png", "Рис. 3. Some text"), ("z", "q.png", None)]


def test_embedded_images(spark):
    rows = spark.createDataFrame([("b", 1, "![a](images/p.png) ![b](http://x/y.png) ![c](none.png)"), ("b", 2, "plain")], "book_id string, chapter_pos int, raw string")
    images = spark.createDataFrame([("b", "source/images/p.png", bytearray(b"late")), ("b", "source/images/p.png".replace("source/", ""), bytearray(b"img"))], "book_id string, path string, content binary")
    out = {r["chapter_pos"]: r["raw"] for r in P.embed_images(rows, images).collect()}
    assert out == {1: "![a](data:image/png;base64,aW1n) ![b](http://x/y.png) ![c](none.png)", 2: "plain"}


def test_images_are_not_broadcast(spark):
    n = F.explode(F.sequence(F.lit(0), F.lit(500)))
    images = spark.range(1).groupBy("id").count().select(n.alias("n")).selectExpr("'b' AS book_id", "concat('source/images/f', n, '.png') AS path", "encode(CAST(n AS STRING), 'UTF-8') AS content")
    rows = spark.createDataFrame([("b", k, f"![x](images/f{k}.png)") for k in range(9)], "book_id string, chapter_pos int, raw string")
    found = P.embed_images(rows, images)
    assert all("base64" in r["raw"] for r in found.collect())
    joins = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in line and "path#" in line]
    assert joins and not any("Broadcast" in line for line in joins)


def test_page(spark):
    rows = spark.createDataFrame([("b", 1, "01_chapter", "One", "</script> & text")], "book_id string, chapter_pos int, chapter_id string, title string, content string")
    meta = spark.createDataFrame([("b", "T & t", "Au", "en", "ru", ("@me",))], "book_id string, title string, author string, source_language string, target_language string, translator struct<contact: string>")
    page = P.publish_page(P.published(rows), meta).first()
    assert page["file"] == "b-ru.html" and page["html"].count("</script>") == 1 and "https://t.me/me" in page["html"] and "T &amp; t" in page["html"]
    data = page["html"].partition('type="application/json">')[2].partition("</script>")[0]
    assert json.loads(data)["chapters"][0]["raw"] == "</script> & text"


def test_html():
    md = "# T *e*\n\n- a\n- **b**\n1. c\n> q `x`\n> r\ntext <b> https://a.b/c. [l](https://d.e)\n![alt](<i j.png>)\n\n**Рис. 1.** cap\n"
    html = render.to_html(md)
    assert html.split("\n")[0] == "<h1>T <em>e</em></h1>"
    assert "<ul>\n<li>a</li>\n<li><strong>b</strong></li>\n</ul>\n<ol>\n<li>c</li>\n</ol>" in html
    assert "<blockquote><p>q <code>x</code></p><p>r</p></blockquote>" in html
    assert 'text &lt;b&gt; <a href="https://a.b/c" target="_blank" rel="noopener noreferrer">https://a.b/c</a>.' in html
    assert '<img src="i j.png" alt="Рис. 1. cap"' in html
    assert render.to_html(None) == ""


def test_state(spark):
    assert L.stages_until("split") == ["extract", "normalize", "split"]
    with pytest.raises(ValueError):
        L.stages_until("cook")
    states = spark.range(1).select(F.lit("b").alias("book_id"), F.lit("extract").alias("current_stage"), L.initial_stages().alias("stages"))
    done = L.update_stage(states, "extract", "done")
    assert done.first()["current_stage"] == "normalize"
    failed = L.update_stage(done, "normalize", "error").first()
    assert failed["current_stage"] == "normalize" and failed["stages"]["normalize"] == "error" and failed["stages"]["extract"] == "done"
    meta = spark.createDataFrame([("b", None), ("c", "x")], "book_id string, title string")
    assert [tuple(r) for r in L.list_projects(meta, states).collect()] == [("b", "Untitled", "extract")]


BOOK = "# Foreword\n\nHello there.\n\n# Chapter 1\n\nSome text here.\n\n- a\n- b\n"


def test_pipeline(spark):
    books = spark.createDataFrame([("x", BOOK), ("y", BOOK)], "book_id string, md string")
    run = Pipeline(books).run()
    assert run.completed == list(L.RUNNABLE) and run.stopped_at is None
    assert run.tables["published"].count() == 4 and run.tables["assembled"].where("success").count() == 4
    slow = Pipeline(books, provider=None).run()
    assert slow.stopped_at == "translate" and "assembled" not in slow.tables
    saved = run.tables["translations"].select("book_id", "chapter_pos", "chunk_id", "translation", "status", "error")
    assert Pipeline(books, provider=None, translations=saved).run().stopped_at is None


def test_command_line(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.md").write_bytes(BOOK.replace("\n", "\r\n").encode())
    assert main([f"file://{tmp_path}/in/*.md", f"file://{tmp_path}/out"]) == 0
    assert spark.read.parquet(f"file://{tmp_path}/out/published").count() == 2
    assert main([]) == 2


def test_readers(spark, tmp_path):
    chapter = {"id": "01_chapter", "title": "T", "status": "chunked"}
    (tmp_path / "m.json").write_text(json.dumps({"book_id": "b", "title": "B", "chapters": [chapter, chapter | {"id": "02"}]}, indent=1))
    assert [r["chapter_id"] for r in S.chapter_rows(S.read_metadata(spark, f"file://{tmp_path}/m.json")).orderBy("chapter_pos").collect()] == ["01_chapter", "02"]
    (tmp_path / "images").mkdir()
    for name in ("b.png", "a.png"):
        (tmp_path / "images" / name).write_bytes(b"x")
    row = S.image_listing(S.read_images(spark, f"file://{tmp_path}/images")).first()
    assert row["image_count"] == 2 and [i["filename"] for i in row["images"]] == ["a.png", "b.png"]


def test_stream(spark, tmp_path):
    source = f"file://{tmp_path}/in"
    chunk_rows(spark, (1, "pending", None), (2, "approved", "x")).write.json(source)
    args = (spark, source, f"file://{tmp_path}/events", f"file://{tmp_path}/cp")
    translate_stream(*args).awaitTermination(60)
    chunk_rows(spark, (3, "pending", None)).write.mode("append").json(source)
    translate_stream(*args).awaitTermination(60)
    assert sorted(r["chunk_id"] for r in spark.read.parquet(f"file://{tmp_path}/events").collect()) == ["01_0001", "01_0003"]
    assert "content" in CHUNK
