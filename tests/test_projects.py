"""Rendering, pages and commands."""

import pytest
from pyspark.sql import functions as F

from quire.operators import publish, render
from quire.plans import commands
from quire.plans.pipeline import main as run

GOLDEN = [
    ("plain <b>", "plain &lt;b&gt;"),
    ("a `b *c*` **d** *e*", "a <code>b <em>c</em></code> <strong>d</strong> <em>e</em>"),
    ("**a `b** c`", "<strong>a <code>b</strong> c</code>"),
    ("*a **b** c*", "<em>a <strong>b</strong> c</em>"),
    ("***a** b*", "<em><strong>a</strong> b</em>"),
    ("`` x ` y", "`<code> x </code> y"),
    ("** a * b **", "*<em> a </em> b **"),
    ("[t *x*](https://e.org/a_b) *y*", '<a href="https://e.org/a_b" target="_blank" rel="noopener noreferrer">t *x*</a> <em>y</em>'),
    ("see https://e.org/x.", 'see <a href="https://e.org/x" target="_blank" rel="noopener noreferrer">https://e.org/x</a>.'),
    ("*a https://e.org/* b*", '<em>a <a href="https://e.org/*" target="_blank" rel="noopener noreferrer">https://e.org/*</a> b</em>'),
    ("@@LINK_0@@ [t](http://u)", '@@LINK_0@@ <a href="http://u" target="_blank" rel="noopener noreferrer">t</a>'),
]


@pytest.mark.parametrize("text, want", GOLDEN)
def test_inline(text, want):
    assert render.inline(text) == want


def test_captions_and_figures(spark):
    lines = ["**Рис. 3.** A  **b**", "**Рис. 4. caption**", "**Рис. 5** x", "**Рис.6**"]
    want = ["Рис. 3. A **b", "Рис. 4. caption", "Рис. 5 x", "Рис.6"]
    assert [render.caption_text(x) for x in lines] == want
    rows = spark.createDataFrame(enumerate(lines), "k int, line string").select("k", publish.caption_text("line").alias("c")).orderBy("k").collect()
    assert [r["c"] for r in rows] == want
    assert render.to_html("![a](x.png)\n\n**Рис. 1. b**") == (
        '<figure class="book-figure"><div class="figure-frame"><img src="x.png" alt="Рис. 1. b" loading="lazy"></div><figcaption>Рис. 1. b</figcaption></figure>'
    )


def test_html_of_a_chapter():
    text = "# T\n\npara *x*\n- a\n- b\n1. c\n> q\n> r\n\nend"
    assert render.to_html(text).split("\n") == ["<h1>T</h1>", "<p>para <em>x</em></p>", "<ul>", "<li>a</li>", "<li>b</li>", "</ul>", "<ol>", "<li>c</li>", "</ol>", "<blockquote><p>q</p><p>r</p></blockquote>", "<p>end</p>"]


def test_marks_in_values_stay(spark):
    chapters = spark.createDataFrame([("b", 1, "f", "i", "l", "k", "t", 1, "raw __TITLE__")], "book_id string, chapter_pos int, file string, id string, label string, kind string, title string, words int, raw string")
    metadata = spark.createDataFrame([("b", "__DATA__", "a", "en", "ru", ("",))], "book_id string, title string, author string, source_language string, target_language string, translator struct<contact:string>")
    html = publish.publish_page(chapters, metadata).first()["html"]
    assert "<title>__DATA__</title>" in html and "raw __TITLE__" in html


def test_commands(spark, tmp_path, capsys):
    root = f"file://{tmp_path}/projects"
    assert commands.main(["init", root, "in/One Book.pdf", "in/two.pdf"]) == 0
    assert commands.main(["list", root]) == 0 and commands.main(["status", root, "two"]) == 0
    shown = capsys.readouterr().out
    assert "one-book" in shown and "init       done" in shown
    (tmp_path / "b1.md").write_text("# Chapter 1\n\nSome text here.\n\n# Chapter 2\n\nMore text.\n")
    assert run([f"file://{tmp_path}/b1.md", f"file://{tmp_path}/out"]) == 0
    assert commands.main(["review", f"file://{tmp_path}/out"]) == 0 and commands.main(["publish", f"file://{tmp_path}/out"]) == 0
    assert "Quality report" in (shown := capsys.readouterr().out) and "b1-ru.html" in shown
    assert run([f"file://{tmp_path}/b1.md", f"file://{tmp_path}/chat", "--provider", "chat"]) == 0
    assert commands.main(["chat", f"file://{tmp_path}/chat"]) == 0 and "Some text here." in capsys.readouterr().out
    assert commands.main(["status", root]) == 2


def test_single_stages(spark, tmp_path, capsys):
    out = f"file://{tmp_path}/out"
    for name in ("b1", "b2"):
        (tmp_path / f"{name}.md").write_text(f"# Chapter 1\n\nText of {name}.\n\n# Chapter 2\n\nMore text.\n")
    assert commands.main(["extract", out, f"file://{tmp_path}/b1.md", f"file://{tmp_path}/b2.md"]) == 0
    for stage in ("normalize", "split", "chunk", "translate", "assemble"):
        assert commands.main([stage, out]) == 0
    assert run([f"file://{tmp_path}/b*.md", f"file://{tmp_path}/whole"]) == 0
    for table in ("normalized", "chapters", "chunks", "translations", "assembled"):
        assert sorted(map(str, spark.read.parquet(f"{out}/{table}").collect())) == sorted(map(str, spark.read.parquet(f"file://{tmp_path}/whole/{table}").collect()))
    assert commands.main(["extract", out]) == 2


def test_pages_have_their_names(spark, tmp_path):
    pages = spark.createDataFrame([("b 1", "b 1-ru.html", "<p>é</p>\n"), ("b2", "b2-de.html", "x\n\ny\n")], "book_id string, file string, html string")
    folder = f"file://{tmp_path}/pages"
    publish.write_pages(pages, folder)
    assert sorted(p.name for p in (tmp_path / "pages").iterdir() if not p.name.startswith(".")) == ["b 1-ru.html", "b2-de.html"]
    assert (tmp_path / "pages" / "b 1-ru.html").read_text() == "<p>é</p>\n" and (tmp_path / "pages" / "b2-de.html").read_text() == "x\n\ny\n"
    with pytest.raises(FileExistsError):
        publish.write_pages(pages, folder)
    publish.write_pages(pages.where("book_id = 'b2'").withColumn("html", F.lit("new\n")), folder, force=True)
    assert (tmp_path / "pages" / "b2-de.html").read_text() == "new\n" and (tmp_path / "pages" / "b 1-ru.html").exists()
    bad = pages.withColumn("html", F.udf(lambda x: 1 / 0, "string")("html"))
    with pytest.raises(Exception):
        publish.write_pages(bad, f"file://{tmp_path}/none")
    assert not [p for p in (tmp_path / "none").rglob("*") if p.is_file()]
