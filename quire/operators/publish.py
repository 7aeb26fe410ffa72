"""Publishing: chapter tables, search, figures, and pages that stand alone."""

from __future__ import annotations

import re
import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import SPACE, caption_parts, count_words, data_uri, escape_html, json_for_html, let, lines, mime_of, newlines, py_strip, title_of

#: Headings of the reader's groups; fixed values of the published format.
KINDS = {"opening": "Вступление", "appendix": "Приложение", "notes": "Примечания", "chapter": "Глава"}
FIGURES = 36
LARGE_PAGE = 10 * 1024 * 1024
#: Quire's own template; ``publish_page`` fills it.
TEMPLATE = """<!doctype html>
<html lang="__LANG__"><head><meta charset="utf-8"><title>__TITLE__</title></head>
<body><header><h1>__TITLE__</h1><p>__AUTHOR__</p><p>__CREDIT__</p></header><main id="reader"></main>
<script id="book" type="application/json">__DATA__</script></body></html>
"""


def label(chapter_id: Column, index: Column) -> Column:
    """Leading digits with A or N for appendices and notes, else the place in the book."""
    digits = F.regexp_extract(chapter_id, r"^(\p{Nd}+)_", 1)
    return F.when(digits == "", F.format_string("%02d", index)).when(chapter_id.contains("appendix"), F.concat(F.lit("A"), digits)).when(chapter_id.contains("notes"), F.concat(F.lit("N"), digits)).otherwise(digits)


def kind(chapter_id: Column) -> Column:
    return F.when(chapter_id.contains("foreword") | chapter_id.contains("acknowledg"), KINDS["opening"]).when(chapter_id.contains("appendix"), KINDS["appendix"]).when(chapter_id.contains("notes"), KINDS["notes"]).otherwise(KINDS["chapter"])


def published(chapters: DataFrame, strict: bool = True) -> DataFrame:
    """(book_id, chapter_pos, file, id, label, kind, title, words, raw); a chapter without text fails the job, or is left out."""
    rows = chapters.where(F.coalesce("chapter_id", F.lit("")) != "")
    raw = F.coalesce("content", F.raise_error(F.concat(F.lit("no translation of "), "chapter_id"))) if strict else F.col("content")
    rows = rows if strict else rows.where(F.col("content").isNotNull())
    return rows.select(
        "book_id", "chapter_pos", F.concat("chapter_id", F.lit(".md")).alias("file"), F.col("chapter_id").alias("id"), label(F.col("chapter_id"), F.col("chapter_pos")).alias("label"), kind(F.col("chapter_id")).alias("kind"),
        title_of("content", F.coalesce("title", F.col("chapter_id"))).alias("title"), count_words("content").alias("words"), raw.alias("raw"),
    )


def neighbours(chapters: DataFrame) -> DataFrame:
    """Adds previous_id and next_id in the book's order."""
    w = Window.partitionBy("book_id").orderBy("chapter_pos")
    return chapters.withColumns({"previous_id": F.lag("id").over(w), "next_id": F.lead("id").over(w)})


def thousands(chapters: DataFrame) -> DataFrame:
    """(book_id, words, thousands): half to even, as the page builder rounds; thousands_up rounds halves up, as the reader does."""
    total = chapters.groupBy("book_id").agg(F.sum("words").alias("words"))
    k = F.col("words") / 1000
    return total.select("book_id", "words", F.bround(k, 0).cast("long").alias("thousands"), F.floor(k + 0.5).alias("thousands_up"))


def search(rows: DataFrame, query: str, title: str = "title", raw: str = "raw") -> DataFrame:
    """Rows whose title or text holds the trimmed query, in either case; a blank query keeps all."""
    clean = query.strip().lower()
    return rows.where(F.lower(F.concat(F.col(title), F.lit("\n"), F.col(raw))).contains(clean)) if clean else rows


def section_rail(chapters: DataFrame, text: str = "raw") -> DataFrame:
    """(book_id, chapter_pos, section_no, anchor, level, title) of second and third level headings, numbered from zero."""
    pattern = rf"(?d)^(#{{2,3}})[{SPACE}]+(.+)$"
    marked = F.filter(F.transform(lines(text), py_strip), lambda x: x.rlike(pattern))
    rows = chapters.select("book_id", "chapter_pos", F.posexplode(marked).alias("section_no", "line"))
    return rows.select("book_id", "chapter_pos", "section_no", F.format_string("section-%d-%d", F.col("chapter_pos") - 1, "section_no").alias("anchor"), F.length(F.regexp_extract("line", pattern, 1)).alias("level"), F.regexp_extract("line", pattern, 2).alias("title"))


_CAPTION = r"(?d)^\*\*Рис\.[" + SPACE + r"]*([0-9]+)[^\n]*$"


def mapped_figures(books: DataFrame) -> DataFrame:
    """(book_id, line_number, figure, image): every caption of a mapped figure; figure N is image N + 1."""
    rows = books.select("book_id", F.posexplode(lines("md")).alias("k", "line"))
    found = rows.select("book_id", (F.col("k") + 1).alias("line_number"), F.regexp_extract("line", _CAPTION, 1).alias("figure")).where("figure <> ''")
    number = F.col("figure").try_cast("int")
    return found.where(number.between(1, FIGURES)).select("book_id", "line_number", "figure", F.format_string("images/imageFile%d.png", number + 1).alias("image"))


def inject_figures(md: Column) -> Column:
    """Before the first caption of each mapped figure that has no image yet, its image."""
    return let(md, _with_figures)


def _with_figures(md: Column) -> Column:
    existing = F.regexp_extract_all(md, F.lit(r"(?iu)!\[[^\]]*?(?:Рис\.|Figure)[" + SPACE + r"]*([0-9]+)"), F.lit(1))
    rows = lines(md)
    numbers = F.transform(rows, lambda x: F.when(x.rlike(_CAPTION), F.regexp_extract(x, _CAPTION, 1)))

    def line(seen: Column, x: Column, i: Column) -> Column:
        numbers, existing = seen["numbers"], seen["existing"]
        n = F.get(numbers, i)
        mapped = n.rlike("^[1-9][0-9]?$") & (n.try_cast("int") <= FIGURES)
        first = F.array_position(numbers, n) == i + 1
        image = F.format_string("![Рис. %s](images/imageFile%d.png)\n\n%s", n, n.try_cast("int") + 1, x)
        return F.when(n.isNotNull() & mapped & first & ~F.array_contains(existing, n), image).otherwise(x)

    return let(F.struct(numbers.alias("numbers"), existing.alias("existing")), lambda seen: F.array_join(F.transform(rows, lambda x, i: line(seen, x, i)), "\n"))


def caption_text(line: Column) -> Column:
    """A caption line without its bold marks."""
    return py_strip(F.regexp_replace(F.regexp_replace(line, caption_parts(f"[{SPACE}]", "[0-9]"), "$1 $2"), rf"[{SPACE}]+", " "))


def figures(chapters: DataFrame, text: str = "raw") -> DataFrame:
    """(book_id, chapter_pos, line_number, alt, src, caption): image lines with the caption in the next line that isn't blank."""
    image = r"^!\[([^\]]*)\]\((?:<([^>]+)>|([^)]+))\)$"
    rows = chapters.select("book_id", "chapter_pos", F.posexplode(F.transform(lines(newlines(text)), py_strip)).alias("pos", "line")).where("line <> ''")
    after = F.lead("line").over(Window.partitionBy("book_id", "chapter_pos").orderBy("pos"))
    found = rows.withColumn("after", after).where(F.col("line").rlike(image))
    src = F.when(F.regexp_extract("line", image, 2) != "", F.regexp_extract("line", image, 2)).otherwise(F.regexp_extract("line", image, 3))
    return found.select("book_id", "chapter_pos", (F.col("pos") + 1).alias("line_number"), F.regexp_extract("line", image, 1).alias("alt"), src.alias("src"), F.when(F.col("after").rlike(rf"^\*\*Рис\.[{SPACE}]*[0-9]+"), caption_text(F.col("after"))).alias("caption"))


EXTERNAL = r"^(?:https?://|data:|mailto:)"


def embed_images(chapters: DataFrame, images: DataFrame, text: str = "raw", base: str = "translated") -> DataFrame:
    """``text`` with local image references as data URIs.

    ``images``: (book_id, path, content), paths relative to the project. A
    reference is looked for relative to the chapter's folder, the project, its
    source folder, and by name among the source's images, in this order;
    external and unknown ones stay as they are.
    """
    keys = ["book_id", "chapter_pos"]
    pattern = r"!\[[^\]]*\]\([^)]+\)"
    found = chapters.select(*keys, F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))).alias("whole"))
    ref = F.regexp_extract("whole", r"\]\(([^)]+)\)$", 1)
    candidates = F.array(F.concat(F.lit(f"{base}/"), ref), ref, F.concat(F.lit("source/"), ref), F.concat(F.lit("source/images/"), F.element_at(F.split(ref, "/"), -1)))
    wanted = found.where(~ref.rlike(EXTERNAL)).select(*keys, "whole", F.posexplode(candidates).alias("rank", "path"))
    # Of the images nothing is collected: a listing made by explode looks small to the planner and would be broadcast.
    best = wanted.hint("shuffle_hash").join(images.select("book_id", "path", "content"), ["book_id", "path"]).groupBy(*keys, "whole").agg(F.min_by(F.struct("path", "content"), "rank").alias("i"))
    new = F.concat(F.regexp_extract("whole", r"^(!\[[^\]]*\]\()", 1), data_uri(F.col("i.content"), mime_of("i.path")), F.lit(")"))
    swaps = best.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("whole", new.alias("new")))).alias("swaps"))
    joined = chapters.join(swaps, keys, "left")
    pieces, marks = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    done = F.array_join(F.zip_with(pieces, F.transform(marks, lambda m: F.coalesce(F.col("swaps")[m], m)), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    return joined.withColumn(text, F.when(F.col("swaps").isNull(), F.col(text)).otherwise(done)).drop("swaps")


def book_json(chapters: DataFrame, metadata: DataFrame) -> DataFrame:
    """(book_id, data): metadata and chapters as JSON for a script element; a row is as large as a book."""
    meta = metadata.select("book_id", F.struct("book_id", "title", "author", "source_language", "target_language", "translator").alias("metadata"))
    listed = chapters.groupBy("book_id").agg(F.array_sort(F.collect_list(F.struct("chapter_pos", "file", "id", "label", "kind", "title", "words", "raw"))).alias("chapters"))
    return meta.join(listed, "book_id").select("book_id", json_for_html(F.struct("metadata", "chapters")).alias("data"))


def publish_page(chapters: DataFrame, metadata: DataFrame) -> DataFrame:
    """(book_id, file, html, bytes, warning): one page per book."""
    from quire.functions.text import contact_href

    info = metadata.select("book_id", F.coalesce("title", F.lit("")).alias("title"), F.coalesce("author", F.lit("")).alias("author"), F.coalesce("target_language", F.lit("ru")).alias("lang"), F.col("translator.contact").alias("contact"))
    link = F.when(F.coalesce("contact", F.lit("")) != "", F.concat(F.lit('<a href="'), escape_html(contact_href("contact")), F.lit('" target="_blank" rel="noreferrer">'), escape_html("contact"), F.lit("</a>"))).otherwise("")
    values = {"__LANG__": F.col("lang"), "__TITLE__": escape_html("title"), "__AUTHOR__": escape_html("author"), "__CREDIT__": link, "__DATA__": F.col("data")}
    html = F.concat(*(values.get(part, F.lit(part)) for part in re.split(f"({'|'.join(values)})", TEMPLATE)))
    page = book_json(chapters, metadata).join(info, "book_id").select("book_id", F.concat("book_id", F.lit("-"), "lang", F.lit(".html")).alias("file"), html.alias("html"))
    size = F.octet_length("html")
    return page.select("book_id", "file", "html", size.alias("bytes"), F.when(size > LARGE_PAGE, "page is over 10 MiB").alias("warning"))


def write_pages(pages: DataFrame, folder: str, force: bool = False) -> None:
    """Each page as ``folder/<file>``, all or none: written beside, then moved, which is a rename for each book.

    Files that are there are refused unless forced; then those of the books at hand are replaced.
    """
    spark = pages.sparkSession
    aside = f"{folder.rstrip('/')}/_pages-{uuid.uuid4().hex[:12]}"
    path = lambda p: spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
    files = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        # The writer ends a value with a line end, as the template does.
        pages.select(F.regexp_replace("html", "\\n$", "").alias("value"), F.col("file").alias("name")).repartition("name").write.partitionBy("name").text(aside)
        made = [s.getPath() for s in files.globStatus(path(f"{aside}/name=*/part-*"))]
        names = [unquote(p.getParent().getName().removeprefix("name=")) for p in made]
        if not force and (there := [n for n in names if files.exists(path(f"{folder}/{n}"))]):
            raise FileExistsError(f"{len(there)} pages are there already, {there[0]} among them")
        for part, name in zip(made, names, strict=True):
            files.delete(path(f"{folder}/{name}"), False)
            files.rename(part, path(f"{folder}/{name}"))
    finally:
        files.delete(path(aside), True)
