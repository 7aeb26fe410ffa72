import pytest
from pyspark.sql import functions as F

from quire.functions import text as T


def one(spark, expression, **values):
    row = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return row.select(expression.alias("x")).first()[0]


SPACES = ["", " ", "  a  b ", "\x1c a \x85", "  x y  ", "\n\t", "a\x0bb"]


@pytest.mark.parametrize("value", SPACES)
def test_strip_and_collapse_are_pythons(spark, value):
    assert one(spark, T.py_strip("v"), v=value) == value.strip()
    assert one(spark, T.collapse("v"), v=value) == " ".join(value.split())
    assert one(spark, T.blank("v"), v=value) == (not value.strip())


@pytest.mark.parametrize("value", ["", "a", "a\n", "a\r\nb", "a\x0bb\x0cc\x1cd\x85e f", "\n\n"])
def test_split_lines_is_pythons(spark, value):
    assert one(spark, T.split_lines("v"), v=value) == value.splitlines()


def test_word_counts_differ_on_purpose(spark):
    md = "# Chapter 1\n\nThis is a test.\n\n```\nx y z\n```\n- item\n> quote"
    assert one(spark, T.count_markdown_words("v"), v=md) == 8
    assert one(spark, T.count_words("v"), v=md) == 12  # a list marker counts as well
    assert one(spark, T.count_words("v"), v="Ёлка-2 слово, two") == 3


@pytest.mark.parametrize("value, slug", [("My Book: Part 2!", "my-book-part-2"), ("Книга Ё", "книга-ё"), ("--", "book"), ("", "book")])
def test_slugify(spark, value, slug):
    assert one(spark, T.slugify("v"), v=value) == slug


@pytest.mark.parametrize("n, text", [(0, "0 B"), (1023, "1023 B"), (1024, "1.0 KB"), (1536, "1.5 KB"), (10 * 1024, "10 KB"), (5 * 1024 * 1024, "5.0 MB"), (5000 * 1024 * 1024, "5000 MB")])
def test_format_bytes(spark, n, text):
    assert one(spark, T.format_bytes("v"), v=n) == text


@pytest.mark.parametrize("value, href", [("@me", "https://t.me/me"), ("https://x.y", "https://x.y"), ("mailto:a@b", "mailto:a@b"), ("a@b.c", "mailto:a@b.c"), ("plain", "plain")])
def test_contact_href(spark, value, href):
    assert one(spark, T.contact_href("v"), v=value) == href


def test_base64_has_no_breaks(spark):
    import base64

    raw = bytes(range(90))
    assert one(spark, T.data_uri("v", T.mime_of(F.lit("a/b.PNG"))), v=bytearray(raw)) == "data:image/png;base64," + base64.b64encode(raw).decode()
    assert one(spark, T.mime_of(F.lit("x.unknown"))) == "application/octet-stream"


def test_titles_levels_images(spark):
    md = "x\n# First \n## Second\n#\nno\n![a](i/1.png) ![](<b>)"
    assert one(spark, T.title_of("v", F.lit("f")), v=md) == "First"
    assert one(spark, T.title_of("v", F.lit("f")), v="none") == "f"
    assert one(spark, T.heading_levels("v"), v=md) == [1, 2, 1]  # the third goes on over the line end
    assert one(spark, T.image_references("v"), v=md) == ["i/1.png", "<b>"]


def test_highlight_escapes_the_query(spark):
    assert one(spark, T.highlight("v", "A.b"), v="xa.Bx aXb") == "x<mark>a.B</mark>x aXb"
    assert one(spark, T.highlight("v", "  "), v="same") == "same"


def test_json_for_html(spark):
    assert one(spark, T.json_for_html(F.struct(F.col("v"))), v="</script>") == '{"v":"\\u003c/script>"}'


def test_sql_functions(spark):
    assert set(T.register(spark)) >= {"py_strip", "slugify"}
    row = spark.sql("SELECT py_strip('  a '), collapse_ws(' a   b '), word_count_re('a b'), slugify('A b'), contact_href('@x')").first()
    assert tuple(row) == ("a", "a b", 2, "a-b", "https://t.me/x")


def test_strip_takes_what_python_takes(spark):
    for c in map(chr, (*range(1, 0x250), 0x1680, 0x180E, *range(0x2000, 0x2070), 0x3000, 0xFEFF)):
        assert (c in T.SPACES) == c.isspace()
    held = spark.createDataFrame([(f"{c}a{c}b{c}",) for c in T.SPACES], "v string")
    assert all(r["s"] == r["v"].strip() and r["r"] == r["v"].rstrip() for r in held.select("v", T.py_strip("v").alias("s"), T.py_rstrip("v").alias("r")).collect())
