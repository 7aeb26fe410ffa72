"""Text expressions with Python's notions of white space, digits and word characters.

All are Catalyst expressions: they stay in the JVM and are pushed through
projections like any other. ``(?d)`` makes only \\n a line end for ``.``, ``^``
and ``$``.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Inside a character class: what Python's str.isspace() accepts.
SPACE = r"\s\x0B\x1C-\x1F\x85\p{Z}"
#: The same characters one by one.
SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
WORD_CHAR = r"[\p{L}\p{N}_]"
#: Line ends of str.splitlines().
LINE_END = "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"
WORD = "[A-Za-zА-Яа-яЁё0-9-]+"
LIST_MARKER = rf"[{SPACE}]*(?:[-*+]|\p{{Nd}}+\.)[{SPACE}]+"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def let(value: Column, use) -> Column:
    """use(value) with the value computed once.

    A column that is named in a lambda is inlined into it by the optimizer and
    computed for every element; a lambda's own variable isn't.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def py_strip(x: Column | str) -> Column:
    """str.strip()."""
    return F.btrim(_c(x), F.lit(SPACES))


def py_rstrip(x: Column | str) -> Column:
    return F.rtrim(_c(x), F.lit(SPACES))


def collapse(x: Column | str) -> Column:
    """' '.join(x.split())."""
    return py_strip(F.regexp_replace(_c(x), rf"[{SPACE}]+", " "))


def blank(x: Column | str) -> Column:
    """Null, or nothing but white space."""
    return F.coalesce(~_c(x).rlike(rf"[^{SPACE}]"), F.lit(True))


def lines(x: Column | str) -> Column:
    """x.split('\\n')."""
    return F.split(_c(x), "\n", -1)


def split_lines(x: Column | str) -> Column:
    """x.splitlines()."""
    found = F.split(_c(x), LINE_END, -1)
    return F.when(F.element_at(found, -1) == "", F.slice(found, F.lit(1), F.size(found) - 1)).otherwise(found)


def newlines(x: Column | str) -> Column:
    """Universal newlines: what reading a text file gives."""
    return F.regexp_replace(_c(x), "\r\n|\r", "\n")


def count_words(x: Column | str) -> Column:
    """Words as publishing and review count them."""
    return F.regexp_count(_c(x), F.lit(WORD))


def count_markdown_words(x: Column | str) -> Column:
    """White-space tokens outside fenced code, without heading, list and quote markers."""
    text = _c(x)
    for pattern in (
        r"(?s)```.*?```",
        r"(?s)~~~.*?~~~",
        rf"(?md)^#{{1,6}}[{SPACE}]+",
        rf"(?md)^[{SPACE}]*[-*+][{SPACE}]+",
        rf"(?md)^[{SPACE}]*\p{{Nd}}+\.[{SPACE}]+",
        rf"(?md)^>[{SPACE}]+",
    ):
        text = F.regexp_replace(text, pattern, "")
    return F.size(F.filter(F.split(text, rf"[{SPACE}]+", -1), lambda w: w != ""))


def heading_levels(x: Column | str) -> Column:
    """Levels of ATX headings; the white space after the marks may be a line end."""
    return F.transform(F.regexp_extract_all(_c(x), F.lit(rf"(?md)^(#{{1,6}})[{SPACE}]+"), F.lit(1)), F.length)


def count_list_items(x: Column | str) -> Column:
    return F.regexp_count(_c(x), F.lit(rf"(?md)^{LIST_MARKER}"))


def count_quotes(x: Column | str) -> Column:
    return F.regexp_count(_c(x), F.lit(rf"(?md)^[{SPACE}]*>"))


def image_references(x: Column | str) -> Column:
    return F.regexp_extract_all(_c(x), F.lit(r"!\[[^\]]*\]\(([^)]+)\)"), F.lit(1))


def title_of(x: Column | str, fallback: Column) -> Column:
    """The first level-1 heading's text, else ``fallback``."""
    pattern = rf"(?md)^#[{SPACE}]+(.+)$"
    return F.when(_c(x).rlike(pattern), py_strip(F.regexp_extract(_c(x), pattern, 1))).otherwise(fallback)


def slugify(x: Column | str) -> Column:
    """Lower-cased runs of Latin or Cyrillic letters and digits, joined by '-'; 'book' if none."""
    slug = F.regexp_replace(F.regexp_replace(F.lower(_c(x)), "[^a-z0-9а-яё]+", "-"), "^-+|-+$", "")
    return F.when(F.coalesce(slug, F.lit("")) == "", "book").otherwise(slug)


def escape_html(x: Column | str) -> Column:
    out = _c(x)
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#039;")):
        out = F.replace(out, F.lit(char), F.lit(entity))
    return out


def contact_href(x: Column | str) -> Column:
    """A link for a translator's contact: handle, address, mail or as it is."""
    v = _c(x)
    return (
        F.when(v.startswith("@"), F.concat(F.lit("https://t.me/"), F.substring(v, 2, 1 << 30)))
        .when(v.startswith("http://") | v.startswith("https://") | v.startswith("mailto:"), v)
        .when(v.contains("@"), F.concat(F.lit("mailto:"), v))
        .otherwise(v)
    )


def format_bytes(x: Column | str) -> Column:
    """B, KB or MB; one decimal below ten units, none for bytes."""
    n = _c(x).cast("double")
    unit = F.when(n < 1024, 0).when(n < 1024 * 1024, 1).otherwise(2)
    size = n / F.pow(F.lit(1024.0), unit)
    # Half to even on the exact binary value, as printf-style rounding of a double does.
    whole, tenth = F.bround(size, 0).cast("long").cast("string"), F.format_string("%.1f", F.bround(size, 1))
    return F.concat_ws(" ", F.when((unit == 0) | (size >= 10), whole).otherwise(tenth), F.element_at(F.array(F.lit("B"), F.lit("KB"), F.lit("MB")), unit + 1))


def base64_line(x: Column | str) -> Column:
    """Base64 without line breaks."""
    return F.regexp_replace(F.base64(_c(x)), "[\r\n]", "")


def data_uri(content: Column | str, mime: Column | str) -> Column:
    return F.concat(F.lit("data:"), _c(mime), F.lit(";base64,"), base64_line(content))


#: Kinds of image that books hold; fixed values of the MIME registry.
MIME = {"png": "image/png", "jpg": "image/jpeg", "jpeg": "image/jpeg", "gif": "image/gif", "svg": "image/svg+xml", "webp": "image/webp", "bmp": "image/bmp", "tif": "image/tiff", "tiff": "image/tiff", "ico": "image/vnd.microsoft.icon", "avif": "image/avif"}


def mime_of(path: Column | str) -> Column:
    kinds = F.create_map(*(F.lit(x) for pair in MIME.items() for x in pair))
    return F.coalesce(F.element_at(kinds, F.lower(F.regexp_extract(_c(path), r"\.([^./]+)$", 1))), F.lit("application/octet-stream"))


def json_for_html(x: Column | str) -> Column:
    """JSON that can stand inside a script element."""
    return F.replace(F.to_json(_c(x)), F.lit("<"), F.lit("\\u003c"))


def literal(x: Column) -> Column:
    """A regular expression that matches the text itself."""
    return F.regexp_replace(x, r"([.*+?^${}()|\[\]\\])", r"\\$1")


def highlight(x: Column | str, query: str) -> Column:
    """Every occurrence of ``query``, in either case, wrapped in <mark>."""
    import re

    clean = query.strip()
    return F.regexp_replace(_c(x), f"(?iu)({re.escape(clean)})", "<mark>$1</mark>") if clean else _c(x)


def register(spark: SparkSession) -> list[str]:
    """Make scalar functions callable from SQL; they inline into the plan."""
    for name, (kind, body) in _BODY.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(x STRING) RETURNS {kind} RETURN {body}")
    return list(_BODY)


_TRIM = r"regexp_replace({}, r'^[\s\x0B\x1C-\x1F\x85\p{{Z}}]+|[\s\x0B\x1C-\x1F\x85\p{{Z}}]+$', '')"
_BODY = {
    "py_strip": ("STRING", _TRIM.format("x")),
    "collapse_ws": ("STRING", _TRIM.format(r"regexp_replace(x, r'[\s\x0B\x1C-\x1F\x85\p{Z}]+', ' ')")),
    "word_count_re": ("INT", "regexp_count(x, '[A-Za-zА-Яа-яЁё0-9-]+')"),
    "slugify": ("STRING", "CASE WHEN coalesce(trim(BOTH '-' FROM regexp_replace(lower(x), '[^a-z0-9а-яё]+', '-')), '') = '' THEN 'book' ELSE trim(BOTH '-' FROM regexp_replace(lower(x), '[^a-z0-9а-яё]+', '-')) END"),
    "contact_href": ("STRING", "CASE WHEN x LIKE '@%' THEN concat('https://t.me/', substr(x, 2)) WHEN x LIKE 'http://%' OR x LIKE 'https://%' OR x LIKE 'mailto:%' THEN x WHEN x LIKE '%@%' THEN concat('mailto:', x) ELSE x END"),
}


def caption_parts(space: str, digit: str) -> str:
    """A pattern for a caption line: its number, if that alone is bold, and the rest without bold marks around it."""
    return rf"^\*\*(?:(Рис\.{space}*{digit}+\.?)\*\*{space}*)?(.*?)(?:\*\*)?$"
