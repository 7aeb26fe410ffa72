"""Queries over the supplied tables, one for each operator or group of operators, and their SQL.

The tables have no markdown, so most queries work on the book view
(``sources.books``). Rows that the pipeline would have written - chunks with
status and translation, projects with their state - are derived from the tables
by expressions that read the same in both dialects.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import blocks as B
from quire.operators import chapters as C
from quire.operators import chunking as H
from quire.operators import glossary as G
from quire.operators import normalize as N
from quire.operators import publish as P
from quire.operators import render
from quire.operators import review as R
from quire.operators import state as L
from quire.operators import translate as TR
from quire.session import work_dir
from quire.sources.books import BOOK, PART, book_view, numbered

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# ---- shared inputs, in Spark -------------------------------------------------


def books(spark: SparkSession, sf: str) -> DataFrame:
    return book_view(table(spark, sf, "documents"))


def normalized(spark: SparkSession, sf: str) -> DataFrame:
    return N.normalize(books(spark, sf))


def split(spark: SparkSession, sf: str) -> DataFrame:
    return C.split_auto(normalized(spark, sf))


_NO = "CAST(floor((rn - 1) / 10) AS INT)"
#: Columns of derived chunks; rn counts a book's documents.
CHUNK_COLUMNS = {
    "book_id": "book",
    "chapter_id": f"concat(lpad(CAST({_NO} + 1 AS STRING), 2, '0'), '_chapter')",
    "sequence": f"CAST(rn - 10 * {_NO} AS INT)",
    "chunk_id": f"concat(lpad(CAST({_NO} + 1 AS STRING), 2, '0'), '_chapter_', lpad(CAST(rn - 10 * {_NO} AS STRING), 4, '0'))",
    "content": "text",
    "status": "CASE doc_id % 10 WHEN 0 THEN 'error' WHEN 1 THEN 'pending' WHEN 2 THEN 'approved' ELSE 'translated' END",
    "translation": "CASE doc_id % 10 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 5 THEN '  ' ELSE concat(' RU ', text, ' ') END",
}
#: The translation of a chapter, edited by its place: heading, quotes or images lost.
TRANSLATED = {"drop_heading": "chapter_pos % 4 = 0", "drop_quotes": "chapter_pos % 4 = 1", "drop_images": "chapter_pos % 4 = 2"}


def chunks(spark: SparkSession, sf: str) -> DataFrame:
    return numbered(table(spark, sf, "documents")).select("doc_id", *(F.expr(e).alias(c) for c, e in CHUNK_COLUMNS.items()))


def written_split(spark: SparkSession, sf: str) -> DataFrame:
    """The split, written: what compares chapters reads it twice or more."""
    path = work_dir(spark, "split")
    split(spark, sf).write.parquet(path)
    return spark.read.parquet(path)


def translated(ch: DataFrame) -> DataFrame:
    """The chapters' translations, edited by their place."""
    text = F.col("content")
    text = F.when(F.expr(TRANSLATED["drop_heading"]), F.regexp_replace(text, "(?md)^#+ ", "")).when(F.expr(TRANSLATED["drop_quotes"]), F.regexp_replace(text, "(?md)^> .*$", "")).when(F.expr(TRANSLATED["drop_images"]), F.regexp_replace(text, r"!\[[^\]]*\]\([^)]*\)", "")).otherwise(text)
    return ch.withColumn("content", text).where("chapter_pos % 5 <> 0")


def both_texts(spark: SparkSession, sf: str) -> DataFrame:
    ch = written_split(spark, sf)
    return R.pairs(ch, translated(ch))


# ---- the same, in DuckDB -----------------------------------------------------

WS = r"[\s\x0B\x1C-\x1F\x{85}\pZ]"
STRIP = rf"^{WS}+|{WS}+$"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '{STRIP}', '', 'g')"


def rows_of(source: str, md: str = "md", keys: str = "book_id") -> str:
    return f"SELECT {keys}, unnest(string_split({md}, chr(10))) AS line, generate_subscripts(string_split({md}, chr(10)), 1) AS pos FROM {source}"


_RN = f"SELECT *, row_number() OVER (PARTITION BY book ORDER BY doc_id) AS rn, count(*) OVER (PARTITION BY book) AS n FROM (SELECT *, {BOOK} AS book FROM documents)"
PAGE = rf"^([Pp]age{WS}+\p{{Nd}}+|\p{{Nd}}+{WS}*\||\|{WS}*\p{{Nd}}+|-{WS}*\p{{Nd}}+{WS}*-|\p{{Nd}}{{1,4}})$"
BOOKS = f"books AS (SELECT book AS book_id, string_agg(part, chr(10) ORDER BY rn) AS md FROM (SELECT book, rn, {PART} AS part FROM ({_RN})) GROUP BY book)"
LINES = f"l AS (SELECT *, {strip('line')} AS s FROM ({rows_of('books')}))"
NORM = rf"""{BOOKS}, {LINES},
p AS (SELECT * FROM l WHERE NOT regexp_matches(s, '{PAGE}')),
pat AS (SELECT book_id, s FROM p WHERE s <> '' AND length(s) < 80 AND s NOT LIKE '#%' GROUP BY ALL HAVING count(*) >= 3),
b AS (SELECT p.book_id, string_agg(CASE WHEN pat.s IS NULL THEN line ELSE '' END, chr(10) ORDER BY pos) AS md FROM p LEFT JOIN pat ON p.book_id = pat.book_id AND p.line = pat.s GROUP BY p.book_id),
norm AS (SELECT book_id, regexp_replace(regexp_replace(md, '([\pL\pN_])-\n{WS}*([\pL\pN_])', '\1\2', 'g'), '\n{{4,}}', chr(10) || chr(10) || chr(10), 'g') AS md FROM b)"""


def kind_sql(line: str) -> str:
    def opens(words: str, end: str = "") -> str:
        return rf"regexp_matches(lower({line}), '^#{WS}+({words})([\s\x0B\x1C-\x1F\x{{85}}\pZ{end}]|$)')"

    return f"""CASE WHEN {opens("foreword|preface|introduction")} THEN 'foreword' WHEN {opens("acknowledgments?|acknowledgements?|thanks")} THEN 'acknowledgments'
     WHEN {opens("appendix|appendices", ":0-9")} THEN 'appendix' WHEN {opens("notes?|endnotes?|references?")} THEN 'notes' ELSE 'chapter' END"""


BOUND = rf"nl AS ({rows_of('norm')}), bd AS (SELECT book_id, pos, line, {strip(f"regexp_extract(line, '^#{WS}+(.+)$', 1)")} AS title, {kind_sql('line')} AS chapter_type FROM nl WHERE regexp_matches(line, '^#{WS}+.+$'))"
CHAPTERS = rf"""{NORM}, {BOUND},
isl AS (SELECT nl.*, count(bd.pos) OVER (PARTITION BY nl.book_id ORDER BY nl.pos) AS chapter_pos FROM nl LEFT JOIN bd ON nl.book_id = bd.book_id AND nl.pos = bd.pos),
body AS (SELECT book_id, chapter_pos, min(pos) AS start_line, max(pos) AS end_line, string_agg(line, chr(10) ORDER BY pos) AS content FROM isl WHERE chapter_pos > 0 GROUP BY book_id, chapter_pos),
named AS (SELECT body.*, title, chapter_type, row_number() OVER (PARTITION BY body.book_id, chapter_type ORDER BY chapter_pos) AS k FROM body JOIN bd ON body.book_id = bd.book_id AND body.start_line = bd.pos),
ch AS (SELECT *, CASE chapter_type WHEN 'foreword' THEN '00_foreword' WHEN 'acknowledgments' THEN '00_acknowledgments' WHEN 'appendix' THEN format('{{:02d}}_appendix', 15 + k) WHEN 'notes' THEN format('{{:02d}}_notes', 18 + k) ELSE format('{{:02d}}_chapter', k) END AS chapter_id FROM named)"""
BOTH = rf"""{CHAPTERS},
tr AS (SELECT book_id, chapter_pos, chapter_id, title, CASE WHEN {TRANSLATED["drop_heading"]} THEN regexp_replace(content, '(?m)^#+ ', '', 'g') WHEN {TRANSLATED["drop_quotes"]} THEN regexp_replace(content, '(?m)^> .*$', '', 'g')
  WHEN {TRANSLATED["drop_images"]} THEN regexp_replace(content, '!\[[^\]]*\]\([^)]*\)', '', 'g') ELSE content END AS translated FROM ch WHERE chapter_pos % 5 <> 0),
two AS (SELECT ch.book_id, ch.chapter_pos, ch.chapter_id, ch.content AS source, translated FROM ch LEFT JOIN tr ON ch.book_id = tr.book_id AND ch.chapter_pos = tr.chapter_pos)"""
CHUNKS = f"chunks AS (SELECT doc_id, {', '.join(f'{e} AS {c}' for c, e in CHUNK_COLUMNS.items())} FROM ({_RN}))"
BLANK = rf"coalesce(NOT regexp_matches(translation, '[^\s\x0B\x1C-\x1F\x{{85}}\pZ]'), true)"


def words_md(x: str) -> str:
    for pattern in (r"(?s)```.*?```", r"(?s)~~~.*?~~~", rf"(?m)^#{{1,6}}{WS}+", rf"(?m)^{WS}*[-*+]{WS}+", rf"(?m)^{WS}*\p{{Nd}}+\.{WS}+", rf"(?m)^>{WS}+"):
        x = f"regexp_replace({x}, '{pattern}', '', 'g')"
    return f"len(list_filter(regexp_split_to_array({x}, '{WS}+'), lambda w: w <> ''))"


def words_re(x: str) -> str:
    return f"len(regexp_extract_all({x}, '[A-Za-zА-Яа-яЁё0-9-]+'))"


def levels(x: str) -> str:
    return rf"list_transform(regexp_extract_all({x}, '(?m)^(#{{1,6}}){WS}+', 1), lambda h: length(h))"


# ---- normalisation -------------------------------------------------------------


@query(f"WITH {BOOKS}, {LINES} SELECT book_id, s AS pattern, count(*) AS n, CAST(min(pos) - 1 AS BIGINT) AS first_pos FROM l WHERE s <> '' AND length(s) < 80 AND s NOT LIKE '#%' GROUP BY ALL HAVING count(*) >= 3")
def header_footer_patterns(spark, sf):
    return N.detect_headers_footers(books(spark, sf))


@query(f"WITH {BOOKS}, {LINES} SELECT book_id, count(*) AS n_lines, md5(string_agg(line, chr(10) ORDER BY pos)) AS digest FROM l WHERE NOT regexp_matches(s, '{PAGE}') GROUP BY book_id")
def page_numbers_removed(spark, sf):
    md = N.remove_page_numbers(F.col("md"))
    return books(spark, sf).select("book_id", F.size(T.lines(md)).cast("long").alias("n_lines"), F.md5(md).alias("digest"))


@query(rf"WITH {BOOKS}, j AS (SELECT book_id, regexp_replace(md, '([\pL\pN_])-\n{WS}*([\pL\pN_])', '\1\2', 'g') AS md FROM books) SELECT book_id, CAST(length(md) AS INT) AS n_chars, md5(md) AS digest FROM j")
def hyphen_join(spark, sf):
    md = N.join_hyphenated_words(F.col("md"))
    return books(spark, sf).select("book_id", F.length(md).alias("n_chars"), F.md5(md).alias("digest"))


@query(f"WITH {NORM} SELECT book_id, CAST(length(md) AS INT) AS n_chars, md5(md) AS digest FROM norm")
def normalize_text(spark, sf):
    return normalized(spark, sf).select("book_id", F.length("md").alias("n_chars"), F.md5("md").alias("digest"))


@query(rf"""WITH {NORM}, {BOUND}, raw AS (SELECT book_id, s FROM l WHERE s <> '' AND length(s) < 80 AND s NOT LIKE '#%' GROUP BY ALL HAVING count(*) >= 3)
SELECT books.book_id, len(string_split(books.md, chr(10))) AS lines_before, len(string_split(norm.md, chr(10))) AS lines_after, len(string_split(books.md, chr(10))) - len(string_split(norm.md, chr(10))) AS lines_removed,
 (SELECT count(*) FROM raw WHERE raw.book_id = books.book_id) AS n_patterns, (SELECT count(*) FROM bd WHERE bd.book_id = books.book_id) AS n_boundaries FROM books JOIN norm ON books.book_id = norm.book_id""")
def normalization_stats(spark, sf):
    return N.normalization_stats(books(spark, sf))


@query(f"WITH {NORM}, {BOUND} SELECT book_id, CAST(pos AS INT) AS line_number, title, line AS heading_text, chapter_type FROM bd")
def chapter_boundaries(spark, sf):
    return N.chapter_boundaries(normalized(spark, sf))


@query(f"WITH {NORM}, {BOUND} SELECT book_id, chapter_type, count(*) AS n FROM bd GROUP BY ALL")
def boundary_type_counts(spark, sf):
    return N.boundary_type_counts(normalized(spark, sf))


# ---- chapters --------------------------------------------------------------------


@query(f"WITH {CHAPTERS} SELECT book_id, CAST(chapter_pos AS INT) AS chapter_pos, chapter_id, title, chapter_type, CAST(start_line AS INT) AS start_line, CAST(end_line AS INT) AS end_line, CAST({words_re('content')} AS INT) AS words, md5(content) AS digest FROM ch")
def chapter_spans_auto(spark, sf):
    return split(spark, sf).select("book_id", "chapter_pos", "chapter_id", "title", "chapter_type", "start_line", "end_line", T.count_words("content").alias("words"), F.md5("content").alias("digest"))


#: Rules whose patterns mean the same in both dialects.
RULES = (C.ChapterRule("00_foreword", "Foreword", "^# Foreword"), C.ChapterRule("01_thanks", "Thanks", "^# Acknowledgments", "^## Section 3"), C.ChapterRule("02_rest", "The rest", "^## Section 4"))


def _manual_sql() -> str:
    each = []
    for k, rule in enumerate(RULES):
        until = rule.end_pattern or (RULES[k + 1].start_pattern if k + 1 < len(RULES) else None)
        start = f"(strpos(chr(10) || md, chr(10) || '{rule.start_pattern[1:]}'))"
        stop = f"strpos(chr(10) || substr(md, {start}), chr(10) || '{until[1:]}') + {start} - 1" if until else "length(md) + 1"
        first = f"length(substr(md, 1, {start} - 1)) - length(replace(substr(md, 1, {start} - 1), chr(10), '')) + 1"
        last = f"length(substr(md, 1, {stop} - 1)) - length(replace(substr(md, 1, {stop} - 1), chr(10), ''))" if until else "len(string_split(md, chr(10)))"
        each.append(f"SELECT book_id, {k + 1} AS chapter_pos, '{rule.id}' AS chapter_id, '{rule.title}' AS title, CAST({first} AS INT) AS start_line, CAST({last} AS INT) AS end_line, md5(array_to_string((string_split(md, chr(10)))[{first}:{last}], chr(10))) AS digest FROM norm")
    return f"WITH {NORM} " + " UNION ALL ".join(each)


@query(_manual_sql())
def manual_chapter_split(spark, sf):
    return C.split_manual(normalized(spark, sf), list(RULES)).select("book_id", "chapter_pos", "chapter_id", "title", "start_line", "end_line", F.md5("content").alias("digest"))


@query(rf"""WITH {CHAPTERS}, w AS (SELECT *, {words_md('content')} AS words, lead(start_line) OVER (PARTITION BY book_id ORDER BY start_line) AS ahead FROM ch)
SELECT book_id, chapter_id, CAST(chapter_pos AS INT) AS chapter_pos, warning FROM (
SELECT *, 'short' AS warning FROM w WHERE words < 100 UNION ALL SELECT *, 'long' FROM w WHERE words > 10000 UNION ALL
SELECT *, 'generic_title' FROM w WHERE regexp_matches(title, '(?i)^(chapter|section|part) [0-9]+$|^untitled$') UNION ALL SELECT *, 'overlap' FROM w WHERE end_line >= ahead)""")
def ambiguous_chapters(spark, sf):
    return C.ambiguous(split(spark, sf))


@query(rf"""WITH {CHAPTERS} SELECT book_id, CAST(chapter_pos AS INT) AS chapter_pos, chapter_id, title, 'chapters/' || chapter_id || '.md' AS source_path, 'translated/' || chapter_id || '.md' AS translated_path, 'chunked' AS status, CAST({words_md('content')} AS INT) AS word_count, 0 AS chunk_count FROM ch""")
def chapter_metadata(spark, sf):
    return C.chapter_metadata(split(spark, sf))


# ---- blocks and chunks -------------------------------------------------------------

MARKER = rf"^{WS}*([-*+]|\p{{Nd}}+\.){WS}+"
_BLOCKS = rf"""WITH {BOOKS}, {LINES},
f AS (SELECT *, sum(CASE WHEN s LIKE '```%' THEN 1 ELSE 0 END) OVER (PARTITION BY book_id ORDER BY pos) AS fences FROM l),
k AS (SELECT *, CASE WHEN s LIKE '```%' OR fences % 2 = 1 THEN 'code_block' WHEN regexp_matches(line, '^#{{1,6}}{WS}+.+$') THEN 'heading' WHEN s LIKE '>%' THEN 'quote'
   WHEN regexp_matches(line, '{MARKER}') THEN 'list' WHEN s = '' THEN 'blank' ELSE 'paragraph' END AS type, CAST(floor((fences + 1) / 2) AS INT) AS fence_no FROM f),
st AS (SELECT *, CASE WHEN type = 'heading' OR lag(type) OVER w IS DISTINCT FROM type OR (type = 'code_block' AND lag(fence_no) OVER w <> fence_no) THEN 1 ELSE 0 END AS starts FROM k WINDOW w AS (PARTITION BY book_id ORDER BY pos)),
bl AS (SELECT book_id, type, sum(starts) OVER (PARTITION BY book_id ORDER BY pos) AS id, line, pos FROM st),
blk AS (SELECT book_id, type, string_agg(line, chr(10) ORDER BY pos) AS content, min(pos) AS p0 FROM bl WHERE type <> 'blank' GROUP BY book_id, type, id)"""


@query(rf"""{_BLOCKS} SELECT book_id, CAST(row_number() OVER (PARTITION BY book_id ORDER BY p0) - 1 AS INT) AS pos, type, md5(content) AS digest,
CAST(CASE WHEN type = 'heading' THEN length(regexp_extract(content, '^(#+)', 1)) END AS INT) AS level FROM blk""")
def markdown_blocks(spark, sf):
    return B.markdown_blocks(books(spark, sf), "md").select("book_id", "pos", "type", F.md5("content").alias("digest"), "level")


@query(rf"""{_BLOCKS}, li AS (SELECT book_id, p0, unnest(string_split(content, chr(10))) AS line, generate_subscripts(string_split(content, chr(10)), 1) AS k FROM blk WHERE type = 'list'),
it AS (SELECT *, sum(CASE WHEN regexp_matches(line, '{MARKER}') THEN 1 ELSE 0 END) OVER (PARTITION BY book_id, p0 ORDER BY k) AS item FROM li)
SELECT book_id, string_agg(line, chr(10) ORDER BY k) AS item FROM it WHERE item > 0 GROUP BY book_id, p0, item""")
def list_items(spark, sf):
    return B.markdown_blocks(books(spark, sf), "md").where("type = 'list'").select("book_id", F.explode(B.list_items(F.col("content"))).alias("item"))


def _paragraph_sql(x: str) -> str:
    return f"list_transform(list_filter(list_transform(string_split({x}, chr(10) || chr(10)), lambda p: {strip('p')}), lambda p: p <> '' AND p NOT LIKE '#%' AND p NOT LIKE '```%'), lambda p: {strip(f"regexp_replace(p, '{WS}+', ' ', 'g')")})"


def _cut_sql(x: str) -> str:
    return f"CASE WHEN length({x}) <= 500 THEN {x} ELSE regexp_replace(substr({x}, 1, 499), '{WS}+$', '') || '…' END"


@query(rf"WITH {CHAPTERS}, g AS (SELECT book_id, chapter_pos, {_paragraph_sql('content')} AS p FROM ch) SELECT book_id, CAST(chapter_pos AS INT) AS chapter_pos, CAST(len(p) AS INT) AS n, {_cut_sql('p[1]')} AS first_paragraph, {_cut_sql('p[-1]')} AS last_paragraph FROM g")
def paragraphs_first_last(spark, sf):
    text = F.col("content")
    return split(spark, sf).select("book_id", "chapter_pos", F.size(B.paragraphs(text)).alias("n"), TR.first_paragraph(text).alias("first_paragraph"), TR.last_paragraph(text).alias("last_paragraph"))


def _fold(units: str, limit: int, gap: int) -> str:
    return f"""list_reduce(list_transform({units}, lambda u: {{'n': CAST(length(u) AS BIGINT), 'g': CAST(-1 AS BIGINT), 'o': CAST([] AS BIGINT[])}}), lambda a, x:
 CASE WHEN a.g >= 0 AND a.n + {gap} + x.n <= {limit} THEN {{'n': a.n + {gap} + x.n, 'g': a.g, 'o': list_append(a.o, a.g)}} ELSE {{'n': x.n, 'g': a.g + 1, 'o': list_append(a.o, a.g + 1)}} END,
 {{'n': CAST(0 AS BIGINT), 'g': CAST(-1 AS BIGINT), 'o': CAST([] AS BIGINT[])}}).o"""


@query(rf"""WITH w AS (SELECT doc_id, {strip(f"regexp_replace(text, '{WS}+', ' ', 'g')")} AS t FROM documents),
u AS (SELECT doc_id, t, list_filter(string_split(t, ' '), lambda x: x <> '') AS u FROM w), g AS (SELECT doc_id, unnest(u) AS word, generate_subscripts(u, 1) AS k, unnest({_fold('u', 300, 1)}) AS part FROM u WHERE length(t) > 300),
s AS (SELECT doc_id, part, string_agg(word, ' ' ORDER BY k) AS t FROM g GROUP BY doc_id, part UNION ALL SELECT doc_id, 0, t FROM w WHERE length(t) <= 300)
SELECT doc_id, CAST(part AS INT) AS part, CAST(length(t) AS INT) AS n_chars, md5(t) AS digest FROM s""")
def paragraph_split(spark, sf):
    found = table(spark, sf, "documents").select("doc_id", F.posexplode(H.split_paragraph(F.col("text"), 300)).alias("part", "t"))
    return found.select("doc_id", "part", F.length("t").alias("n_chars"), F.md5("t").alias("digest"))


@query(rf"""WITH u AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: {strip('x')}), lambda x: x <> '') AS u FROM documents),
g AS (SELECT doc_id, unnest(u) AS unit, generate_subscripts(u, 1) AS k, unnest({_fold('u', 300, 2)}) AS part FROM u),
s AS (SELECT doc_id, part, string_agg(unit, chr(10) || chr(10) ORDER BY k) || chr(10) AS t FROM g GROUP BY doc_id, part)
SELECT CAST(doc_id AS VARCHAR) AS book_id, 'c_' || format('{{:04d}}', part + 1) AS chunk_id, CAST(part + 1 AS INT) AS sequence, CAST(length(t) AS INT) AS char_count, md5(t) AS digest FROM s""")
def chunk_pack(spark, sf):
    units = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("book_id"), F.lit(1).alias("chapter_pos"), F.lit("c").alias("chapter_id"), F.filter(F.transform(T.lines("text"), T.py_strip), lambda x: x != "").alias("units"))
    return H.pack(units, 300).select("book_id", "chunk_id", "sequence", "char_count", F.md5("content").alias("digest"))


@query(f"SELECT doc_id, CAST({words_md('text')} AS INT) AS words FROM documents")
def word_count_md(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.count_markdown_words("text").alias("words"))


@query(f"SELECT doc_id, CAST({words_re('text')} AS INT) AS words FROM documents")
def word_count_re(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.count_words("text").alias("words"))


# ---- glossaries --------------------------------------------------------------------

_NL = "chr(10)"
#: One table per benchmark item: header, separator, the item's first words as terms, a short row.
GLOSSARY = f"concat('# Terms', {_NL}, {_NL}, '| English | Russian | Notes |', {_NL}, '|---|---|---|', {_NL}, '| ', translate(substr(text, 1, 5), concat('|', chr(10)), '//'), ' | слово ', CAST(item_id AS STRING), ' | n |', {_NL}, '| only |', {_NL}, '| | |  |', {_NL}, '| ', translate(substr(text, 1, 9), concat('|', chr(10)), '//'), ' | другое | |', {_NL}, {_NL}, 'no | table')"


@query(rf"""WITH g AS (SELECT CAST(item_id AS VARCHAR) AS book_id, {GLOSSARY} AS md FROM benchmark), r AS (SELECT book_id, pos, {strip('line')} AS line FROM ({rows_of('g')})),
c AS (SELECT book_id, pos, list_transform(string_split(regexp_replace(regexp_replace(line, '^\|', ''), '\|$', ''), '|'), lambda x: {strip('x')}) AS c FROM r WHERE pos BETWEEN 5 AND 8)
SELECT book_id, CAST(pos - 1 AS INT) AS pos, c[1] AS english, c[2] AS russian, coalesce(c[3], '') AS notes FROM c WHERE len(c) >= 2 AND (c[1] <> '' OR c[2] <> '')""")
def glossary_parse(spark, sf):
    return G.parse_tables(table(spark, sf, "benchmark").select(F.col("item_id").cast("string").alias("book_id"), F.expr(GLOSSARY).alias("md")))


_MERGED = """a AS (SELECT *, lower(english) AS term FROM r QUALIFY row_number() OVER (PARTITION BY lower(english) ORDER BY pos DESC) = 1), b AS (SELECT *, lower(english) AS term FROM p QUALIFY row_number() OVER (PARTITION BY lower(english) ORDER BY pos DESC) = 1),
m AS (SELECT coalesce(b.term, a.term) AS term, coalesce(b.english, a.english) AS english, coalesce(b.russian, a.russian) AS russian, coalesce(b.notes, a.notes) AS notes, CASE WHEN b.term IS NULL THEN 'root' ELSE 'project' END AS source FROM a FULL JOIN b ON a.term = b.term)"""
#: Glossaries of all parts: names that repeat, and customers' segments beside them. The same text in Spark and DuckDB.
PART_ROOT = "SELECT CAST(p_partkey AS INT) AS pos, p_name AS english, p_brand AS russian, CASE WHEN p_size % 2 = 0 THEN p_type ELSE '' END AS notes FROM part"
PART_PROJECT = "SELECT CAST(p_partkey AS INT) AS pos, CASE WHEN p_size % 3 = 0 THEN upper(p_name) ELSE concat(p_name, ' new') END AS english, CASE WHEN p_size % 2 = 0 THEN p_brand ELSE p_type END AS russian, '' AS notes FROM part"
_PARTS = f"r AS ({PART_ROOT}), p AS ({PART_PROJECT}), {_MERGED}"


def part_terms(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    table(spark, sf, "part").createOrReplaceTempView("part")
    return spark.sql(PART_ROOT), spark.sql(PART_PROJECT)


@query(f"WITH {_PARTS} SELECT * FROM m")
def glossary_merge(spark, sf):
    return G.merge(*part_terms(spark, sf))


@query(f"WITH {_PARTS} SELECT a.term, b.english || ': root=''' || a.russian || ''' project=''' || b.russian || '''' AS conflict FROM a JOIN b ON a.term = b.term WHERE a.russian <> b.russian")
def glossary_conflicts(spark, sf):
    return G.conflicts(*part_terms(spark, sf))


_GT = "gt AS (SELECT string_agg('- ' || english || ' -> ' || russian || CASE WHEN notes <> '' THEN ' (' || notes || ')' ELSE '' END, chr(10) ORDER BY term) AS glossary FROM m)"
#: The prompts' glossaries: terms of all benchmark items, and a project's own for every third.
ITEM_TERMS = "SELECT CAST(item_id AS INT) AS pos, substr(text, CAST(1 + item_id % 11 AS INT), CAST(4 + item_id % 6 AS INT)) AS english, substr(text, CAST(20 + item_id % 7 AS INT), 7) AS russian, '' AS notes FROM benchmark"
ITEM_PROJECT = ITEM_TERMS.replace("20 + item_id", "30 + item_id").replace("'' AS notes", "'own' AS notes") + " WHERE item_id % 3 = 0"
_PROMPT_TERMS = f"r AS ({ITEM_TERMS}), p AS ({ITEM_PROJECT}), {_MERGED}, {_GT}"


def item_glossary(spark: SparkSession, sf: str) -> DataFrame:
    """Both glossaries of the benchmark, merged."""
    table(spark, sf, "benchmark").createOrReplaceTempView("benchmark")
    return G.merge(spark.sql(ITEM_TERMS), spark.sql(ITEM_PROJECT))


@query(f"WITH {_PARTS}, {_GT} SELECT glossary FROM gt")
def glossary_prompt(spark, sf):
    return G.prompt_text(G.merge(*part_terms(spark, sf)))


# ---- translation -------------------------------------------------------------------

_CONTEXT = rf"""pg AS (SELECT *, {_paragraph_sql('content')} AS p FROM chunks),
cx AS (SELECT *, lag({_cut_sql('p[-1]')}) OVER w AS previous_summary, lead({_cut_sql('p[1]')}) OVER w AS next_summary FROM pg WINDOW w AS (PARTITION BY book_id, chapter_id ORDER BY sequence))"""


@query(f"WITH {CHUNKS}, {_CONTEXT} SELECT book_id, chunk_id, previous_summary, next_summary FROM cx")
def neighbor_context(spark, sf):
    return TR.with_context(chunks(spark, sf)).select("book_id", "chunk_id", "previous_summary", "next_summary")


@query("SELECT conv_id, turn, lag(text) OVER w AS previous_text, lead(text) OVER w AS next_text FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)")
def neighbor_turns(spark, sf):
    w = Window.partitionBy("conv_id").orderBy("turn")
    return table(spark, sf, "conversations").select("conv_id", "turn", F.lag("text").over(w).alias("previous_text"), F.lead("text").over(w).alias("next_text"))


_ELIGIBLE = f"({BLANK} AND status NOT IN ('translated', 'approved') AND status <> 'error')"


def prompt_sql(of: str) -> str:
    lines = ["'# Glossary'", "glossary", "''", "'# Context, for reference only'", f"'Chapter: ' || {of}.chapter_id", f"'Before: ' || CASE WHEN coalesce(previous_summary, '') = '' THEN '{TR.FIRST}' ELSE previous_summary END", f"'After: ' || CASE WHEN coalesce(next_summary, '') = '' THEN '{TR.LAST}' ELSE next_summary END"]
    lines += ["''", "'# Source'", "content", "''", "'# Instructions'", f"'1. {TR.MODES['normal']}'", "'2. Use the glossary''s terms.'", "'3. Keep the markdown structure, links and images.'", "'4. Return the translation only.'"]
    return " || chr(10) || ".join(lines) + " || chr(10)"


@query(f"WITH {CHUNKS}, {_CONTEXT}, {_PROMPT_TERMS} SELECT cx.book_id, chunk_id, md5({prompt_sql('cx')}) AS digest FROM cx, gt")
def translation_prompt(spark, sf):
    held = G.prompt_text(item_glossary(spark, sf))
    rows = TR.with_context(chunks(spark, sf)).crossJoin(F.broadcast(held))  # one row
    return rows.select("book_id", "chunk_id", F.md5(TR.prompt(F.col("glossary"), F.col("chapter_id"), F.col("previous_summary"), F.col("next_summary"), F.col("content"))).alias("digest"))


@query(f"WITH {CHUNKS} SELECT book_id, chunk_id, {_ELIGIBLE} AS first_run, ({BLANK} AND status NOT IN ('translated', 'approved')) AS retry, (status IN ('translated', 'approved') OR NOT {BLANK}) AS translated FROM chunks")
def eligible_chunks(spark, sf):
    s, t = F.col("status"), F.col("translation")
    return chunks(spark, sf).select("book_id", "chunk_id", TR.should_translate(s, t).alias("first_run"), TR.should_translate(s, t, retry_failed=True).alias("retry"), TR.is_translated(s, t).alias("translated"))


@query(rf"WITH {CHUNKS} SELECT book_id, chunk_id, '{TR.ECHO}' || chr(10) || {strip('content')} || chr(10) AS translation, 'translated' AS status FROM chunks WHERE {_ELIGIBLE}")
def echo_translate(spark, sf):
    open_ = chunks(spark, sf).where(TR.should_translate(F.col("status"), F.col("translation")))
    return open_.select("book_id", "chunk_id", TR.echo(F.col("content")).alias("translation"), F.lit("translated").alias("status"))


@query(rf"WITH {CHUNKS} SELECT book_id, chunk_id, '{TR.ECHO}' || chr(10) || {strip('content')} || chr(10) AS translation, 'translated' AS status, CAST(NULL AS VARCHAR) AS error FROM chunks WHERE {_ELIGIBLE}")
def provider_translate(spark, sf):
    open_ = TR.with_context(chunks(spark, sf)).where(TR.should_translate(F.col("status"), F.col("translation")))
    asked = open_.select("book_id", "chunk_id", TR.prompt(F.lit(G.NONE), F.col("chapter_id"), F.col("previous_summary"), F.col("next_summary"), F.col("content")).alias("prompt"))
    return TR.translate(asked, TR.EchoProvider)


@query(f"WITH {CHUNKS} SELECT book_id, chapter_id, CASE WHEN bool_and(status IN ('translated', 'approved') OR NOT {BLANK}) THEN 'translated' WHEN bool_or(status = 'error') THEN 'error' ELSE 'chunked' END AS status FROM chunks GROUP BY book_id, chapter_id")
def chapter_status_rollup(spark, sf):
    return TR.chapter_statuses(chunks(spark, sf))


@query(f"""WITH {CHUNKS} SELECT book_id, count(*) AS total, count(*) FILTER (status IN ('translated', 'approved') OR NOT {BLANK}) AS translated, count(*) FILTER {_ELIGIBLE} AS pending, count(*) FILTER (status = 'error') AS error,
arg_min(chunk_id, chapter_id || lpad(CAST(sequence AS VARCHAR), 9, '0')) FILTER {_ELIGIBLE} AS next_chunk_id FROM chunks GROUP BY book_id""")
def chat_status(spark, sf):
    return TR.chat_status(chunks(spark, sf))


@query(f"WITH {CHUNKS} SELECT book_id, chunk_id, sequence FROM chunks WHERE {_ELIGIBLE} ORDER BY book_id, chapter_id, sequence LIMIT 1")
def next_chunk(spark, sf):
    return TR.next_chunks(chunks(spark, sf)).select("book_id", "chunk_id", "sequence")


# ---- review ------------------------------------------------------------------------

_A, _B = "source", "translated"
_LIST, _QUOTE = rf"(?m)^{WS}*([-*+]|\p{{Nd}}+\.){WS}+", rf"(?m)^{WS}*>"
_SAID = "SELECT book_id, '{0}' AS check_id, chapter_id, 'structure' AS category, '{1}' AS severity, {2} AS message FROM two WHERE {3}"


def _structural_sql() -> str:
    la, lb = levels(_A), levels(_B)
    there = "translated IS NOT NULL AND "
    count = lambda x, p: f"len(regexp_extract_all({x}, '{p}'))"
    return " UNION ALL ".join(
        [
            _SAID.format("missing", "error", "'Translation is missing'", "translated IS NULL"),
            _SAID.format("empty", "error", "'Translation is empty'", f"{there} {strip('translated')} = ''"),
            _SAID.format("heading_count", "warning", f"'Heading count differs: source=' || len({la}) || ' translated=' || len({lb})", f"{there} len({la}) <> len({lb})"),
            _SAID.format("heading_levels", "warning", "'Heading levels differ'", f"{there} len({la}) = len({lb}) AND {la} <> {lb}"),
            _SAID.format("lists", "warning", "'List items are lost'", f"{there} {count(_A, _LIST)} > 0 AND {count(_B, _LIST)} = 0"),
            _SAID.format("quotes", "warning", "'Block quotes are lost'", f"{there} {count(_A, _QUOTE)} > 0 AND {count(_B, _QUOTE)} = 0"),
            _SAID.format("size", "warning", f"'Translation is far longer: source=' || {words_re(_A)} || ' translated=' || {words_re(_B)}", f"{there} {words_re(_A)} > 0 AND {words_re(_B)} > 3 * {words_re(_A)}"),
        ]
    )


@query(f"WITH {BOTH} {_structural_sql()}")
def structural_issues(spark, sf):
    return R.structural(both_texts(spark, sf))


def item_terms(spark: SparkSession, sf: str) -> DataFrame:
    table(spark, sf, "benchmark").createOrReplaceTempView("benchmark")
    return spark.sql(ITEM_TERMS)


@query(f"""WITH t AS (SELECT source AS book_id, text FROM documents), g AS (SELECT english, russian FROM ({PART_ROOT}) UNION SELECT english, russian FROM ({ITEM_TERMS}))
SELECT b.book_id, english, russian FROM (SELECT DISTINCT book_id FROM t) b, g WHERE english <> '' AND russian <> '' AND NOT EXISTS (SELECT 1 FROM t WHERE t.book_id = b.book_id AND (contains(lower(text), lower(english)) OR contains(text, russian)))""")
def glossary_absent_terms(spark, sf):
    """All part names, and terms of the benchmark, in all documents."""
    texts = table(spark, sf, "documents").select(F.col("source").alias("book_id"), F.col("text").alias("content"))
    return R.absent_terms(part_terms(spark, sf)[0].unionByName(item_terms(spark, sf)), texts)


@query(rf"""WITH r AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
w AS (SELECT doc_id, pos, list_filter(regexp_split_to_array(line, '[^\pL\pN_]+'), lambda x: regexp_full_match(x, '[A-Za-z]{{4,}}')) AS w FROM r WHERE {strip('line')} <> '' AND {strip('line')} NOT LIKE 'http%' AND {strip('line')} NOT LIKE '```%')
SELECT doc_id, CAST(pos AS INT) AS line_number, CAST(len(w) AS INT) AS n_words, array_to_string(w[1:8], ' ') AS words FROM w WHERE len(w) >= 5""")
def english_fragments(spark, sf):
    return R.english_fragments(table(spark, sf, "documents").select("doc_id", "text"), ["doc_id"], "text")


@query(rf"WITH {CHUNKS} SELECT book_id, chunk_id, 'chunk_status' AS check_id FROM chunks WHERE status NOT IN ('translated', 'approved') UNION ALL SELECT book_id, chunk_id, 'chunk_text' FROM chunks WHERE {BLANK} UNION ALL SELECT book_id, '', 'image' FROM (SELECT DISTINCT book_id, chunk_id, unnest(regexp_extract_all(content || '![a](' || chunk_id || ')', '!\[[^\]]*\]\(([^)]+)\)', 1)) FROM chunks WHERE translation IS NOT NULL)")
def chunk_completeness(spark, sf):
    rows = chunks(spark, sf)
    both = rows.select("book_id", "chapter_id", F.concat("content", F.lit("![a]("), "chunk_id", F.lit(")")).alias("source"), "translation").withColumn("translated", F.regexp_replace("translation", r"!\[[^\]]*\]\([^)]*\)", ""))
    found = R.completeness(rows, both)
    return found.select("book_id", F.regexp_extract("message", r"^Chunk (\S+)", 1).alias("chunk_id"), "check_id")


_IMG = r"!\[[^\]]*\]\(([^)]+)\)"


@query(rf"WITH {BOTH}, s AS (SELECT book_id, chapter_pos, unnest(regexp_extract_all(source, '{_IMG}', 1)) AS image FROM two WHERE translated IS NOT NULL), t AS (SELECT book_id, chapter_pos, unnest(regexp_extract_all(translated, '{_IMG}', 1)) AS image FROM two) SELECT book_id, CAST(chapter_pos AS INT) AS chapter_pos, image FROM (SELECT * FROM s EXCEPT SELECT * FROM t)")
def image_ref_diff(spark, sf):
    both = both_texts(spark, sf).where("translated is not null")
    return both.select("book_id", "chapter_pos", F.explode(R.lost_images(F.col("source"), F.col("translated"))).alias("image"))


@query(f"""WITH {BOTH}, i AS ({_structural_sql()}), pen AS (SELECT book_id, count(*) AS n_issues, sum(CASE severity WHEN 'error' THEN 10 WHEN 'warning' THEN 5 ELSE 1 END) AS penalty FROM i GROUP BY book_id)
SELECT books.book_id, coalesce(n_issues, 0) AS n_issues, CAST(greatest(0, 100 - coalesce(penalty, 0)) AS DOUBLE) AS score FROM books LEFT JOIN pen ON books.book_id = pen.book_id""")
def quality_score(spark, sf):
    return R.score(R.structural(both_texts(spark, sf)), books(spark, sf))


# ---- publishing --------------------------------------------------------------------

_LABEL = "CASE WHEN chapter_id LIKE '%appendix%' THEN 'A' || regexp_extract(chapter_id, '^([0-9]+)_', 1) WHEN chapter_id LIKE '%notes%' THEN 'N' || regexp_extract(chapter_id, '^([0-9]+)_', 1) ELSE regexp_extract(chapter_id, '^([0-9]+)_', 1) END"
_KIND = f"CASE WHEN chapter_id LIKE '%foreword%' OR chapter_id LIKE '%acknowledg%' THEN '{P.KINDS['opening']}' WHEN chapter_id LIKE '%appendix%' THEN '{P.KINDS['appendix']}' WHEN chapter_id LIKE '%notes%' THEN '{P.KINDS['notes']}' ELSE '{P.KINDS['chapter']}' END"


@query(f"""WITH {CHAPTERS}, t AS (SELECT book_id, chapter_pos, chapter_id AS id, {_LABEL} AS label, {_KIND} AS kind, title, {words_re('content')} AS words FROM ch)
SELECT book_id, CAST(chapter_pos AS INT) AS chapter_pos, id, label, kind, title, CAST(words AS INT) AS words, lag(id) OVER w AS previous_id, lead(id) OVER w AS next_id FROM t WINDOW w AS (PARTITION BY book_id ORDER BY chapter_pos)""")
def published_toc(spark, sf):
    return P.neighbours(P.published(split(spark, sf)).select("book_id", "chapter_pos", "id", "label", "kind", "title", "words"))


@query(f"WITH {CHAPTERS}, t AS (SELECT book_id, sum({words_re('content')}) AS words FROM ch GROUP BY book_id) SELECT book_id, CAST(words AS BIGINT) AS words, CAST(round_even(words / 1000, 0) AS BIGINT) AS thousands, CAST(floor(words / 1000 + 0.5) AS BIGINT) AS thousands_up FROM t")
def word_thousands(spark, sf):
    return P.thousands(P.published(split(spark, sf)))


@query("SELECT doc_id, regexp_replace(source, '(?i)(SRC1)', '<mark>\\1</mark>', 'g') AS title FROM documents WHERE contains(lower(source || chr(10) || text), 'src1')")
def search_documents(spark, sf):
    found = P.search(table(spark, sf, "documents"), "  SRC1 ", "source", "text")
    return found.select("doc_id", T.highlight("source", "SRC1").alias("title"))


@query(rf"""WITH {CHAPTERS}, r AS (SELECT book_id, chapter_pos, {strip('line')} AS line, pos FROM ({rows_of('ch', 'content', 'book_id, chapter_pos')})), m AS (SELECT *, row_number() OVER (PARTITION BY book_id, chapter_pos ORDER BY pos) - 1 AS k FROM r WHERE regexp_matches(line, '^#{{2,3}}{WS}+.+$'))
SELECT book_id, CAST(chapter_pos AS INT) AS chapter_pos, CAST(k AS INT) AS section_no, 'section-' || (chapter_pos - 1) || '-' || k AS anchor, CAST(length(regexp_extract(line, '^(#+)', 1)) AS INT) AS level, regexp_extract(line, '^#{{2,3}}{WS}+(.+)$', 1) AS title FROM m""")
def section_rail(spark, sf):
    return P.section_rail(P.published(split(spark, sf)))


@query(rf"""WITH {BOOKS}, {LINES}, c AS (SELECT *, regexp_extract(line, '^\*\*Рис\.{WS}*([0-9]+)', 1) AS fig FROM l),
e AS (SELECT DISTINCT book_id, unnest(regexp_extract_all(md, '(?i)!\[[^\]]*?(?:Рис\.|Figure){WS}*([0-9]+)', 1)) AS fig FROM books),
d AS (SELECT c.*, e.fig IS NOT NULL AS there, CASE WHEN c.fig <> '' THEN row_number() OVER (PARTITION BY c.book_id, c.fig ORDER BY pos) END AS k FROM c LEFT JOIN e ON c.book_id = e.book_id AND c.fig = e.fig),
o AS (SELECT book_id, pos, CASE WHEN fig <> '' AND k = 1 AND NOT there AND CAST(fig AS INT) BETWEEN 1 AND 36 THEN '![Рис. ' || fig || '](images/imageFile' || (CAST(fig AS INT) + 1) || '.png)' || chr(10) || chr(10) || line ELSE line END AS line FROM d)
SELECT book_id, md5(string_agg(line, chr(10) ORDER BY pos)) AS digest FROM o GROUP BY book_id""")
def figure_injection(spark, sf):
    return books(spark, sf).select("book_id", F.md5(P.inject_figures(F.col("md"))).alias("digest"))


@query(rf"""WITH {BOOKS}, {LINES}, c AS (SELECT book_id, pos, regexp_extract(line, '^\*\*Рис\.{WS}*([0-9]+)', 1) AS figure FROM l)
SELECT book_id, CAST(pos AS INT) AS line_number, figure, 'images/imageFile' || (CAST(figure AS INT) + 1) || '.png' AS image FROM c WHERE figure <> '' AND TRY_CAST(figure AS INT) BETWEEN 1 AND {P.FIGURES}""")
def figure_images(spark, sf):
    return P.mapped_figures(books(spark, sf))


@query("SELECT page_id, replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#039;') AS escaped FROM pages")
def html_escape(spark, sf):
    return table(spark, sf, "pages").select("page_id", T.escape_html("html").alias("escaped"))


@query()
def markdown_to_html(spark, sf):
    return P.published(split(spark, sf)).select("book_id", "chapter_pos", render.markdown_to_html("raw").alias("html"))


@query("SELECT doc_id, 'data:text/plain;base64,' || to_base64(encode(text)) AS uri FROM documents")
def data_uri(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.data_uri(F.encode("text", "UTF-8"), F.lit("text/plain")).alias("uri"))


@query("""SELECT doc_id, CASE WHEN b < 1024 THEN b || ' B' WHEN b < 1048576 THEN CASE WHEN b / 1024 >= 10 THEN format('{:.0f} KB', b / 1024) ELSE format('{:.1f} KB', b / 1024) END ELSE CASE WHEN b / 1048576 >= 10 THEN format('{:.0f} MB', b / 1048576) ELSE format('{:.1f} MB', b / 1048576) END END AS size
FROM (SELECT doc_id, n_chars * n_chars AS b FROM documents)""")
def format_bytes(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.format_bytes(F.col("n_chars") * F.col("n_chars")).alias("size"))


@query("SELECT s_suppkey, regexp_replace(regexp_replace(lower(s_name), '[^a-z0-9а-яё]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM supplier")
def slugify(spark, sf):
    return table(spark, sf, "supplier").select("s_suppkey", T.slugify("s_name").alias("slug"))


_CONTACT = "CASE s_suppkey % 4 WHEN 0 THEN concat('@user', CAST(s_suppkey AS STRING)) WHEN 1 THEN concat('https://example.org/', CAST(s_suppkey AS STRING)) WHEN 2 THEN concat('a', CAST(s_suppkey AS STRING), '@example.org') ELSE s_name END"


@query(f"SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'https://t.me/user' || s_suppkey WHEN 1 THEN c WHEN 2 THEN 'mailto:' || c ELSE c END AS href FROM (SELECT s_suppkey, {_CONTACT} AS c FROM supplier)")
def contact_href(spark, sf):
    return table(spark, sf, "supplier").select("s_suppkey", T.contact_href(F.expr(_CONTACT)).alias("href"))


# ---- projects and state --------------------------------------------------------------


def _projects(spark: SparkSession, sf: str, every: bool = False) -> tuple[DataFrame, DataFrame]:
    """Metadata of suppliers as projects, done up to a stage by number; those of odd number have a state only with ``every``."""
    rows = table(spark, sf, "supplier")
    done = F.transform(F.array(*(F.lit(s) for s in L.STAGES)), lambda s, i: F.when(i <= F.pmod("s_suppkey", F.lit(9)), "done").otherwise("pending"))
    states = (rows if every else rows.where("s_suppkey % 2 = 0")).select(F.concat(F.lit("b"), "s_suppkey").alias("book_id"), F.map_from_arrays(F.array(*(F.lit(s) for s in L.STAGES)), done).alias("stages"))
    states = states.withColumn("current_stage", F.coalesce(L.next_pending(F.col("stages")), F.lit("publish")))
    return rows.select(F.concat(F.lit("b"), "s_suppkey").alias("book_id"), F.col("s_name").alias("title")), states


_STAGE_LIST = "[" + ", ".join(f"'{s}'" for s in L.STAGES) + "]"
_ALL_STATES = f"pr AS (SELECT 'b' || s_suppkey AS book_id, s_name AS title, CAST(s_suppkey % 9 AS INT) AS k, coalesce(({_STAGE_LIST})[CAST(s_suppkey % 9 AS INT) + 2], 'publish') AS current_stage FROM supplier)"
_STATES = _ALL_STATES.replace("FROM supplier)", "FROM supplier WHERE s_suppkey % 2 = 0)")


@query(f"WITH {_STATES} SELECT book_id AS project_id, title, current_stage FROM pr")
def list_projects(spark, sf):
    return L.list_projects(*_projects(spark, sf))


@query(f"WITH {_STATES}, w AS (SELECT greatest(10, max(length(book_id))) AS a, greatest(5, max(length(title))) AS b, greatest(13, max(length(current_stage))) AS c FROM pr) SELECT book_id AS project_id, rpad(book_id, CAST(a AS INT), ' ') || '  ' || rpad(title, CAST(b AS INT), ' ') || '  ' || rpad(current_stage, CAST(c AS INT), ' ') AS line FROM pr, w")
def project_table(spark, sf):
    return L.project_table(L.list_projects(*_projects(spark, sf)))


@query(f"WITH {_ALL_STATES} SELECT book_id, title, CAST(i AS INT) AS stage_pos, ({_STAGE_LIST})[i + 1] AS stage, CASE WHEN i <= k THEN 'done' ELSE 'pending' END AS status FROM pr, range(0, 9) t(i)")
def project_status(spark, sf):
    return L.project_status(*_projects(spark, sf, every=True))


@query(f"WITH {_ALL_STATES} SELECT book_id, CASE WHEN k >= 2 THEN current_stage WHEN k = 1 THEN 'split' ELSE 'extract' END AS current_stage, CASE WHEN k >= 1 THEN greatest(k, 2) + 1 ELSE 2 END AS n_done FROM pr")
def stage_progress(spark, sf):
    """The state after normalisation is done."""
    out = L.update_stage(_projects(spark, sf, every=True)[1], "normalize", "done")
    return out.select("book_id", "current_stage", F.size(F.filter(F.map_values("stages"), lambda v: v == "done")).alias("n_done"))
