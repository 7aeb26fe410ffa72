"""Queries of project work: chunk records, files, assembly, review, publishing and whole runs, and their SQL.

Queries that write do so below a fresh folder of ``spark.checkpoint.dir`` and
return what was read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import assemble as A
from quire.operators import chapters as C
from quire.operators import chunking as H
from quire.operators import glossary as G
from quire.operators import normalize as N
from quire.operators import publish as P
from quire.operators import review as R
from quire.operators import translate as TR
from quire.plans import catalogue as K
from quire.plans.catalogue import BLANK, BOOKS, BOTH, CHAPTERS, CHUNKS, MARKER, NORM, WS, books, chunks, query, rows_of, split, strip, table
from quire.plans.pipeline import Pipeline
from quire.session import work_dir
from quire.sources import books as S
from quire.sources import extract as X
from quire.sources import projects as J

# ---- chunk records -----------------------------------------------------------

_POS = "CAST(substr(chapter_id, 1, 2) AS INT)"


def placed(spark: SparkSession, sf: str) -> DataFrame:
    return chunks(spark, sf).withColumn("chapter_pos", F.expr(_POS))


@query(f"WITH {CHUNKS} SELECT book_id, {_POS} AS chapter_pos, chapter_id, count(*) AS chunk_count, 'chunked' AS status FROM chunks GROUP BY ALL")
def chunk_counts(spark, sf):
    rows = placed(spark, sf)
    return H.chapter_counts(rows.select("book_id", "chapter_pos", "chapter_id").distinct(), rows)


@query(f"""WITH {CHUNKS} SELECT book_id, chunk_id, chapter_id, sequence, CAST(length(content) AS INT) AS char_count, status, 'chunks/' || chapter_id || '/' || lpad(CAST(sequence AS VARCHAR), 4, '0') || '.en.md' AS source_path,
 'chunks/' || chapter_id || '/' || lpad(CAST(sequence AS VARCHAR), 4, '0') || '.ru.md' AS translated_path FROM chunks""")
def chunk_metadata(spark, sf):
    return H.chunk_metadata(chunks(spark, sf).withColumn("char_count", F.length("content")))


_SAVED = ("src1-0", "01_chapter_0002", "  Сохранено вручную ")


@query(f"""WITH {CHUNKS}, s AS (SELECT *, (book_id = '{_SAVED[0]}' AND chunk_id = '{_SAVED[1]}') AS own FROM chunks)
SELECT book_id, chunk_id, CASE WHEN own THEN '{_SAVED[2].strip()}' || chr(10) ELSE translation END AS translation, CASE WHEN own THEN 'translated' ELSE status END AS status, CASE WHEN own THEN 'chat' END AS translation_mode FROM s""")
def save_translation(spark, sf):
    return TR.save_translation(chunks(spark, sf), ["book_id", "chunk_id"], _SAVED[:2], _SAVED[2]).select("book_id", "chunk_id", "translation", "status", "translation_mode")


@query(f"""WITH {CHUNKS} SELECT book_id, chunk_id, CASE WHEN doc_id % 10 = 1 THEN 'saved' || chr(10) ELSE translation END AS translation, CASE WHEN doc_id % 10 = 1 THEN 'translated' ELSE status END AS status FROM chunks""")
def apply_translations(spark, sf):
    rows = chunks(spark, sf)
    updates = rows.where("doc_id % 10 = 1").select("book_id", "chunk_id", F.lit("saved\n").alias("translation"), F.lit("translated").alias("status"), F.lit(None).cast("string").alias("error"))
    return TR.apply_updates(rows, updates, ["book_id", "chunk_id"]).select("book_id", "chunk_id", "translation", "status")


@query(f"WITH {CHUNKS} SELECT book_id, chunk_id, chapter_id, sequence, md5(content) AS digest FROM chunks")
def validated_chunks(spark, sf):
    return J.validated_chunks(chunks(spark, sf)).select("book_id", "chunk_id", "chapter_id", "sequence", F.md5("content").alias("digest"))


@query(f"WITH {CHUNKS} SELECT book_id, chapter_id, sequence, md5(content) AS digest FROM chunks")
def written_chunks(spark, sf):
    path = work_dir(spark, "chunks")
    H.write_chunks(chunks(spark, sf).select("book_id", "chapter_id", "sequence", "content"), path)
    return spark.read.parquet(path).select("book_id", "chapter_id", "sequence", F.md5("content").alias("digest"))


@query(rf"""WITH {CHUNKS}, {K._CONTEXT}, {K._PROMPT_TERMS}, o AS (SELECT * FROM cx WHERE {K._ELIGIBLE} QUALIFY row_number() OVER (PARTITION BY book_id ORDER BY chapter_id, sequence) = 1)
SELECT book_id, chunk_id, md5({TR.packet_sql(K.prompt_sql("o"))}) AS digest FROM o, gt""")
def chat_packets(spark, sf):
    held = G.prompt_text(K.item_glossary(spark, sf))
    rows = TR.with_context(chunks(spark, sf)).withColumn("chapter_title", F.col("chapter_id")).crossJoin(F.broadcast(held))  # one row
    return TR.chat_packets(rows, F.col("glossary")).select("book_id", "chunk_id", F.md5("packet").alias("digest"))


# ---- chunks of chapters --------------------------------------------------------

_LIMIT = H.MAX_CHARS


def _collapsed(x: str) -> str:
    return strip(f"regexp_replace({x}, '{WS}+', ' ', 'g')")


_KEYS = "book_id, chapter_pos, chapter_id"
CHUNKED = rf"""{CHAPTERS}, cl AS (SELECT *, {strip('line')} AS s FROM ({rows_of('ch', 'content', _KEYS)})),
cf AS (SELECT *, sum(CASE WHEN s LIKE '```%' THEN 1 ELSE 0 END) OVER (PARTITION BY {_KEYS} ORDER BY pos) AS fences FROM cl),
ck AS (SELECT *, CASE WHEN s LIKE '```%' OR fences % 2 = 1 THEN 'code_block' WHEN regexp_matches(line, '^#{{1,6}}{WS}+.+$') THEN 'heading' WHEN s LIKE '>%' THEN 'quote'
   WHEN regexp_matches(line, '{MARKER}') THEN 'list' WHEN s = '' THEN 'blank' ELSE 'paragraph' END AS type, CAST(floor((fences + 1) / 2) AS INT) AS fence_no FROM cf),
cs AS (SELECT *, CASE WHEN type = 'heading' OR lag(type) OVER w IS DISTINCT FROM type OR (type = 'code_block' AND lag(fence_no) OVER w <> fence_no) THEN 1 ELSE 0 END AS starts FROM ck WINDOW w AS (PARTITION BY {_KEYS} ORDER BY pos)),
ci AS (SELECT *, sum(starts) OVER (PARTITION BY {_KEYS} ORDER BY pos) AS id FROM cs),
cb AS (SELECT {_KEYS}, type, string_agg(line, chr(10) ORDER BY pos) AS content, min(pos) AS p0 FROM ci WHERE type <> 'blank' GROUP BY {_KEYS}, type, id),
cn AS (SELECT *, lag(type) OVER w AS before, lag(content) OVER w AS head, lead(type) OVER w AS after FROM cb WINDOW w AS (PARTITION BY {_KEYS} ORDER BY p0)),
cp AS (SELECT {_KEYS}, p0, before, head, {_collapsed('content')} AS t FROM cn WHERE type = 'paragraph' AND (coalesce(before, '') = 'heading' OR length(content) > {_LIMIT})),
cw AS (SELECT *, list_filter(string_split(t, ' '), lambda x: x <> '') AS u FROM cp WHERE length(t) > {_LIMIT}),
cg AS (SELECT {_KEYS}, p0, before, head, unnest(u) AS word, generate_subscripts(u, 1) AS i, unnest({K._fold('u', _LIMIT, 1)}) AS k FROM cw),
ct AS (SELECT {_KEYS}, p0, before, head, k, string_agg(word, ' ' ORDER BY i) AS t FROM cg GROUP BY {_KEYS}, p0, before, head, k UNION ALL SELECT {_KEYS}, p0, before, head, 0, t FROM cp WHERE length(t) <= {_LIMIT}),
cx AS (SELECT {_KEYS}, p0, unnest(string_split(content, chr(10))) AS line, generate_subscripts(string_split(content, chr(10)), 1) AS i FROM cn WHERE type = 'list' AND length(content) > {_LIMIT}),
cy AS (SELECT *, sum(CASE WHEN regexp_matches(line, '{MARKER}') THEN 1 ELSE 0 END) OVER (PARTITION BY {_KEYS}, p0 ORDER BY i) AS item FROM cx),
cu AS (SELECT {_KEYS}, p0, k, CASE WHEN before = 'heading' AND k = 0 THEN {strip('head')} || chr(10) || chr(10) || t ELSE t END AS unit FROM ct
  UNION ALL SELECT {_KEYS}, p0, item, {strip("string_agg(line, chr(10) ORDER BY i)")} FROM cy WHERE item > 0 GROUP BY {_KEYS}, p0, item
  UNION ALL SELECT {_KEYS}, p0, 0, {strip('content')} FROM cn WHERE NOT (type = 'heading' AND coalesce(after, '') = 'paragraph') AND NOT (type = 'paragraph' AND (coalesce(before, '') = 'heading' OR length(content) > {_LIMIT})) AND NOT (type = 'list' AND length(content) > {_LIMIT})),
cq AS (SELECT {_KEYS}, list(unit ORDER BY p0, k) AS u FROM cu WHERE {strip('unit')} <> '' GROUP BY {_KEYS}),
cr AS (SELECT {_KEYS}, unnest(u) AS unit, generate_subscripts(u, 1) AS i, unnest({K._fold('u', _LIMIT, 2)}) AS part FROM cq),
cc AS (SELECT {_KEYS}, chapter_id || '_' || lpad(CAST(part + 1 AS VARCHAR), 4, '0') AS chunk_id, CAST(part + 1 AS INT) AS sequence, string_agg(unit, chr(10) || chr(10) ORDER BY i) || chr(10) AS content FROM cr GROUP BY {_KEYS}, part)"""


@query(f"WITH {CHUNKED} SELECT book_id, CAST(chapter_pos AS INT) AS chapter_pos, chunk_id, sequence, CAST(length(content) AS INT) AS char_count, md5(content) AS digest FROM cc")
def chapter_chunks(spark, sf):
    return H.chunk(split(spark, sf)).select("book_id", "chapter_pos", "chunk_id", "sequence", "char_count", F.md5("content").alias("digest"))


# ---- whole runs ------------------------------------------------------------------


@query(f"WITH {NORM} SELECT book_id, md5(md) AS digest FROM norm")
def run_until_normalize(spark, sf):
    return Pipeline(books(spark, sf)).run("normalize").tables["normalized"].select("book_id", F.md5("md").alias("digest"))


@query(f"WITH {CHAPTERS} SELECT book_id, chapter_id, md5(content) AS digest FROM ch")
def written_chapters(spark, sf):
    path = work_dir(spark, "chapters")
    C.write_chapters(Pipeline(books(spark, sf)).run("split").tables["chapters"], path)
    return spark.read.parquet(path).select("book_id", "chapter_id", F.md5("content").alias("digest"))


@query(rf"""WITH {CHUNKED}, ca AS (SELECT book_id, chapter_pos, chapter_id, string_agg('{TR.ECHO}' || chr(10) || {strip('content')}, chr(10) || chr(10) ORDER BY sequence) || chr(10) AS raw FROM cc GROUP BY {_KEYS})
SELECT book_id, CAST(chapter_pos AS INT) AS chapter_pos, chapter_id AS id, CAST({K.words_re('raw')} AS INT) AS words, md5(raw) AS digest FROM ca""")
def run_pipeline(spark, sf):
    return Pipeline(books(spark, sf), provider="echo").run("publish").tables["published"].select("book_id", "chapter_pos", "id", "words", F.md5("raw").alias("digest"))


_INPUT = "CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_name END"


@query(f"""WITH s AS (SELECT 'in/' || s_name || '.v1.pdf' AS input_file, coalesce({_INPUT}, s_name || '.v1') AS title FROM supplier)
SELECT input_file, title, regexp_replace(regexp_replace(lower(title), '[^a-z0-9а-яё]+', '-', 'g'), '^-+|-+$', '', 'g') AS book_id, 1 AS schema_version, 'en' AS source_language, 'extract' AS current_stage, 1 AS n_done FROM s""")
def init_projects(spark, sf):
    rows = table(spark, sf, "supplier").select(F.concat(F.lit("in/"), "s_name", F.lit(".v1.pdf")).alias("input_file"), F.expr(_INPUT).alias("title"), F.lit(None).cast("string").alias("book_id"))
    metadata, states = J.create(rows)
    done = F.size(F.filter(F.map_values("stages"), lambda v: v == "done")).alias("n_done")
    return metadata.join(states.select("book_id", "current_stage", done), "book_id").select("input_file", "title", "book_id", "schema_version", "source_language", "current_stage", "n_done")


# ---- files -------------------------------------------------------------------------


def _files(spark: SparkSession, sf: str) -> str:
    """The books as a markdown file each."""
    path = work_dir(spark, "markdown")
    books(spark, sf).select("md", "book_id").write.partitionBy("book_id").text(path)
    return path


_BOOK_OF = "regexp_extract(path, 'book_id=([^/]+)/', 1) AS book_id"
_FILES = f"WITH {BOOKS} SELECT book_id, md5(md || chr(10)) AS digest FROM books"


@query(_FILES)
def read_markdown(spark, sf):
    return S.read_markdown(spark, f"{_files(spark, sf)}/*").selectExpr(_BOOK_OF, "md5(md) AS digest")


@query(_FILES)
def extract_books(spark, sf):
    found = X.extract(spark, [f"{_files(spark, sf)}/*"], X.from_api(lambda raw, **options: raw.decode()))
    return found.where("error is null").selectExpr(_BOOK_OF, "md5(md) AS digest")


@query(f"WITH {CHAPTERS} SELECT book_id, CAST(chapter_pos AS INT) AS chapter_pos, chapter_id, title, 'chunked' AS status, CAST({K.words_md('content')} AS INT) AS word_count FROM ch")
def metadata_files(spark, sf):
    """Metadata of every book with its chapters, exported as JSON and read again."""
    own = C.chapter_metadata(split(spark, sf))
    listed = F.array_sort(F.collect_list(F.struct("chapter_pos", F.struct(F.col("chapter_id").alias("id"), "title", "source_path", "translated_path", "status", "word_count", "chunk_count").alias("c"))))
    rows = own.groupBy("book_id").agg(F.transform(listed, lambda x: x["c"]).alias("chapters"))
    path = work_dir(spark, "metadata")
    J.export_json(rows).select(F.col("json").alias("value"), "book_id").write.partitionBy("book_id").text(path)
    return S.chapter_rows(S.read_metadata(spark, path)).select("book_id", "chapter_pos", "chapter_id", "title", "status", "word_count")


@query(f"WITH {K._ALL_STATES} SELECT book_id, current_stage, ({K._STAGE_LIST})[2] AS second, CASE WHEN k >= 1 THEN 'done' ELSE 'pending' END AS extract_status FROM pr")
def latest_states(spark, sf):
    """States written in two versions; the newer one is read."""
    path, states = work_dir(spark, "states"), K._projects(spark, sf, every=True)[1]
    J.write_version(states.withColumn("current_stage", F.lit("init")), path, "1")
    J.write_version(states, path, "2")
    return J.read_latest(spark, path).select("book_id", "current_stage", F.lit("extract").alias("second"), F.col("stages")["extract"].alias("extract_status"))


_RULES = """CASE s_suppkey % 6 WHEN 0 THEN '{"chapters": [' WHEN 1 THEN '{"other": []}' WHEN 2 THEN '{"chapters": []}' WHEN 3 THEN '{"chapters": [{"id": "01", "title": "", "start_pattern": "^# A"}]}'
 WHEN 4 THEN concat('{"chapters": [{"id": "01", "title": "', s_name, '", "start_pattern": "^# A"}]}') ELSE concat('{"chapters": [{"id": "01", "title": "T", "start_pattern": "^# A"}, {"title": "', s_name, '"}]}') END"""


@query("""SELECT s_suppkey, CASE s_suppkey % 6 WHEN 0 THEN 'rules are not valid JSON' WHEN 1 THEN 'rules have no ''chapters'' key' WHEN 2 THEN 'rules list no chapters' WHEN 3 THEN 'rule 1 lacks title' WHEN 5 THEN 'rule 2 lacks id, start_pattern' END AS problem FROM supplier""")
def rule_problems(spark, sf):
    return table(spark, sf, "supplier").select("s_suppkey", C.rules_problem(F.expr(_RULES)).alias("problem"))


# ---- assembly --------------------------------------------------------------------

#: Gaps without dropping a chunk: a chapter's later chunks move up by a thirteenth of their place in the book.
_GAP = f"sequence + CAST(floor((10 * ({_POS} - 1) + sequence) / 13) AS INT)"
GAPPED = f"{CHUNKS}, k AS (SELECT * REPLACE ({_GAP} AS sequence) FROM chunks)"
ASSEMBLED = rf"""{GAPPED}, c AS (SELECT book_id, chapter_id, max(sequence) AS top, string_agg(CASE WHEN NOT {BLANK} THEN {strip('translation')} END, chr(10) || chr(10) ORDER BY sequence) || chr(10) AS content,
 bool_and(status NOT IN ('pending', 'chunked', 'error') AND NOT {BLANK}) AS fine, count(*) AS n FROM k GROUP BY book_id, chapter_id),
a AS (SELECT book_id, chapter_id, content, (fine AND n = top AND content IS NOT NULL) AS success FROM c)"""


def gapped(spark: SparkSession, sf: str) -> DataFrame:
    return chunks(spark, sf).withColumn("sequence", F.expr(_GAP))


@query(f"WITH {ASSEMBLED} SELECT book_id, chapter_id, md5(content) AS digest, success FROM a")
def assemble_chapters(spark, sf):
    return A.assemble(gapped(spark, sf)).select("book_id", "chapter_id", F.md5("content").alias("digest"), "success")


_MISSING = f"{GAPPED}, w AS (SELECT book_id, chapter_id, CAST(unnest(range(1, max(sequence) + 1)) AS INT) AS sequence FROM k GROUP BY book_id, chapter_id), gaps AS (SELECT w.* FROM w ANTI JOIN k ON w.book_id = k.book_id AND w.chapter_id = k.chapter_id AND w.sequence = k.sequence)"


@query(f"WITH {_MISSING} SELECT * FROM gaps")
def missing_sequences(spark, sf):
    return A.missing_sequences(gapped(spark, sf))


_LABEL = "chapter_id || '_' || lpad(CAST(sequence AS VARCHAR), 4, '0')"


@query(f"""WITH {_MISSING}, i AS (SELECT book_id, chapter_id, 0 AS part, sequence, 0 AS o, {_LABEL} || ': missing chunk' AS item FROM gaps
 UNION ALL SELECT book_id, chapter_id, 1, sequence, 0, {_LABEL} || ': status is ' || status FROM k WHERE status IN ('pending', 'chunked', 'error')
 UNION ALL SELECT book_id, chapter_id, 1, sequence, 1, {_LABEL} || CASE WHEN translation IS NULL THEN ': missing text' ELSE ': empty translation' END FROM k WHERE {BLANK})
SELECT book_id, chapter_id, '## ' || chapter_id || chr(10) || chr(10) || string_agg('- ' || item, chr(10) ORDER BY part, sequence, o) || chr(10) AS section FROM i GROUP BY book_id, chapter_id""")
def missing_report(spark, sf):
    return A.missing_report(A.assemble(gapped(spark, sf)))


_STATUS = f"CASE WHEN {_POS} % 3 = 0 THEN 'error' ELSE 'chunked' END"


@query(f"WITH {ASSEMBLED} SELECT book_id, chapter_id, CASE WHEN success THEN 'translated' ELSE {_STATUS} END AS status FROM a UNION ALL SELECT DISTINCT book_id, '99_extra', 'chunked' FROM a")
def assembly_statuses(spark, sf):
    done = A.assemble(gapped(spark, sf))
    metadata = done.select("book_id", "chapter_id", F.expr(_STATUS).alias("status")).unionByName(done.select("book_id", F.lit("99_extra").alias("chapter_id"), F.lit("chunked").alias("status")).distinct())
    return A.statuses(done, metadata)


_PROJECT = f"""{ASSEMBLED}, e AS (SELECT *, {_POS} % 4 = 0 AS there FROM a UNION ALL SELECT DISTINCT book_id, '99_extra', CAST(NULL AS VARCHAR), false, false FROM a)"""


def _assembled(spark, sf):
    done = A.assemble(gapped(spark, sf))
    every = done.select("book_id", "chapter_id").unionByName(done.select("book_id", F.lit("99_extra").alias("chapter_id")).distinct())
    return A.with_untouched(every, done, done.where(F.expr(f"{_POS} % 4 = 0")))


@query(f"WITH {_PROJECT} SELECT book_id, chapter_id, CASE WHEN NOT there THEN md5(content) END AS digest, (NOT there AND success) AS success, CASE WHEN there THEN 'already assembled' END AS warning FROM e")
def assemble_project(spark, sf):
    return _assembled(spark, sf).select("book_id", "chapter_id", F.md5("content").alias("digest"), "success", "warning")


@query(f"WITH {_PROJECT} SELECT book_id, CASE WHEN bool_and(NOT there AND success) THEN 'done' ELSE 'error' END AS stage FROM e GROUP BY book_id")
def assembly_stage(spark, sf):
    return A.project_stage(_assembled(spark, sf))


@query(f"WITH {ASSEMBLED} SELECT book_id, md5(string_agg(content, chr(10) ORDER BY {_POS})) AS digest FROM a WHERE content IS NOT NULL GROUP BY book_id")
def all_translated(spark, sf):
    done = A.assemble(gapped(spark, sf)).withColumn("chapter_pos", F.expr(_POS))
    return J.read_all_translated(done).select("book_id", F.md5("text").alias("digest"))


@query("SELECT doc_id, md5(array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), chr(10))) AS digest FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)")
def distinct_lines(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(F.array_join(A.stable_distinct(F.split("text", "\n", -1)), "\n")).alias("digest"))


# ---- review ------------------------------------------------------------------------

_TERMS_ROOT = f"g AS ({K.ITEM_TERMS})"
_ISSUES = rf"""{BOTH}, {CHUNKS}, {_TERMS_ROOT},
lr AS (SELECT book_id, chapter_id, line, pos FROM ({rows_of('tr', 'translated', 'book_id, chapter_id')})),
lw AS (SELECT *, list_filter(regexp_split_to_array(line, '[^\pL\pN_]+'), lambda x: regexp_full_match(x, '[A-Za-z]{{4,}}')) AS w FROM lr WHERE {strip('line')} <> '' AND {strip('line')} NOT LIKE 'http%' AND {strip('line')} NOT LIKE '```%'),
im AS (SELECT book_id, chapter_id, unnest(regexp_extract_all(source, '{K._IMG}', 1)) AS image FROM two WHERE translated IS NOT NULL EXCEPT SELECT book_id, chapter_id, unnest(regexp_extract_all(translated, '{K._IMG}', 1)) FROM two WHERE translated IS NOT NULL),
ri AS ({K._structural_sql()}
 UNION ALL SELECT b.book_id, 'term_absent', NULL, 'terminology', 'info', 'Term is not used: ' || english || ' -> ' || russian FROM (SELECT DISTINCT book_id FROM tr) b, (SELECT DISTINCT english, russian FROM g) g WHERE english <> '' AND russian <> '' AND NOT EXISTS (SELECT 1 FROM tr WHERE tr.book_id = b.book_id AND (contains(lower(translated), lower(english)) OR contains(translated, russian)))
 UNION ALL SELECT book_id, 'english', chapter_id, 'terminology', 'warning', 'English text on line ' || pos || ': ' || array_to_string(w[1:8], ' ') FROM lw WHERE len(w) >= 5
 UNION ALL SELECT book_id, 'chunk_status', chapter_id, 'completeness', 'error', 'Chunk ' || chunk_id || ' is ' || status FROM chunks WHERE status NOT IN ('translated', 'approved')
 UNION ALL SELECT book_id, 'chunk_text', chapter_id, 'completeness', 'error', 'Chunk ' || chunk_id || ' has no text' FROM chunks WHERE {BLANK}
 UNION ALL SELECT book_id, 'image', chapter_id, 'completeness', 'warning', 'Image is lost: ' || image FROM im)"""


def _issues(spark, sf):
    ch = K.written_split(spark, sf)
    return R.review(ch, K.translated(ch), chunks(spark, sf), K.item_terms(spark, sf))


@query(f"WITH {_ISSUES} SELECT * FROM ri")
def review_issues(spark, sf):
    return _issues(spark, sf)


_LINE = "'- [' || severity || '] ' || coalesce(chapter_id, 'book') || ': ' || message"


@query(f"""WITH {_ISSUES} SELECT book_id, count(*) AS n_issues, md5('# Quality report' || chr(10) || chr(10) || 'Score: ' || format('{{:.1f}}', CAST(greatest(0, 100 - sum(CASE severity WHEN 'error' THEN 10 WHEN 'warning' THEN 5 ELSE 1 END)) AS DOUBLE)) || chr(10) || 'Issues: ' || count(*) || chr(10) || chr(10) || string_agg({_LINE}, chr(10) ORDER BY category, check_id, {_LINE}) || chr(10)) AS digest FROM ri GROUP BY book_id""")
def quality_report(spark, sf):
    """The whole report of every book."""
    path = work_dir(spark, "issues")
    _issues(spark, sf).write.parquet(path)
    found = spark.read.parquet(path)
    scores = R.score(found)
    return R.report(found, scores).join(scores.select("book_id", "n_issues"), "book_id").select("book_id", "n_issues", F.md5("report").alias("digest"))


@query(rf"""WITH {NORM}, {K.BOUND}, n AS (SELECT books.book_id, len(string_split(books.md, chr(10))) AS b, len(string_split(norm.md, chr(10))) AS a FROM books JOIN norm ON books.book_id = norm.book_id),
raw AS (SELECT book_id, count(*) AS n FROM (SELECT book_id, s FROM l WHERE s <> '' AND length(s) < 80 AND s NOT LIKE '#%' GROUP BY ALL HAVING count(*) >= 3) GROUP BY book_id),
ty AS (SELECT book_id, sum(n) AS n, string_agg('- ' || chapter_type || ': ' || n, chr(10) ORDER BY chapter_type) AS kinds FROM (SELECT book_id, chapter_type, count(*) AS n FROM bd GROUP BY ALL) GROUP BY book_id)
SELECT n.book_id, '# Normalization report' || chr(10) || chr(10) || '- Lines before: ' || b || chr(10) || '- Lines after: ' || a || chr(10) || '- Lines removed: ' || (b - a) || chr(10) || '- Repeated line patterns: ' || coalesce(raw.n, 0) || chr(10) || '- Chapter boundaries: ' || coalesce(ty.n, 0)
 || chr(10) || chr(10) || '## Boundaries by type' || chr(10) || chr(10) || coalesce(kinds, '- none') || chr(10) AS report FROM n LEFT JOIN raw ON n.book_id = raw.book_id LEFT JOIN ty ON n.book_id = ty.book_id""")
def normalization_report(spark, sf):
    return N.report(N.normalization_stats(books(spark, sf)), N.boundary_type_counts(K.normalized(spark, sf)))


# ---- publishing --------------------------------------------------------------------

_IMAGE_LINE = r"^!\[([^\]]*)\]\((?:<([^>]+)>|([^)]+))\)$"


@query(rf"""WITH {CHAPTERS}, r AS (SELECT book_id, chapter_pos, pos, {strip('line')} AS s FROM ({rows_of('ch', 'content', 'book_id, chapter_pos')})), n AS (SELECT *, lead(s) OVER (PARTITION BY book_id, chapter_pos ORDER BY pos) AS after FROM r WHERE s <> '')
SELECT book_id, CAST(chapter_pos AS INT) AS chapter_pos, CAST(pos AS INT) AS line_number, regexp_extract(s, '{_IMAGE_LINE}', 1) AS alt, regexp_extract(s, '{_IMAGE_LINE}', 2) || regexp_extract(s, '{_IMAGE_LINE}', 3) AS src,
 CASE WHEN regexp_matches(after, '^\*\*Рис\.{WS}*[0-9]+') THEN {_collapsed(rf"regexp_replace(after, '{T.caption_parts(WS, '[0-9]')}', '\1 \2')")} END AS caption FROM n WHERE regexp_matches(s, '{_IMAGE_LINE}')""")
def figure_captions(spark, sf):
    return P.figures(P.published(split(spark, sf)))


@query("SELECT doc_id, replace(to_json({'doc_id': doc_id, 'text': text, 'lang': lang}), '<', '\\u003c') AS json FROM documents")
def json_for_html(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.json_for_html(F.struct("doc_id", "text", "lang")).alias("json"))


_CONTACT_OF = "concat('@', translate(book_id, '-', '_'))"
_META = f"m AS (SELECT book_id, 'Book <' || book_id || '> __DATA__' AS title, 'A & B' AS author, {_CONTACT_OF} AS contact FROM books)"
_ESCAPED = "replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


@query(rf"""WITH {CHAPTERS}, {_META}, t AS (SELECT book_id, chapter_pos, chapter_id AS id, {K._LABEL} AS label, {K._KIND} AS kind, title, {K.words_re('content')} AS words, content AS raw FROM ch),
j AS (SELECT book_id, string_agg(CAST(to_json({{'chapter_pos': CAST(chapter_pos AS INT), 'file': id || '.md', 'id': id, 'label': label, 'kind': kind, 'title': title, 'words': CAST(words AS INT), 'raw': raw}}) AS VARCHAR), ',' ORDER BY chapter_pos) AS chapters FROM t GROUP BY book_id),
d AS (SELECT m.*, replace('{{"metadata":' || CAST(to_json({{'book_id': m.book_id, 'title': title, 'author': author, 'source_language': 'en', 'target_language': 'ru', 'translator': {{'contact': contact}}}}) AS VARCHAR) || ',"chapters":[' || chapters || ']}}', '<', '\u003c') AS data FROM m JOIN j ON m.book_id = j.book_id),
h AS (SELECT book_id, '<!doctype html>' || chr(10) || '<html lang="ru"><head><meta charset="utf-8"><title>' || {_ESCAPED.format('title')} || '</title></head>' || chr(10) || '<body><header><h1>' || {_ESCAPED.format('title')} || '</h1><p>' || {_ESCAPED.format('author')} || '</p><p><a href="https://t.me/' || substr(contact, 2) || '" target="_blank" rel="noreferrer">' || contact || '</a></p></header><main id="reader"></main>' || chr(10)
 || '<script id="book" type="application/json">' || data || '</script></body></html>' || chr(10) AS html FROM d)
SELECT book_id, book_id || '-ru.html' AS file, CAST(strlen(html) AS INT) AS bytes, md5(html) AS digest FROM h""")
def publish_page(spark, sf):
    """Every book's page, written under its name and read again."""
    metadata = books(spark, sf).select(
        "book_id", F.concat(F.lit("Book <"), "book_id", F.lit("> __DATA__")).alias("title"), F.lit("A & B").alias("author"), F.lit("en").alias("source_language"), F.lit("ru").alias("target_language"), F.struct(F.expr(_CONTACT_OF).alias("contact")).alias("translator")
    )
    folder = work_dir(spark, "pages")
    P.write_pages(P.publish_page(P.published(split(spark, sf)), metadata), folder)
    found = spark.read.format("binaryFile").load(f"{folder}/*.html").withColumn("file", F.element_at(F.split("path", "/"), -1))
    return found.select(F.regexp_replace("file", "-ru[.]html$", "").alias("book_id"), "file", F.col("length").cast("int").alias("bytes"), F.md5("content").alias("digest"))


_HAS = "regexp_matches(x, '[02468][.]png$')"


@query(rf"""WITH {CHAPTERS}, r AS (SELECT book_id, chapter_pos, content, list_filter(list_distinct(regexp_extract_all(content, '!\[[^\]]*\]\(([^)]+)\)', 1)), lambda x: {_HAS}) AS refs FROM ch)
SELECT book_id, CAST(chapter_pos AS INT) AS chapter_pos, md5(list_reduce(list_prepend(content, refs), lambda a, x: replace(a, '](' || x || ')', '](data:image/png;base64,' || to_base64(encode(book_id || '/' || regexp_extract(x, '[^/]+$'))) || ')'))) AS digest FROM r""")
def embed_images(spark, sf):
    """Figures of even number have an image file, in the source's folder."""
    chapters = P.published(K.written_split(spark, sf))
    name = F.concat(F.lit("f"), "n", F.lit(".png"))
    images = books(spark, sf).select("book_id", F.explode(F.sequence(F.lit(0), F.lit(S.BOOK_IDS), F.lit(2))).alias("n")).select("book_id", F.concat(F.lit("source/images/"), name).alias("path"), F.encode(F.concat("book_id", F.lit("/"), name), "UTF-8").alias("content"))
    return P.embed_images(chapters, images).select("book_id", "chapter_pos", F.md5("raw").alias("digest"))
