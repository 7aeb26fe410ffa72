"""One query per operator over its whole table, and the SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, conversation_repair, decontamination, language_model, prefix_trie, quality, secrets, simhash, substring_dedup, suffix_dedup, token_files, toxicity, warc
from ._common import shared_dir


def tokenizer(name: str) -> str:
    """The place of a public tokenizer's file; the package is installed on every node."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_index(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", F.col("rank").alias("capture_rank"))


def op2_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English texts are an earlier version of the table; the scan of the whole table takes up its ledger."""
    documents, ledger = table(spark, sf_dir, "documents"), shared_dir(spark, "ledger")
    secrets.scan(documents.where("lang = 'en'"), ledger)
    found = secrets.scan(documents, ledger)
    kinds = [F.size(F.filter("spans", lambda s: s["kind"] == F.lit(k))).cast("long").alias(f"n_{r.kind}") for k, r in enumerate(secrets.RULES)]
    named = secrets.named(F.col("spans"))
    return found.select("doc_id", *kinds, F.sha2(named, 256).alias("base_sha256"), named.alias("spans"), F.col("scanned").alias("scanned_anew"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeated(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_boilerplate")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated", "n_near")


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeated(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "n_shared")


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted", "margin")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(table(spark, sf_dir, "conversations"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_warc_index, op2_secret_ledger, op3_substring_dedup, op4_simhash, op5_bpe, op6_token_files, op7_quality, op8_decontamination, op9_language_model, op10_suffix_dedup, op11_toxicity, op12_conversation_repair, op13_prefix_trie, pipeline)
    return {f.__name__: f for f in own}


#: Words of the contracts in DuckDB.
_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

_OP1 = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, coalesce(url, 'urn:page:' || page_id) AS url FROM pages),
k AS (SELECT *, regexp_extract(url, '^([a-z]+)://', 1) AS scheme, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS site, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(url, '^[^?#]*(\?[^#]+)', 1) AS query FROM p),
h AS (SELECT *, regexp_replace(regexp_extract(lower(site), '^([^:]*)', 1), '^www\.', '') AS host, regexp_extract(site, ':([0-9]+)$', 1) AS port FROM k),
u AS (SELECT page_id, CASE WHEN site = '' THEN url ELSE array_to_string(list_reverse(string_split(host, '.')), ',') || CASE WHEN port IN ('', CASE scheme WHEN 'http' THEN '80' WHEN 'https' THEN '443' END) THEN '' ELSE ':' || port END || ')' || CASE WHEN path = '' THEN '/' ELSE path END || query END AS url_key FROM h),
o AS (SELECT page_id, row_number() OVER (ORDER BY url_key, page_id) AS capture_rank FROM u),
q AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest FROM p),
r AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM q)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND top <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND top <> page_id THEN top END AS refers_to, capture_rank
FROM r JOIN o USING (page_id)
"""


def _secret_sql() -> str:
    each = []
    for k, rule in enumerate(secrets.RULES):
        pattern = rule.pattern.replace("'", "''")
        each.append(f"""
SELECT doc_id, {k} AS k, '{rule.kind}' AS kind, m, v,
       list_transform(range(1, len(m) + 1), lambda i: CAST(list_sum(list_transform(s[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[:i - 1], lambda x: length(x))), 0) AS BIGINT)) AS pos
FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}', 0) AS m, regexp_extract_all(t, '{pattern}', {rule.group}) AS v, regexp_split_to_array(t, '{pattern}') AS s FROM d)""")
    least = "CASE k " + " ".join(f"WHEN {k} THEN {r.least}" for k, r in enumerate(secrets.RULES)) + " END"
    counts = ", ".join(f"count(*) FILTER (k = {k}) AS n_{r.kind}" for k, r in enumerate(secrets.RULES))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, NOT coalesce(bool_or(lang = 'en') OVER (PARTITION BY coalesce(text, '')), false) AS scanned_anew FROM documents),
e AS ({" UNION ALL ".join(each)}),
f AS (SELECT doc_id, k, kind, unnest(m) AS m, unnest(v) AS v, unnest(pos) AS pos FROM e),
g AS (SELECT doc_id, {counts}, string_agg(kind || ':' || pos || ':' || (pos + length(m)), ',' ORDER BY pos, k) AS spans FROM f WHERE length(v) >= {least} GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in secrets.RULES)}, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans, scanned_anew
FROM d LEFT JOIN g ON d.doc_id = g.doc_id
"""


_OP3 = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
s AS (SELECT doc_id, unnest(range(1, len(w) - 48)) AS i, w FROM d WHERE len(w) >= 50),
h AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM s),
f AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY h) AS least FROM h) WHERE least < doc_id),
c AS (SELECT doc_id, list_distinct(flatten(list(range(i, i + 50)))) AS gone FROM f GROUP BY doc_id),
k AS (SELECT d.doc_id, w, CASE WHEN gone IS NULL THEN w ELSE list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: NOT list_contains(gone, x[2])), lambda x: x[1]) END AS kept
      FROM d LEFT JOIN c ON d.doc_id = c.doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - len(kept) AS BIGINT) AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k
"""


_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP7 = rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t, {_WORDS} AS w, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
s AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' '))) AS g FROM d WHERE len(w) >= 8),
h AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM s),
c AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM h WHERE n > 1) GROUP BY doc_id),
b AS (SELECT d.doc_id, host, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
      FROM d LEFT JOIN c ON d.doc_id = c.doc_id),
l AS (SELECT doc_id, host, array_to_string(v, ' ') AS line, sum(len(v)) AS n
      FROM (SELECT doc_id, host, list_filter(regexp_split_to_array({_LOW.format("x")}, '[\x20\x09-\x0D]+'), lambda y: y <> '') AS v FROM (SELECT doc_id, host, unnest(lines) AS x FROM d))
      GROUP BY doc_id, host, line),
m AS (SELECT host, min(doc_id) AS doc_id FROM (SELECT host, doc_id, string_agg(line, chr(10) ORDER BY line) AS mark FROM l GROUP BY host, doc_id) GROUP BY host, mark),
o AS (SELECT l.host, line FROM l JOIN m ON l.doc_id = m.doc_id JOIN (SELECT host, count(*) AS n_host FROM m GROUP BY host) g ON l.host = g.host
      GROUP BY l.host, line, n_host HAVING count(*) > {quality.MIN_DOCS} AND count(*) > {quality.SHARE} * n_host),
g AS (SELECT doc_id, sum(n) AS n_boilerplate FROM l JOIN o ON l.host = o.host AND l.line = o.line GROUP BY doc_id)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEATED_PERCENT} * n_words) AS base_failed,
       (NOT (n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEATED_PERCENT} * n_words) AND n_words - coalesce(n_boilerplate, 0) >= {quality.KEEP} * n_words) AS kept,
       CAST(coalesce(n_boilerplate, 0) AS BIGINT) AS n_boilerplate
FROM b LEFT JOIN g ON b.doc_id = g.doc_id
"""


def _terms(text: str) -> str:
    lowered = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"list_filter(regexp_split_to_array({lowered}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"


_OP8 = f"""
WITH d AS (SELECT doc_id, {_terms("text")} AS w FROM documents),
i AS (SELECT item_id, w, least(13, len(w)) AS s FROM (SELECT item_id, {_terms("text")} AS w FROM benchmark) WHERE len(w) > 0),
iw AS (SELECT DISTINCT item_id, s, array_to_string(w[k:k + s - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - s + 2)) AS k FROM i)),
sizes AS (SELECT DISTINCT s FROM iw),
dw AS (SELECT doc_id, k, s, array_to_string(w[k:k + s - 1], ' ') AS g FROM (SELECT doc_id, w, s, unnest(range(1, len(w) - s + 2)) AS k FROM d, sizes WHERE len(w) >= s)),
m AS (SELECT doc_id, k, iw.s, item_id FROM dw JOIN iw ON dw.s = iw.s AND dw.g = iw.g),
h AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(k, k + s)) AS p FROM m) GROUP BY doc_id),
f AS (SELECT item_id, list_distinct(w[1:s]) AS v FROM i),
p AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS pos, unnest(w) AS t FROM d),
x AS (SELECT doc_id, item_id, pos, p.t, len(v) AS least FROM p JOIN (SELECT item_id, v, unnest(v) AS t FROM f) q ON p.t = q.t),
y AS (SELECT doc_id, item_id, pos, least FROM x WHERE (doc_id, item_id) IN (SELECT (doc_id, item_id) FROM x GROUP BY doc_id, item_id, least HAVING count(DISTINCT t) = least)),
z AS (SELECT DISTINCT y.doc_id, y.item_id FROM y JOIN x ON x.doc_id = y.doc_id AND x.item_id = y.item_id AND x.pos >= y.pos AND x.pos < y.pos + 26 GROUP BY y.doc_id, y.item_id, y.pos, y.least HAVING count(DISTINCT x.t) = y.least),
r AS (SELECT doc_id, count(*) AS n FROM z GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(t.n, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, (coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(w)) AS contaminated, coalesce(r.n, 0) AS n_near
FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN t ON d.doc_id = t.doc_id LEFT JOIN r ON d.doc_id = r.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_warc_index": _OP1, "op2_secret_ledger": _secret_sql(), "op3_substring_dedup": _OP3, "op7_quality": _OP7, "op8_decontamination": _OP8}
