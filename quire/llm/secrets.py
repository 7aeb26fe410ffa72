"""Secret scans with an incremental blob ledger, in DataFrame functions only.

Every version of a text is a blob, addressed by its SHA-256. The ledger holds
the findings of each (blob, rule version) that has been scanned. A scan anti-joins
the table's blobs with the ledger, scans one copy of each unseen blob, appends
the findings, and joins them back to all rows that hold the blob.

A rule's matches are leftmost and do not overlap. Their places follow from the
texts between them (``split``) and the matches (``regexp_extract_all``), which
use the same search. Spans count code points, the end exclusive.

The method adds no spans of its own: the ledger decides what is scanned, not how.
``scanned`` tells which rows' blobs this scan was the first to see.

Defined results: a null text is empty and has no spans; equal rows share a blob;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import saved, shared_dir, unshuffled


@dataclass(frozen=True)
class Rule:
    """``least`` is the smallest length of ``group`` in a match that counts."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: Letters of the keywords stand in either case, and no letter outside A-Z folds to them.
_KEYWORDS = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word) for word in ("password", "passwd", "secret", "token", "api_?key"))
RULES = (
    Rule("assign", rf"({_KEYWORDS})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    # A run of 16 is a match of the rule [0-9a-f]+ with 16 characters, and the other way round.
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
)
RULE_VERSION = "1"


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """array<struct<start, kind_order, end>> of one rule."""
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    before = F.transform(F.split(text, rule.pattern, -1), F.length)
    each = F.arrays_zip(F.slice(before, F.lit(1), F.size(whole)).alias("gap"), F.transform(whole, F.length).alias("size"), F.transform(value, F.length).alias("value"))
    kind = "struct<pos:int,found:array<struct<start:int,kind:int,end:int>>>"
    start = F.struct(F.lit(0).alias("pos"), F.array().cast("array<struct<start:int,kind:int,end:int>>").alias("found")).cast(kind)

    def step(seen: Column, x: Column) -> Column:
        at = seen["pos"] + x["gap"]
        span = F.struct(at.alias("start"), F.lit(order).alias("kind"), (at + x["size"]).alias("end"))
        return F.struct((at + x["size"]).alias("pos"), F.when(x["value"] >= rule.least, F.concat(seen["found"], F.array(span))).otherwise(seen["found"]).alias("found"))

    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return F.when(text.rlike(rule.pattern), F.aggregate(each, start, step, lambda x: x["found"])).otherwise(none)


def spans(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """All rules' spans by start, then by the rules' order."""
    return F.array_sort(F.concat(*(_spans(text, rule, k) for k, rule in enumerate(rules))))


LEDGER = "blob string, spans array<struct<start:int,kind:int,end:int>>, run string, rule_version string"


def _ledger(spark: SparkSession, path: str) -> DataFrame | None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
        return None
    return spark.read.schema(LEDGER).parquet(path)


def scan(documents: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES, rule_version: str = RULE_VERSION, id_column: str = "doc_id", text_column: str = "text", whole_rows: bool = False) -> DataFrame:
    """doc_id, blob, spans and scanned of every row; blobs that ``ledger`` does not have are scanned and added to it.

    With ``whole_rows`` all columns of documents come along in a struct ``row``.
    """
    spark, run, private = documents.sparkSession, uuid.uuid4().hex, ledger is None
    ledger = ledger or shared_dir(spark, "ledger")
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = documents.select(F.col(id_column).alias("doc_id"), F.sha2(text, 256).alias("blob"), *([F.struct(*documents.columns).alias("row")] if whole_rows else []))
    blobs = documents.select(F.sha2(text, 256).alias("blob"))
    unseen, known = documents.select(F.sha2(text, 256).alias("blob"), text.alias("text")), _ledger(spark, ledger)
    if known is not None:
        unseen = unseen.join(known.where(F.col("rule_version") == rule_version).select("blob"), "blob", "left_anti")
    single = unseen.groupBy("blob").agg(F.first("text").alias("text"))
    with unshuffled(spark):
        single.select("blob", spans(F.col("text"), rules).alias("spans"), F.lit(run).alias("run"), F.lit(rule_version).alias("rule_version")).write.mode("append").partitionBy("rule_version").parquet(ledger)
    known = _ledger(spark, ledger).where(F.col("rule_version") == rule_version)
    if not private:  # what earlier scans found in other tables stays where it is
        known = known.join(blobs.distinct(), "blob", "left_semi")
    # Two scans at a time may both have added a blob. Written, so that the join below can be split at a hot blob.
    found = saved(known.select("blob", "spans", (F.col("run") == run).alias("scanned")).dropDuplicates(["blob"]), shared_dir(spark, "findings"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return rows.join(found, "blob", "left").select(*rows.columns, F.coalesce("spans", none).alias("spans"), F.coalesce("scanned", F.lit(False)).alias("scanned"))


def named(found: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Spans as kind:start:end, comma-joined."""
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


def redacted(text: Column, found: Column, mark: str = "[SECRET]") -> Column:
    """The text with each run of overlapping spans replaced by ``mark``."""

    def step(seen: Column, s: Column) -> Column:
        apart = s["start"] >= seen["pos"]
        return F.struct(
            F.greatest(seen["pos"], s["end"]).alias("pos"),
            F.when(apart, F.concat(seen["out"], F.substring(text, seen["pos"] + 1, s["start"] - seen["pos"]), F.lit(mark))).otherwise(seen["out"]).alias("out"),
        )

    start = F.struct(F.lit(0).alias("pos"), F.lit("").alias("out"))
    return F.when(F.size(found) == 0, text).otherwise(F.aggregate(found, start, step, lambda x: F.concat(x["out"], F.substring(text, x["pos"] + 1, F.length(text)))))
