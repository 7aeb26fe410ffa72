"""A training-data pipeline over ``documents``: five stages, each written and read again by the next.

Rows with a null doc_id are dropped by the first stage. Unlike rows that share a
doc_id are judged each by its own text; near_dedup keeps both if that doc_id is
the smallest of its group.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import bpe, decontamination, quality, secrets, simhash
from quire.llm._common import row_hash, saved, shared_dir
from quire.llm.queries import tokenizer


def _with_text(rows: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like``, n_chars after the text as it is now."""
    columns = dict(like.dtypes)
    if "n_chars" in columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(columns["n_chars"]))
    return rows.select(like.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; kept ones lose their lines over the limit."""
    return quality.without_boilerplate(docs, quality.quality(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents (SimHash of five-word shingles, similarity 0.8) the one with the smallest doc_id stays."""
    kept = simhash.similar_documents(docs).where("doc_id = component_id").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi").select(docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    found = decontamination.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    gone = found.where("contaminated").select(F.col("doc_id").alias("gone_id"), F.col("row").alias("gone_row")).distinct()
    return docs.join(gone, (docs["doc_id"] == gone["gone_id"]) & (row_hash() == gone["gone_row"]), "left_anti")


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text."""
    found = secrets.scan(docs, whole_rows=True)
    some = F.size("spans") > 0
    text = F.when(some, secrets.redacted(F.col("row.text"), F.col("spans"))).otherwise(F.col("row.text"))
    return _with_text(found.select("row.*", text.alias("clean")).withColumn("text", F.col("clean")), docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the decoded text."""
    return bpe.encode_decode(docs, tokenizer("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("encoding", encoding),
]

#: SQL has neither XXH64 nor this tokenizer; the tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of ``sf_dir``."""
    docs, work = spark.read.parquet(f"{sf_dir}/documents.parquet"), shared_dir(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = saved(docs, f"{work}/{name}")
    return docs
