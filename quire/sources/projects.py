"""Projects as rows: creation, versioned writes, export as JSON, reports."""

from __future__ import annotations

import re
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import slugify
from quire.operators.state import initial_stages

LANGUAGE = re.compile("[a-z]{2}")
SCHEMA_VERSION = 1


def now_iso() -> str:
    return datetime.now(UTC).replace(microsecond=0).isoformat()


def create(books: DataFrame, source_language: str = "en", target_language: str = "ru", author: str = "", contact: str = "") -> tuple[DataFrame, DataFrame]:
    """Metadata and state rows for (input_file, title, book_id); a missing title is the file's stem, a missing id its slug."""
    for language in (source_language, target_language):
        if not LANGUAGE.fullmatch(language):
            raise ValueError(f"{language!r} is not a two-letter language code")
    stem = F.regexp_replace(F.element_at(F.split("input_file", "/"), -1), r"\.[^.]*$", "")
    named = books.withColumn("title", F.coalesce("title", stem)).withColumn("book_id", F.coalesce("book_id", slugify("title")))
    chapter = "array<struct<id:string,title:string,source_path:string,translated_path:string,status:string,word_count:int,chunk_count:int>>"
    metadata = named.select(
        F.lit(SCHEMA_VERSION).alias("schema_version"), "book_id", "title", F.lit(author).alias("author"), F.lit(source_language).alias("source_language"), F.lit(target_language).alias("target_language"), "input_file",
        F.struct(F.lit(contact).alias("contact")).alias("translator"), F.array().cast(chapter).alias("chapters"),
    )
    return metadata, named.select("book_id", F.lit("extract").alias("current_stage"), initial_stages().alias("stages"))


def write_version(table: DataFrame, path: str, version: str | None = None) -> str:
    """Write a table beside its earlier versions, which stay as backups."""
    target = f"{path}/v={version or datetime.now(UTC).strftime('%Y%m%dT%H%M%S%f')}"
    table.write.mode("errorifexists").parquet(target)
    return target


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of a table."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(target)
    versions = sorted(s.getPath().getName() for s in found if s.getPath().getName().startswith("v="))
    if not versions:
        raise ValueError(f"{path} has no version")
    return spark.read.parquet(f"{path}/{versions[-1]}")


def export_json(metadata: DataFrame) -> DataFrame:
    """(book_id, json): one pretty document per project."""
    return metadata.select("book_id", F.to_json(F.struct("*"), {"pretty": "true"}).alias("json"))


def validated_chunks(chunks: DataFrame) -> DataFrame:
    """Chunks in translation order; a bad sequence, a missing chapter or a missing source fails the job."""
    bad = F.when(F.coalesce("chapter_id", F.lit("")) == "", "no chapter").when(F.col("sequence").isNull() | (F.col("sequence") < 1), "a bad sequence").when(F.col("content").isNull(), "no source text")
    said = F.raise_error(F.concat(F.lit("chunk "), F.coalesce("chunk_id", F.lit("?")), F.lit(" has "), bad))
    return chunks.withColumn("sequence", F.when(bad.isNotNull(), said.cast("int")).otherwise(F.col("sequence"))).orderBy("chapter_id", "sequence")


def read_all_translated(chapters: DataFrame) -> DataFrame:
    """(book_id, text): a book's translated chapters in metadata order."""
    there = chapters.where(F.col("content").isNotNull())
    return there.groupBy("book_id").agg(F.expr("listagg(content, chr(10)) WITHIN GROUP (ORDER BY chapter_pos)").alias("text"))


def terminology_report(merged: DataFrame, conflicts: DataFrame) -> DataFrame:
    """One row: entries and conflicts as markdown."""
    count = merged.agg(F.count("*").alias("n"))
    lines = conflicts.agg(F.array_join(F.array_sort(F.collect_list(F.concat(F.lit("- "), "conflict"))), "\n").alias("lines"))
    return count.crossJoin(lines).select(F.format_string("# Terminology report\n\nTerms: %d\n\n## Conflicts\n\n%s\n", "n", F.when(F.col("lines") == "", "None.").otherwise(F.col("lines"))).alias("report"))
