"""Readers for book projects, and the book view of a table of documents.

A book is a row (book_id, md). Books are read as whole files and are the unit of
parallelism; operators on them are projections, so a corpus of many books needs
no shuffle until rows of different books meet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import newlines

METADATA = (
    "schema_version INT, book_id STRING, title STRING, author STRING, source_language STRING, target_language STRING, input_file STRING, "
    "translator STRUCT<contact: STRING>, chapters ARRAY<STRUCT<id: STRING, title: STRING, source_path: STRING, translated_path: STRING, status: STRING, word_count: INT, chunk_count: INT>>, "
    "created_at STRING, updated_at STRING"
)
STATE = "current_stage STRING, created_at STRING, updated_at STRING, stages MAP<STRING,STRING>"
CHUNK_META = (
    "chunk_id STRING, chapter_id STRING, sequence INT, char_count INT, status STRING, source_path STRING, translated_path STRING, "
    "created_at STRING, translated_at STRING, translation_mode STRING, error STRING"
)
RULES = "chapters ARRAY<STRUCT<id: STRING, title: STRING, start_pattern: STRING, end_pattern: STRING>>"


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    """(path, md) of every matching file, with universal newlines."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), newlines("value").alias("md"))


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METADATA).json(path, multiLine=True)


def read_states(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATE).json(path, multiLine=True)


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """(rule_pos, id, title, start_pattern, end_pattern) of a rules file."""
    return spark.read.schema(RULES).json(path, multiLine=True).select(F.posexplode("chapters").alias("rule_pos", "r")).select("rule_pos", "r.*")


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CHUNK_META).json(path, multiLine=True)


def chapter_rows(metadata: DataFrame) -> DataFrame:
    """One row per chapter element; the array's order is kept in chapter_pos."""
    return metadata.select("book_id", F.posexplode("chapters").alias("chapter_pos", "c")).select("book_id", (F.col("chapter_pos") + 1).alias("chapter_pos"), F.col("c.id").alias("chapter_id"), *(f"c.{k}" for k in ("title", "source_path", "translated_path", "status", "word_count", "chunk_count")))


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """(filename, path, content) of all files below a folder."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(F.element_at(F.split("path", "/"), -1).alias("filename"), "path", "content")


def image_listing(images: DataFrame) -> DataFrame:
    """One row: the sorted listing and its size."""
    return images.agg(F.sort_array(F.collect_list(F.struct("path", "filename"))).alias("images"), F.count("*").alias("image_count"))


#: A document's part of its book; rn counts the book's n documents. The same text in Spark and DuckDB.
PART = """concat('Running header ', source, chr(10),
  CASE WHEN rn = 1 THEN '# Foreword' WHEN rn = 2 THEN '# Acknowledgments' WHEN rn = n THEN '# Notes' WHEN rn = n - 1 THEN '# Appendix A'
       WHEN rn % 5 = 0 THEN concat('# Chapter ', CAST(rn AS STRING)) ELSE concat('## Section ', CAST(rn AS STRING)) END, chr(10),
  chr(10), replace(text, 'ation', concat('a-', chr(10), 'tion')),
  CASE WHEN rn % 4 = 1 THEN concat(chr(10), '- item ', CAST(rn AS STRING), chr(10), '  - nested ', CAST(rn AS STRING), chr(10), '- last ', CAST(rn AS STRING)) ELSE '' END,
  CASE WHEN rn % 6 = 2 THEN concat(chr(10), '> quote ', CAST(rn AS STRING)) ELSE '' END,
  CASE WHEN rn % 8 = 3 THEN concat(chr(10), '```', chr(10), 'code ', CAST(rn AS STRING), chr(10), '```') ELSE '' END,
  CASE WHEN rn % 9 = 4 THEN concat(chr(10), '![Figure ', CAST(rn AS STRING), '](images/f', CAST(rn AS STRING), '.png)') ELSE '' END,
  CASE WHEN rn % 10 = 5 THEN concat(chr(10), '**Рис. ', CAST(rn AS STRING), '. caption**') ELSE '' END,
  CASE WHEN rn % 11 = 6 THEN concat(chr(10), chr(10), chr(10), chr(10), chr(10)) ELSE '' END,
  chr(10), 'Page ', CAST(rn AS STRING), chr(10))"""


#: A book holds the documents of one source in a range of so many doc_ids, so its size does not grow with the table.
BOOK_IDS = 2000
#: A document's book. The same text in Spark and DuckDB.
BOOK = f"concat(source, '-', CAST(CAST(floor(doc_id / {BOOK_IDS}) AS BIGINT) AS VARCHAR(20)))"


def numbered(documents: DataFrame) -> DataFrame:
    """documents with book, the document's place rn in it, and the book's number n of documents."""
    from pyspark.sql import Window

    w = Window.partitionBy("book")
    return documents.withColumn("book", F.expr(BOOK)).withColumns({"rn": F.row_number().over(w.orderBy("doc_id")), "n": F.count("*").over(w)})


def book_view(documents: DataFrame) -> DataFrame:
    """(book_id, md): the documents of a book as parts in doc_id order."""
    parts = numbered(documents.select("source", "doc_id", "text")).select("book", "rn", F.expr(PART).alias("part"))
    return parts.groupBy(F.col("book").alias("book_id")).agg(F.expr("listagg(part, chr(10)) WITHIN GROUP (ORDER BY rn)").alias("md"))
