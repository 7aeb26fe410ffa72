"""Commands on projects and on the tables that a run has left.

    python -m quire.plans.commands init   ROOT FILE...   metadata and state of new projects, below ROOT
    python -m quire.plans.commands list   ROOT           all projects with their stage
    python -m quire.plans.commands status ROOT BOOK      the stages of one project
    python -m quire.plans.commands chat   OUT            the next packet of each book of a run
    python -m quire.plans.commands review OUT            the quality reports of a run
    python -m quire.plans.commands publish OUT [ROOT]    OUT/pages/BOOK-LANGUAGE.html, with the metadata of the projects below ROOT
    python -m quire.plans.commands extract OUT FILE...   the books of markdown files, as OUT/books
    python -m quire.plans.commands STAGE OUT [PROVIDER]  one of normalize, split, chunk, translate, assemble on the tables that OUT has

--force replaces pages, --retry-failed asks a provider again for chunks that failed.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import glossary, publish, review, state, translate
from quire.plans.pipeline import Pipeline, Run
from quire.sources import books, projects


def stored(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Metadata and states of the projects below ``root``, a folder for each of the two, partitioned by project."""
    states = spark.read.schema(f"{books.STATE}, book_id STRING").json(f"{root}/state", multiLine=True)
    return books.read_metadata(spark, f"{root}/metadata"), states


def init(spark: SparkSession, root: str, files: list[str]) -> None:
    rows = spark.createDataFrame([(f, None, None) for f in files], "input_file string, title string, book_id string")
    for name, table in zip(("metadata", "state"), projects.create(rows), strict=True):
        text = table.select("book_id", F.to_json(F.struct("*"), {"pretty": "true"}).alias("value"))
        text.withColumn("project", F.col("book_id")).drop("book_id").write.mode("append").partitionBy("project").text(f"{root}/{name}")


def listing(spark: SparkSession, root: str) -> DataFrame:
    return state.project_table(state.list_projects(*stored(spark, root)))


def status(spark: SparkSession, root: str, book: str) -> DataFrame:
    metadata, states = stored(spark, root)
    rows = state.project_status(metadata.where(F.col("book_id") == book), states)
    return rows.select(F.format_string("%-10s %s", "stage", "status").alias("line"), "stage_pos").orderBy("stage_pos")


def chat(spark: SparkSession, out: str) -> DataFrame:
    chunks = translate.with_context(spark.read.parquet(f"{out}/translations"), ("book_id", "chapter_pos")).withColumn("chapter_title", F.col("chapter_id"))
    return translate.chat_packets(chunks, F.lit(glossary.NONE)).select(F.col("packet").alias("line"))


def reports(spark: SparkSession, out: str) -> DataFrame:
    return review.report(spark.read.parquet(f"{out}/issues"), spark.read.parquet(f"{out}/scores")).select(F.col("report").alias("line"))


def pages(spark: SparkSession, out: str, root: str | None = None, force: bool = False) -> DataFrame:
    chapters = spark.read.parquet(f"{out}/published")
    own = chapters.select("book_id").distinct()
    if root:
        metadata = own.join(books.read_metadata(spark, f"{root}/metadata"), "book_id", "left").select("book_id", "title", "author", "source_language", "target_language", "translator")
    else:
        metadata = own.select("book_id", F.col("book_id").alias("title"), F.lit("").alias("author"), F.lit("en").alias("source_language"), F.lit("ru").alias("target_language"), F.struct(F.lit("").alias("contact")).alias("translator"))
    made = publish.publish_page(chapters, metadata)
    publish.write_pages(made, f"{out}/pages", force)
    return made.select(F.concat_ws(" ", "file", "bytes", "warning").alias("line"))


#: Tables that a stage reads, by stage.
NEEDS = {"normalize": ("books",), "split": ("normalized",), "chunk": ("chapters",), "translate": ("chapters", "chunks"), "assemble": ("chapters", "translations")}


def one_stage(spark: SparkSession, out: str, name: str, provider: str, retry_failed: bool) -> list[str]:
    """The tables that one stage has written below ``out``."""
    tables = {t: spark.read.parquet(f"{out}/{t}") for t in NEEDS[name]}
    work = Pipeline(tables.get("books"), provider=None if provider == "chat" else provider, retry_failed=retry_failed, folder=out)
    done = work.stage(name, Run(dict(tables)))
    return [t for t in done.tables if t not in tables]


def extract(spark: SparkSession, out: str, files: list[str]) -> None:
    found = [books.read_markdown(spark, f) for f in files]
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    rows.select(F.regexp_extract("path", r"([^/]+)\.md$", 1).alias("book_id"), "md").write.mode("overwrite").parquet(f"{out}/books")


def main(argv: list[str] | None = None) -> int:
    """0: done; 2: wrong use."""
    from quire.session import session

    parser = argparse.ArgumentParser(prog="quire-projects")
    parser.add_argument("command", choices=("init", "list", "status", "chat", "review", "publish", "extract", *NEEDS))
    parser.add_argument("folder")
    parser.add_argument("names", nargs="*")
    parser.add_argument("--force", action="store_true")
    parser.add_argument("--retry-failed", action="store_true")
    try:
        args = parser.parse_args(argv)
        if (args.command in ("init", "extract") and not args.names) or (args.command == "status" and len(args.names) != 1):
            parser.error("a name is missing")
    except SystemExit as stop:
        return int(stop.code or 0)
    spark = session()
    if args.command == "init":
        init(spark, args.folder, args.names)
        return 0
    if args.command == "extract":
        extract(spark, args.folder, args.names)
        return 0
    if args.command in NEEDS:
        print("written: " + ", ".join(one_stage(spark, args.folder, args.command, args.names[0] if args.names else "echo", args.retry_failed)))
        return 0
    shown = {"list": listing, "chat": chat, "review": reports}
    if args.command == "publish":
        lines = pages(spark, args.folder, args.names[0] if args.names else None, args.force)
    else:
        lines = status(spark, args.folder, args.names[0]) if args.command == "status" else shown[args.command](spark, args.folder)
    for row in lines.toLocalIterator():
        print(row["line"])
    return 0


if __name__ == "__main__":
    sys.exit(main())
