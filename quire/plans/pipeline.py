"""The stages over many books, and a thin command line.

Without a folder they are one lazy graph, and nothing runs until a result is
written. With one, as on the command line, every stage's table is written once and
the next stage reads it; a provider's answers are kept there as they come, so a
run that was stopped goes on with them.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import assemble, chapters, chunking, glossary, normalize, publish, review, state, translate
from quire.streaming import answers


@dataclass
class Run:
    """Tables of the stages that have been planned."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    completed: list[str] = field(default_factory=list)
    stopped_at: str | None = None


class Pipeline:
    """books (book_id, md) to published chapters.

    ``provider``: a provider's name, or None for chat mode, which stops at the
    first chunk that has no translation. ``translations`` (book_id, chapter_pos,
    chunk_id, translation, status, error) is what earlier runs have saved; its
    chunks are not translated again. ``folder``: where the tables are written, and
    the answers of earlier runs with this folder are found; failed ones are asked
    for again with ``retry_failed``.
    """

    def __init__(self, books: DataFrame, terms: DataFrame | None = None, provider: str | Callable[[], translate.Provider] | None = "echo", max_chars: int = chunking.MAX_CHARS, rules: list[chapters.ChapterRule] | None = None, translations: DataFrame | None = None, retry_failed: bool = False, folder: str | None = None, policy: answers.Policy = answers.Policy()):
        self.books, self.terms, self.provider, self.max_chars, self.rules = books, terms, provider, max_chars, rules
        self.translations, self.retry_failed, self.folder, self.policy = translations, retry_failed, folder, policy

    def run(self, until: str = "publish") -> Run:
        out = Run()
        for stage in state.stages_until(until):
            self.stage(stage, out)
            if out.stopped_at:
                break
        return out

    def stage(self, name: str, out: Run) -> Run:
        """One stage on the tables that ``out`` has."""
        known = dict(out.tables)
        getattr(self, f"_{name}")(out)
        if self.folder:
            for table in [n for n in out.tables if out.tables[n] is not known.get(n)]:
                out.tables[table] = checkpoint(out.tables[table], f"{self.folder}/{table}")
        if not out.stopped_at:
            out.completed.append(name)
        return out

    def _extract(self, out: Run) -> None:
        out.tables["books"] = self.books

    def _normalize(self, out: Run) -> None:
        out.tables["normalized"] = normalize.normalize(out.tables["books"])

    def _split(self, out: Run) -> None:
        books = out.tables["normalized"]
        if not self.rules:
            out.tables["chapters"] = chapters.split_auto(books)
            return
        found = chapters.split_manual(books, self.rules)
        out.tables["chapters"] = found.where("problem is null").drop("problem")
        out.tables["rule_problems"] = found.where("problem is not null").select("book_id", "chapter_pos", "chapter_id", "problem")

    def _chunk(self, out: Run) -> None:
        out.tables["chunks"] = chunking.chunk(out.tables["chapters"], self.max_chars)

    def _translate(self, out: Run) -> None:
        keys = ["book_id", "chapter_pos", "chunk_id"]
        none = {c: F.lit(None).cast("string") for c in ("translation", "error")}
        chunks = out.tables["chunks"].withColumns(none)
        if self.translations is not None:
            chunks = translate.apply_updates(chunks, self.translations, keys)
        open_ = translate.should_translate(F.col("status"), F.col("translation"), retry_failed=self.retry_failed)
        if self.provider is None:
            out.tables["translations"] = chunks
            if not chunks.where(open_).limit(1).isEmpty():
                out.stopped_at = "translate"
            return
        # Context comes from all chunks; the filter stands between the windows and the provider.
        context = translate.with_title(translate.with_context(chunks, ("book_id", "chapter_pos")), out.tables["chapters"]).where(open_)
        if self.provider == "echo":
            done = context.select(*keys, translate.echo(F.col("content")).alias("translation"), F.lit("translated").alias("status"), F.lit(None).cast("string").alias("error"))
        else:
            held, make = self._glossary_text(), self.provider if callable(self.provider) else translate.provider_maker(self.provider)
            asked = context.select(*keys, translate.prompt(F.lit(held), F.col("chapter_title"), F.col("previous_summary"), F.col("next_summary"), F.col("content")).alias("prompt"))
            done = self._answered(asked, keys, make) if self.folder else translate.translate(asked, make)
        out.tables["translations"] = translate.apply_updates(chunks, done, keys)

    def _answered(self, asked: DataFrame, keys: list[str], make: Callable[[], translate.Provider]) -> DataFrame:
        """(keys, translation, status, error) of every request, each answered once; a failed one has a number for each run that asks again."""
        spark, folder = asked.sparkSession, f"{self.folder}/answers"
        asked = asked.withColumn("base", F.concat_ws("/", *keys)).withColumn("key", F.concat("base", F.lit("#0")))
        if self.retry_failed and answers.there(spark, f"{folder}/answers"):
            tried = answers.read(spark, f"{folder}/answers").groupBy(F.substring_index("key", "#", 1).alias("base")).agg(F.count("*").alias("n"), F.bool_or(F.col("status") == "translated").alias("fine"))
            asked = asked.join(tried, "base", "left").withColumn("key", F.when(~F.col("fine"), F.concat("base", F.lit("#"), "n")).otherwise(F.col("key")))
        found = answers.answer_all(spark, asked, folder, answers.by_provider(make), self.policy)
        last = found.groupBy(F.substring_index("key", "#", 1).alias("base")).agg(F.max_by(F.struct("translation", "status", "error"), F.substring_index("key", "#", -1).cast("int")).alias("a"))
        return asked.select(*keys, "base").join(last, "base").select(*keys, "a.*")

    def _glossary_text(self) -> str:
        return glossary.prompt_text(self.terms).first()[0] if self.terms is not None else glossary.NONE

    def _assemble(self, out: Run) -> None:
        out.tables["assembled"] = assemble.assemble(out.tables["translations"], ("book_id", "chapter_pos", "chapter_id"))

    def _review(self, out: Run) -> None:
        terms = self.terms if self.terms is not None else self.books.sparkSession.createDataFrame([], "english string, russian string")
        issues = review.review(out.tables["chapters"], out.tables["assembled"], out.tables["translations"], terms)
        out.tables["issues"] = issues
        out.tables["scores"] = review.score(issues, out.tables["books"])

    def _publish(self, out: Run) -> None:
        titles = out.tables["chapters"].select("book_id", "chapter_pos", "title")
        out.tables["published"] = publish.published(out.tables["assembled"].join(titles, ["book_id", "chapter_pos"]), strict=False)


def checkpoint(table: DataFrame, path: str) -> DataFrame:
    """Write a stage's table and go on from what was written."""
    table.write.mode("overwrite").parquet(path)
    return table.sparkSession.read.parquet(path)


def main(argv: list[str] | None = None) -> int:
    """0: done; 1: some chunks or chapters failed; 2: wrong use."""
    from quire.session import session
    from quire.sources.books import read_markdown

    parser = argparse.ArgumentParser(prog="quire")
    parser.add_argument("input", help="markdown files, one per book")
    parser.add_argument("output", help="folder for the stages' tables")
    parser.add_argument("--until", default="publish", choices=state.RUNNABLE)
    parser.add_argument("--provider", default="echo", choices=[*translate.PROVIDERS, "chat"])
    parser.add_argument("--retry-failed", action="store_true", help="ask again for chunks that failed in an earlier run")
    parser.add_argument("--max-chars", type=int, default=chunking.MAX_CHARS)
    try:
        args = parser.parse_args(argv)
    except SystemExit as stop:
        return int(stop.code or 0)
    spark: SparkSession = session()
    books = read_markdown(spark, args.input).select(F.regexp_extract("path", r"([^/]+)\.md$", 1).alias("book_id"), "md")
    run = Pipeline(books, provider=None if args.provider == "chat" else args.provider, max_chars=args.max_chars, retry_failed=args.retry_failed, folder=args.output).run(args.until)
    failed = 0
    if "assembled" in run.tables:
        failed = spark.read.parquet(f"{args.output}/assembled").where("not success").limit(1).count()
    print(f"completed: {', '.join(run.completed)}" + (f"; stopped at {run.stopped_at}" if run.stopped_at else ""))
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
