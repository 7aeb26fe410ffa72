"""Incremental translation over a folder of new chunks: an extension, for resuming without rescans.

Each micro-batch holds chunk files that have not been seen; eligible ones are
translated and appended as events. The stream's checkpoint records what is done,
and an event's key makes a replayed batch harmless: the latest event counts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quire.operators import translate

CHUNK = "book_id string, chapter_id string, chunk_id string, sequence int, content string, status string, translation string"


def translate_stream(spark: SparkSession, source: str, events: str, checkpoint: str, run: Callable[[DataFrame], DataFrame] | None = None, available_now: bool = True) -> StreamingQuery:
    """Events (book_id, chapter_id, chunk_id, translation, status, error, at) for the chunks that appear below ``source``."""

    def echo(batch: DataFrame) -> DataFrame:
        return batch.select("book_id", "chapter_id", "chunk_id", translate.echo(F.col("content")).alias("translation"), F.lit("translated").alias("status"), F.lit(None).cast("string").alias("error"))

    work = run or echo

    def append(batch: DataFrame, batch_id: int) -> None:
        open_ = batch.where(translate.should_translate(F.col("status"), F.col("translation")))
        work(open_).withColumns({"at": F.current_timestamp(), "batch": F.lit(batch_id)}).write.mode("overwrite").parquet(f"{events}/batch={batch_id}")

    stream = spark.readStream.schema(CHUNK).json(source).writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    return (stream.trigger(availableNow=True) if available_now else stream).start()
