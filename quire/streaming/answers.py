"""Requests to a provider, each answered once: claims, retries and answers as stateful streaming.

A request is a key with a prompt. Its claim - attempts so far, and whether it is
settled - is state of ``transformWithState``; a key that is claimed is not asked
for again, however often it is delivered. A failed attempt sets a timer, later
each time by a factor of two; after the last one the failure is the answer. Claims
and answers are committed with each micro-batch, so a run that is killed goes on
behind its last batch: at most the calls of one batch are made again, with the
same idempotency key for the service, and no answer is written twice, since a
batch writes a folder of its own.

Time is that of the machine, or, with ``event_time``, that of the requests: then a
log can be replayed, and timers run by its watermark. A null key or prompt, or a
blank prompt, is an error at once, without a call.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import UTC

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

REQUEST = "key string, prompt string, at timestamp"
ANSWER = "key string, translation string, status string, error string, attempts int, answered_ms long"
_CLAIM = "settled boolean, attempts int, prompt string"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: The key of rows that only move the time of a replayed log.
TICK = "\x00tick"


@dataclass(frozen=True)
class Policy:
    """Attempts in all, and the wait in ms behind the first failure; it doubles with each."""

    attempts: int = 3
    wait_ms: int = 1000

    def wait(self, failed: int) -> int:
        return self.wait_ms << (failed - 1)


class Asking(StatefulProcessor):
    """One key's claim. ``ask`` makes a function (prompt, attempt) -> text on the executor."""

    def __init__(self, ask: Callable[[], Callable[[str, int], str]], policy: Policy, event_time: bool):
        self.make, self.policy, self.event_time = ask, policy, event_time

    def init(self, handle) -> None:
        self.handle, self.claim, self.ask = handle, handle.getValueState("claim", _CLAIM), None

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        first = None
        for row in rows:  # whichever delivery comes first by time, then by prompt
            if first is None or (row["at"], row["prompt"] or "") < (first["at"], first["prompt"] or ""):
                first = row
        if key[0] == TICK or first is None or self.claim.exists():
            return
        at = int(first["at"].replace(tzinfo=first["at"].tzinfo or UTC).timestamp() * 1000) if self.event_time else timerValues.getCurrentProcessingTimeInMs()
        yield from self._try(key, first["prompt"], 0, at, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        settled, attempts, prompt = self.claim.get()
        if not settled:
            yield from self._try(key, prompt, attempts, expiredTimerInfo.getExpiryTimeInMs(), timerValues)

    def _try(self, key, prompt: str | None, attempts: int, at: int, timers) -> Iterator[Row]:
        """Attempts from ``at`` on, until one succeeds, none is left, or the next has to wait."""
        if key[0] is None or prompt is None or not prompt.strip():
            yield self._settle(key, None, "error", "the request has no key or no prompt", 0, at)
            return
        if self.ask is None:
            self.ask = self.make()
        while True:
            attempts += 1
            try:
                text = self.ask(prompt, attempts)
            except Exception as error:  # noqa: BLE001  a failing request is data
                if attempts >= self.policy.attempts:
                    yield self._settle(key, None, "error", str(error), attempts, at)
                    return
                at += self.policy.wait(attempts)
                now = timers.getCurrentWatermarkInMs() if self.event_time else timers.getCurrentProcessingTimeInMs()
                if at > now:
                    self.claim.update((False, attempts, prompt))
                    self.handle.registerTimer(at)
                    return
            else:
                yield self._settle(key, text, "translated", None, attempts, at)
                return

    def _settle(self, key, text: str | None, status: str, error: str | None, attempts: int, at: int) -> Row:
        self.claim.update((True, attempts, None))  # the prompt isn't needed any more
        return Row(key=key[0], translation=text, status=status, error=error, attempts=attempts, answered_ms=at)

    def close(self) -> None:
        pass


def by_provider(provider: Callable[[], object]) -> Callable[[], Callable[[str, int], str]]:
    """``ask`` for a provider (``operators.translate``), made once a task."""

    def make() -> Callable[[str, int], str]:
        service = provider()
        return lambda prompt, attempt: service.translate(prompt)

    return make


def start(spark: SparkSession, requests: str, answers: str, checkpoint: str, ask: Callable[[], Callable[[str, int], str]], policy: Policy = Policy(), event_time: bool = False, lateness: str = "2 hours", files: int = 16, shards: int | None = None) -> StreamingQuery:
    """Answer the requests (Parquet files of REQUEST) below ``requests``; ``answers`` gets a folder for each batch.

    A replayed log (``event_time``) ends with what has come so far; otherwise the
    query runs on, since retries may be due at any time. ``shards``: state partitions, fixed by the first start; by default spark.sql.shuffle.partitions.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    own.conf.set("spark.sql.session.timeZone", "UTC")
    # The stores of an executor share one bounded cache and write buffer.
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true")
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB", "256")
    # What a batch changes is written, not the whole state each time.
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    own.conf.set("spark.sql.streaming.stateStore.compression.codec", "zstd")
    if shards:
        own.conf.set("spark.sql.shuffle.partitions", shards)
    stream = own.readStream.schema(REQUEST).option("maxFilesPerTrigger", files).parquet(requests)
    if event_time:
        stream = stream.withWatermark("at", lateness)
    asked = stream.groupBy("key").transformWithState(Asking(ask, policy, event_time), ANSWER, "append", "eventTime" if event_time else "processingTime")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").option("compression", "zstd").parquet(f"{answers}/batch={batch_id}")

    when = {"availableNow": True} if event_time else {"processingTime": f"{max(500, policy.wait_ms // 2)} milliseconds"}
    return asked.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("append").trigger(**when).start()


def shards_for(spark: SparkSession, least: int = 8) -> int:
    """State partitions that keep all cores of the cluster busy to the end of a batch: a multiple of them, ``least`` at the fewest."""
    cores = spark.sparkContext.defaultParallelism
    return -(-least // cores) * cores


def read(spark: SparkSession, answers: str) -> DataFrame:
    """The answers so far."""
    return spark.read.schema(f"{ANSWER}, batch int").parquet(answers).drop("batch")


def answer_all(spark: SparkSession, requests: DataFrame, folder: str, ask: Callable[[], Callable[[str, int], str]], policy: Policy = Policy(), shards: int | None = None) -> DataFrame:
    """Answers of all ``requests`` (key, prompt), and of those of earlier runs with the same ``folder``.

    A key that was asked for before keeps its first prompt and its answer; new ones are appended to the log.
    """
    log, answers = f"{folder}/requests", f"{folder}/answers"
    new = requests.select("key", "prompt", F.current_timestamp().alias("at"))
    if there(spark, log):
        new = new.join(spark.read.schema(REQUEST).parquet(log).select("key"), "key", "left_anti")
    new.write.mode("append").option("maxRecordsPerFile", 64).parquet(log)
    wanted = spark.read.schema(REQUEST).parquet(log).select("key").distinct().count()
    done = lambda: there(spark, answers) and read(spark, answers).count() >= wanted
    if wanted and not done():
        query = start(spark, log, answers, f"{folder}/checkpoint", ask, policy, shards=shards)
        while not done() and not query.awaitTermination(0.5):
            pass
        while query.isActive and query.status["isTriggerActive"]:  # stopped between batches, not within one
            time.sleep(0.02)
        query.stop()
        if query.exception() and not done():
            raise query.exception()
    return read(spark, answers) if wanted else spark.createDataFrame([], ANSWER)


def there(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)
