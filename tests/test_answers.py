"""Each request is answered once: replayed logs, retries, runs that are killed, and the pipeline's calls."""

import os
from collections import Counter
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from quire.plans import texts
from quire.plans.pipeline import Pipeline
from quire.streaming import answers as A

BOOK = "# One\n\nFirst text here.\n\n## Part\n\nMore text.\n\n# Two\n\nSecond text here.\n"


def failing(times):
    """A provider that fails as often as the prompt says."""

    def make():
        def ask(prompt, attempt):
            if attempt <= int(prompt.split("|")[0]):
                raise RuntimeError(f"attempt {attempt} failed")
            return prompt.upper()

        return ask

    return make


def log(spark, path, rows, tick=True):
    at = "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, second) AS at"
    spark.createDataFrame(rows, "key string, prompt string, second int").selectExpr("key", "prompt", at).repartition(3).write.mode("append").parquet(path)
    if tick:
        spark.createDataFrame([(A.TICK, "", 999_999)], "key string, prompt string, second int").selectExpr("key", "prompt", at).write.mode("append").parquet(path)


def test_replayed_log(spark, tmp_path):
    root = f"file://{tmp_path}"
    rows = [(f"k{n}", f"{n % 4}|t{n}", n) for n in range(12)]
    rows += [(f"k{n}", f"{n % 4}|later", n + 50) for n in range(6)]  # delivered again
    rows += [("blank", "  ", 3), ("none", None, 3)]
    log(spark, f"{root}/log", rows)
    A.start(spark, f"{root}/log", f"{root}/answers", f"{root}/checkpoint", failing(0), event_time=True, shards=2).awaitTermination()
    found = {r["key"]: r for r in A.read(spark, f"{root}/answers").collect()}
    assert len(found) == A.read(spark, f"{root}/answers").count() == 14
    for n in range(12):
        r, fails = found[f"k{n}"], n % 4
        assert (r["status"], r["attempts"]) == (("translated", fails + 1) if fails < 3 else ("error", 3))
        assert r["translation"] == (f"{fails}|T{n}" if fails < 3 else None)
        assert r["answered_ms"] == 1704067200000 + 1000 * (n + 2 ** min(fails, 2) - 1)
    assert found["blank"]["attempts"] == 0 and found["none"]["status"] == "error"
    # The log goes on: what is answered isn't asked for again.
    log(spark, f"{root}/log", [("k1", "0|t1", 400_000), ("new", "0|x", 999_999)], tick=False)
    A.start(spark, f"{root}/log", f"{root}/answers", f"{root}/checkpoint", failing(0), event_time=True, shards=2).awaitTermination()
    assert A.read(spark, f"{root}/answers").count() == 15


class Counting:
    """Notes its calls in a file; ends the process at the given call, once."""

    def __init__(self, path, die_at=None, fail=()):
        self.path, self.die_at, self.fail = path, die_at, fail

    def __call__(self):
        return self

    def translate(self, prompt):
        with open(self.path, "a") as out:
            out.write(f"{hash_of(prompt)}\n")
        if self.die_at and sum(1 for _ in open(self.path)) == self.die_at:
            os._exit(1)
        for text in self.fail:
            if text in prompt.partition("# Source\n")[2]:
                raise RuntimeError("refused")
        return f"RU {hash_of(prompt)}\n"


def hash_of(text):
    import zlib

    return zlib.crc32(text.encode())


def calls(path):
    return Counter(open(path).read().split())


def test_pipeline_calls_a_provider_once(spark, tmp_path):
    root, noted = f"file://{tmp_path}/out", str(tmp_path / "calls")
    books = spark.createDataFrame([("x", BOOK), ("y", BOOK.replace("text", "word"))], "book_id string, md string")
    run = Pipeline(books, provider=Counting(noted), folder=root).run()
    assert not run.stopped_at and sum(calls(noted).values()) == 4
    answered = {r[0]: r[1] for r in spark.read.parquet(f"{root}/translations").selectExpr("concat(book_id, chapter_id)", "translation").collect()}
    for name, text in (("assembled", "content"), ("published", "raw")):
        table = spark.read.parquet(f"{root}/{name}").withColumnRenamed("id", "chapter_id")
        assert {r[0]: r[1] for r in table.selectExpr("concat(book_id, chapter_id)", text).collect()} == answered
    again = Pipeline(books, provider=Counting(noted), folder=root).run()
    assert again.completed == run.completed and sum(calls(noted).values()) == 4


def test_killed_run_goes_on(spark, tmp_path):
    root, noted = f"file://{tmp_path}/answers", str(tmp_path / "calls")
    asked = spark.range(400).select(F.concat(F.lit("k"), "id").alias("key"), F.concat(F.lit("text "), "id").alias("prompt"))
    log_path = f"{root}/requests"
    asked.withColumn("at", F.current_timestamp()).repartition(40).write.parquet(log_path)
    with pytest.raises(Exception):
        A.answer_all(spark, asked, root, A.by_provider(Counting(noted, die_at=300)), shards=2)
    before = calls(noted)
    kept = {r["key"] for r in A.read(spark, f"{root}/answers").collect()}
    assert 0 < len(kept) < 400
    found = A.answer_all(spark, asked, root, A.by_provider(Counting(noted)), shards=2)
    assert found.count() == found.select("key").distinct().count() == 400
    after = calls(noted)
    assert all(after[str(hash_of(f"text {k[1:]}"))] == 1 for k in kept)  # what was committed isn't asked for again
    assert sum(before.values()) >= 300 and sum(after.values()) <= sum(before.values()) + 400 - len(kept)


def test_failed_ones_are_asked_for_again(spark, tmp_path):
    root, noted = f"file://{tmp_path}/out", str(tmp_path / "calls")
    books = spark.createDataFrame([("x", BOOK)], "book_id string, md string")
    policy = A.Policy(2, 200)
    run = Pipeline(books, provider=Counting(noted, fail=("Second",)), folder=root, policy=policy).run("translate")
    rows = {r["chapter_pos"]: r for r in run.tables["translations"].collect()}
    assert (rows[1]["status"], rows[2]["status"], rows[2]["error"]) == ("translated", "error", "refused")
    assert sum(calls(noted).values()) == 3
    Pipeline(books, provider=Counting(noted), folder=root, policy=policy).run("translate")
    assert sum(calls(noted).values()) == 3  # a failure is an answer, too
    run = Pipeline(books, provider=Counting(noted), folder=root, policy=policy, retry_failed=True).run("translate")
    assert sum(calls(noted).values()) == 4 and {r["status"] for r in run.tables["translations"].collect()} == {"translated"}


def test_state_has_a_partition_for_every_core(spark, monkeypatch):
    cluster = lambda cores: SimpleNamespace(sparkContext=SimpleNamespace(defaultParallelism=cores))
    assert [A.shards_for(cluster(n)) for n in (1, 3, 6, 8, 12, 100)] == [8, 9, 12, 8, 12, 100]
    started = {}
    monkeypatch.setattr(A, "shards_for", lambda _: 5)
    monkeypatch.setattr(A, "start", lambda *_, **options: started.update(options) or SimpleNamespace(awaitTermination=lambda: None))
    monkeypatch.setattr(A, "read", lambda *_: spark.createDataFrame([], A.ANSWER))
    texts.answered_once(spark, "/root/testdata/sf0.001")
    assert started["shards"] == 5
