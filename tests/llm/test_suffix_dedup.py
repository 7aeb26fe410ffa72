"""Suffix-array dedup of near copies: blocks of one row meet in one shard and are one text there."""

import random

import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from quire.llm import suffix_dedup

from . import brute


def near_copies(seed, copies, words=1500, every=120):
    """Rows of one text in which each copy has words of its own here and there, and of parts of it."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgé", k=rng.randint(1, 9)))
    base = [word() for _ in range(words)]
    rows = [(k, " ".join(word() + "X" if rng.random() < 1 / every else w for w in base)) for k in range(copies)]
    part = base[200:420]
    return [*rows, (copies, " ".join([*part, word(), *part[:150]])), (copies + 1, " ".join(base[-300:])), (copies + 2, None)]


def test_blocks_of_a_row_are_one_text_in_their_shard(spark, tmp_path, monkeypatch):
    rows = near_copies(1, 3, 4000)
    monkeypatch.setattr(suffix_dedup, "shared_dir", lambda _, name: f"file://{tmp_path}/{name}")
    monkeypatch.setattr(suffix_dedup, "discard", lambda *_: None, raising=False)
    suffix_dedup.covered_ranges(spark.createDataFrame(rows, "doc_id long, text string"))
    texts = pq.read_table(tmp_path / "suffix" / "texts")
    given, sort = [], suffix_dedup.repeated_windows
    monkeypatch.setattr(suffix_dedup, "repeated_windows", lambda texts, *more: given.extend(map(len, texts)) or sort(texts, *more))
    for bunch in pc.unique(texts["bunch"]).to_pylist():
        suffix_dedup._sort_shard(400, False)(texts.filter(pc.equal(texts["bunch"], bunch)))
    assert 0 < sum(given) < 1.3 * sum(len((t or "").encode()) for _, t in rows)


def test_near_copies_against_plain(spark):
    for seed, copies in ((2, 2), (3, 6)):
        rows = near_copies(seed, copies, 700, 60)
        rows += [rows[0], (0, rows[1][1])]  # an equal row, and another text under a used id
        expected = sorted(brute.suffix(rows))
        frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        for options in ({}, {"shard_bytes": 3000}, {"hot": 4}):
            found = suffix_dedup.remove_repeated(frame, **options).withColumn("kept", F.sha2("kept", 256))
            assert sorted(map(tuple, found.collect())) == expected


def test_both_widths_take_one_suffix_array(spark, monkeypatch):
    """Texts are cut into blocks once, and the texts of a shard are sorted once, for both widths."""
    asked, real = [], suffix_dedup.covered_ranges
    monkeypatch.setattr(suffix_dedup, "covered_ranges", lambda *given, **options: asked.append(options) or real(*given, **options))
    rows = near_copies(4, 3, 700, 60)
    found = suffix_dedup.remove_repeated(spark.createDataFrame(rows, "doc_id long, text string")).withColumn("kept", F.sha2("kept", 256))
    assert sorted(map(tuple, found.collect())) == sorted(brute.suffix(rows))
    assert len(asked) == 1


def test_windows_of_two_widths_against_each_by_itself():
    rng = random.Random(8)
    texts = [(t or "").encode() for _, t in near_copies(5, 4, 500, 50)]
    owners = [rng.randrange(3) for _ in texts]
    both = suffix_dedup.repeated_of_widths(texts, [(288, owners), (400, None)])
    for found, (width, whose) in zip(both, ((288, owners), (400, None)), strict=True):
        assert [x.tolist() for x in found] == [x.tolist() for x in suffix_dedup.repeated_windows(texts, width, whose)]
    assert any(len(x) for x in both[1])
