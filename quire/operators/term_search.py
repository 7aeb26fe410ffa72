"""Many terms looked for in many texts in one pass over each: Aho-Corasick automata over shards of the terms.

Terms are dealt by hash to shards of about SHARD. Texts and shards meet
by (shard, lane), the shard first: a task builds the shard's automaton and lets the
texts of its lane stream past. A text is read once for each shard, so a glossary
of one shard costs one pass; neither the glossary nor a book's texts are gathered
anywhere. What a book uses is a bitmap for each shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Terms of a shard on average; a bitmap holds 32768, and a larger shard is an error of Spark's, not a loss.
SHARD = 16_384


def distinct_terms(glossary: DataFrame) -> DataFrame:
    """(english, russian) of the terms that can be checked: neither is empty or null."""
    return glossary.where((F.col("english") != "") & (F.col("russian") != "")).select("english", "russian").distinct()


def sharded(terms: DataFrame) -> DataFrame:
    """Adds shard, place within it, and n_shards."""
    size = terms.agg(F.greatest(F.ceil(F.count("*") / SHARD), F.lit(1)).cast("int").alias("n_shards"))
    dealt = terms.crossJoin(F.broadcast(size)).withColumn("shard", F.pmod(F.xxhash64("english", "russian"), "n_shards").cast("int"))  # one row
    return dealt.withColumn("place", F.row_number().over(Window.partitionBy("shard").orderBy("english", "russian")) - 1)


def _automaton(words: dict[str, list[int]]):
    import ahocorasick

    out = ahocorasick.Automaton()
    for word, places in words.items():
        out.add_word(word, places)
    if words:
        out.make_automaton()
    return out


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (shard, lane, terms, low, exact, owner), the shard's terms first: a term is used if either of its words occurs."""
    at, built = None, None
    for batch in batches:
        used: dict[tuple[int, int], set[int]] = {}
        terms, texts = batch.column(2), (batch.column(3), batch.column(4))
        for k, (shard, lane) in enumerate(zip(*(batch.column(c).to_pylist() for c in (0, 1)), strict=True)):
            if terms[k].is_valid:
                words: tuple[dict, dict] = ({}, {})
                for t in terms[k].as_py():
                    words[0].setdefault(t["low"], []).append(t["place"])
                    words[1].setdefault(t["exact"], []).append(t["place"])
                at, built = (shard, lane), [_automaton(w) for w in words]
                continue
            found = used.setdefault((shard, k), set())
            for automaton, column in zip(built if at == (shard, lane) else (), texts, strict=False):
                if text := column[k].as_py():  # one text at a time: a batch may hold 64 MB of them
                    for _, places in automaton.iter(text):
                        found.update(places)
        rows = [k for _, k in used]
        yield pa.record_batch([batch.column(5).take(pa.array(rows, pa.int64())), pa.array([s for s, _ in used], pa.int32()), pa.array([sorted(v) for v in used.values()], pa.list_(pa.int32()))], ["owner", "shard", "places"])


def used_terms(terms: DataFrame, texts: DataFrame, lanes: int) -> DataFrame:
    """(owner, shard, used): a bitmap of the sharded ``terms`` that occur in each owner's texts (owner, text); English in any case."""
    size = terms.agg(F.max("n_shards").alias("n_shards"))
    none = F.lit(None)
    lane = lambda n: F.greatest(F.lit(1), F.lit(lanes) / n).cast("int")
    kind, packed = texts.schema["owner"].dataType, "array<struct<place:int,low:string,exact:string>>"
    # A shard is one row, bounded by the bitmap; it goes to every lane.
    held = terms.groupBy("shard", "n_shards").agg(F.collect_list(F.struct("place", F.lower("english").alias("low"), F.col("russian").alias("exact"))).alias("terms"))
    side = held.select("shard", F.explode(F.sequence(F.lit(0), lane(F.col("n_shards")) - 1)).alias("lane"), "terms", none.cast("string").alias("low"), none.cast("string").alias("exact"), none.cast(kind).alias("owner"))
    each = texts.crossJoin(F.broadcast(size)).select(F.explode(F.sequence(F.lit(0), F.col("n_shards") - 1)).alias("shard"), F.pmod(F.xxhash64("text"), lane(F.col("n_shards"))).cast("int").alias("lane"), none.cast(packed).alias("terms"), F.lower("text").alias("low"), F.col("text").alias("exact"), "owner")  # one row
    met = side.unionByName(each).repartition("shard", "lane").sortWithinPartitions("shard", "lane", F.col("terms").isNull())
    found = met.mapInArrow(_scan, f"owner {texts.schema['owner'].dataType.simpleString()}, shard int, places array<int>")
    return found.select("owner", "shard", F.explode_outer("places").alias("place")).groupBy("owner", "shard").agg(F.bitmap_construct_agg(F.coalesce("place", F.lit(0))).alias("used"), F.bool_or(F.col("place") == 0).alias("first"))


def _has(bitmap: Column, first: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.when(place == 0, F.coalesce(first, F.lit(False))).otherwise(F.floor(byte / F.pow(F.lit(2), place % 8)) % 2 == 1)


def absent_terms(glossary: DataFrame, translated: DataFrame, lanes: int | None = None) -> DataFrame:
    """(book_id, english, russian): terms that a book's translation uses in neither language, English in any case.

    ``translated``: (book_id, content); null contents say nothing, a book of only
    such has no rows. The result itself has a row for each book and absent term.
    """
    lanes = lanes or int(translated.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    terms = sharded(distinct_terms(glossary))
    texts = translated.where(F.col("content").isNotNull()).select(F.col("book_id").alias("owner"), F.col("content").alias("text"))
    used = used_terms(terms, texts, lanes)
    both = used.join(terms, "shard")
    return both.where(~_has(F.col("used"), F.col("first"), F.col("place"))).select(F.col("owner").alias("book_id"), "english", "russian")
