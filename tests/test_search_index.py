"""Substring search by index against plain containment."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.operators import search_index as X


def test_packing():
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.integers(0, 1 << b, 200) for b in (3, 8, 15, 22, 31)])
    raw, size = X.pack(values)
    assert (X.unpack(raw.tobytes()) == values).all() and size.sum() == len(raw)


def sample(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abÉé日😀 \n", k=rng.randint(1, 5)))
    docs = [(k, word(), "".join(word() for _ in range(rng.randint(0, 12)))) for k in range(60)]
    docs += [(100, None, None), (101, "", ""), (102, "t", "aaaaaaaaaa"), (103, "x", "ab" * 5000), (None, "null id", "abab"), (5, "again", "of id 5 ab")]
    strings = [word() for _ in range(60)] + ["a", "ab", "É", "😀", "aaaa", "abababab", " A ", "", None, "title\nab", "zzz", "t\na", "d 5 AB"]
    return docs, list(enumerate(strings))


def plain(docs, queries):
    held = [(d, f"{t or ''}\n{r or ''}".lower()) for d, t, r in docs]
    return sorted({(q, d) for q, s in queries for d, t in held if (s or "").strip().lower() in t}, key=repr)


@pytest.mark.parametrize("segment", [1 << 19, 40])
def test_search(spark, tmp_path, monkeypatch, segment):
    docs, queries = sample(segment)
    indexed = X._indexed

    def small(batches):
        X.SEGMENT = segment
        return indexed(batches)

    monkeypatch.setattr(X, "_indexed", small)
    index = X.Index.build(spark.createDataFrame(docs, "doc_id long, title string, raw string").repartition(3), f"file://{tmp_path}/index")
    found = index.search(spark.createDataFrame(queries, "query_id long, text string"))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain(docs, queries)


def test_plan_reads_postings_only(spark, tmp_path):
    index = X.Index.build(spark.createDataFrame([(1, "a", "text")], "doc_id long, title string, raw string"), f"file://{tmp_path}/index")
    found = index.search(spark.createDataFrame([("q", "tex")], "query_id string, text string"))
    assert [tuple(r) for r in found.collect()] == [("q", 1)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "raw" not in plan and "PushedFilters: [IsNotNull(gram)" in plan


def test_empty(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, title string, raw string")
    index = X.Index.build(docs, f"file://{tmp_path}/index")
    assert index.search(spark.createDataFrame([(1, "ab"), (2, "")], "query_id long, text string")).count() == 0
    index = X.Index.build(spark.createDataFrame([(1, "a", "b")], "doc_id long, title string, raw string"), f"file://{tmp_path}/more")
    assert index.search(spark.createDataFrame([], "query_id long, text string")).count() == 0
    assert index.search(spark.range(1).select(F.lit(7).alias("query_id"), F.lit("A\nB").alias("text"))).collect()[0]["id"] == 1


def test_query_agrees_with_sql_on_odd_rows(spark, tmp_path):
    import duckdb
    import pyarrow as pa
    import pyarrow.parquet as pq

    import quire.plans.texts  # noqa: F401  adds its queries
    from quire.plans import catalogue

    texts = ["Straße und Gruß an alle", "STRAẞE", "strasse", "İstanbul", "istanbul ΟΔΟΣ", None, "straße", "straße"]
    rows = {
        "documents": pa.table({"doc_id": pa.array([1, 2, 3, 4, 5, 6, 7, 7], pa.int64()), "source": ["s", "s", "s", "s", "s", "s", None, "s"], "text": texts}),
        "part": pa.table({"p_partkey": pa.array([5, 6], pa.int64()), "p_name": ["gruß", None]}),
        "benchmark": pa.table({"item_id": pa.array([0, 1, 4, 9], pa.int64()), "text": ["x" * 19 + "ße ", "x" * 20 + "raße", "x" * 23 + "ΟΔΟΣ", None]}),
    }
    con = duckdb.connect()
    for name, table in rows.items():
        pq.write_table(table, tmp_path / f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'").fetchall()
    expected = con.execute(catalogue.ORACLES["search_index"]).fetchall()
    assert any("ẞ" in r[0] for r in expected)
    assert sorted(tuple(r) for r in catalogue.QUERIES["search_index"](spark, str(tmp_path)).collect()) == sorted(expected)
