"""The registered queries over whole small tables, against their SQL or a plain version."""

import os

import pyarrow.parquet as pq
import pytest

from quire.llm import queries

from . import brute, test_conversation_repair, test_prefix_trie
from .test_operators import rows_of

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="the supplied tables are not here")


@pytest.fixture(scope="module")
def documents():
    t = pq.read_table(f"{SMALL}/documents.parquet")
    return list(zip(t["doc_id"].to_pylist(), t["text"].to_pylist(), strict=True))


PLAIN = {"op2_secret_ledger": brute.secrets, "op3_substring_dedup": brute.substring, "op4_simhash": brute.simhash, "op10_suffix_dedup": brute.suffix}


@pytest.mark.parametrize("name", PLAIN)
def test_against_plain(spark, documents, name):
    found = queries.queries()[name](spark, SMALL).drop("scanned_anew")
    assert rows_of(found) == sorted(PLAIN[name](documents))


@pytest.mark.parametrize("name, plain, found", [("op12_conversation_repair", test_conversation_repair.plain, test_conversation_repair.found), ("op13_prefix_trie", test_prefix_trie.plain, test_prefix_trie.found)])
def test_conversations_against_plain(spark, name, plain, found):
    t = pq.read_table(f"{SMALL}/conversations.parquet", columns=["conv_id", "turn", "role", "text"])
    assert found(queries.queries()[name](spark, SMALL)) == plain([tuple(r.values()) for r in t.to_pylist()])


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_against_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    found = con.execute(queries.oracle_sql()[name])
    df = queries.queries()[name](spark, SMALL)
    order = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(order)
    assert sorted((tuple(r) for r in df.select(order).collect()), key=repr) == sorted(found.fetchall(), key=repr)
