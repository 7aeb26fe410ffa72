"""Lines of chunks: the map is that of normalisation, and the raw lines hold what the chunk says."""

import random
import re

from pyspark.sql import functions as F

from quire.operators import chapters as C
from quire.operators import chunking as H
from quire.operators import normalize as N
from quire.operators import positions as P

BOOK = "\n".join(
    ["Header", "# One", "", "First words are bro-", "ken here.", "Header", "Page 1", "", "", "", "", "", "More text fol-", "", "  lows.", "", "- item a", "  - inner", "- item b", "", "## Part", "Para-", "Header", "graph one.", "Page 2", "> quote", "```", "code", "```", "# Two", "", "Header", "Last ä-", "1b-", "c-", "d word."]
)


def random_book(rng):
    line = lambda: rng.choice(["Header", "Page 3", "", "", "a-", "b", "  c d", "- item", "1. x", "> q", "```", "# Head", "## Sub", "\ue000 odd", "word wo-", "- 7 -", "Other line"])
    return "\n".join(line() for _ in range(rng.randint(0, 60)))


def test_map_goes_with_normalisation(spark):
    rng = random.Random(3)
    rows = [(str(k), random_book(rng)) for k in range(120)] + [("x", BOOK), ("empty", "")]
    books = spark.createDataFrame(rows, "book_id string, md string")
    for config in (N.NormalizationConfig(), N.NormalizationConfig(remove_headers_footers=False), N.NormalizationConfig(join_hyphenated=False, remove_page_numbers=False)):
        want = {r["book_id"]: r["md"] for r in N.normalize(books, config).collect()}
        raw = dict(rows)
        for r in P.with_origin(books, config).collect():
            assert r["md"] == want[r["book_id"]].replace("\ue000", "\ufffd")
            out, own = r["md"].split("\n"), raw[r["book_id"]].replace("\ue000", "\ufffd").split("\n")
            assert len(out) == len(r["origin"]) and list(r["origin"]) == sorted(set(r["origin"])) or r["md"] == ""
            for text, k in zip(out, r["origin"], strict=True):
                if text and k:
                    assert text.startswith(own[k - 1].removesuffix("-"))


def test_chunks_have_the_lines_of_their_words(spark):
    rng = random.Random(4)
    long_list = "# L\n\n" + "\n".join(f"- entry {k} of the list" for k in range(40)) + "\n\n" + "tall paragraph " * 30
    rows = [("x", BOOK), ("list", long_list)] + [(f"r{k}", "# Top\n\n" + random_book(rng).replace("\ue000", "")) for k in range(30)]
    books = spark.createDataFrame(rows, "book_id string, md string")
    found = P.chunk_positions(books, max_chars=120)
    chunks = H.chunk(C.split_auto(N.normalize(books)), 120)
    keys = ["book_id", "chapter_pos", "chapter_id", "chunk_id", "sequence"]
    both = found.join(chunks, keys)
    assert both.count() == chunks.count() == found.count()
    texts = {(r["book_id"], r["chapter_pos"], r["chunk_id"]): r["excerpt"] for r in P.excerpts(books, found).collect()}
    for r in both.collect():
        excerpt = texts[r["book_id"], r["chapter_pos"], r["chunk_id"]]
        # The last line may go on, where its words were broken; all words up to there are the excerpt's.
        squeezed = re.sub(r"[\s-]", "", excerpt)
        assert re.sub(r"[\s-]", "", r["content"].strip().split("\n")[0])[:5] in squeezed
    one = found.where("book_id = 'x'").orderBy("chapter_pos", "sequence").collect()
    assert one[0]["raw_first"] == 2 and one[-1]["raw_last"] >= 33
    items = found.where("book_id = 'list'").orderBy("sequence").select("raw_first", "raw_last").collect()
    assert items[0]["raw_first"] == 1 and items[-1]["raw_last"] == 44 and all(a["raw_last"] < b["raw_first"] for a, b in zip(items[:8], items[1:9]))


def test_empty(spark):
    assert P.chunk_positions(spark.createDataFrame([], "book_id string, md string")).count() == 0
    assert P.chunk_positions(spark.createDataFrame([("a", ""), ("b", " \n ")], "book_id string, md string")).count() == 0
    assert P.chunk_positions(spark.createDataFrame([("a", "x")], "book_id string, md string")).select(F.col("raw_first"), F.col("raw_last")).collect() == [(1, 1)]
