import json
import sys

import pytest
from pyspark.sql import functions as F

from quire.operators import glossary as G
from quire.sources import extract as X
from quire.sources import projects as PR


def test_extraction(spark, tmp_path):
    for name, raw in (("a.pdf", b"one\r\ntwo"), ("b.pdf", b"bad")):
        (tmp_path / name).write_bytes(raw)

    def convert(raw, options):
        if raw == b"bad":
            raise ValueError("unreadable")
        return raw.decode() + options.format

    rows = {r["path"][-5:]: (r["md"], r["error"]) for r in X.extract(spark, [f"file://{tmp_path}/*.pdf"], convert).collect()}
    assert rows == {"a.pdf": ("one\ntwomarkdown,json", None), "b.pdf": (None, "unreadable")}


def test_extraction_by_program(tmp_path):
    program = tmp_path / "tool"
    program.write_text(f"#!{sys.executable}\nimport sys, pathlib\nout = pathlib.Path(sys.argv[3])\nout.mkdir()\n(out / 'x.md').write_text(' '.join(sys.argv[4:]))\nsys.exit(open(sys.argv[1]).read() == 'no')\n")
    program.chmod(0o755)
    run = X.from_command(str(program))
    assert run(b"yes", X.ExtractionOptions(pages="1-3")) == "--format markdown,json --image-output external --pages 1-3"
    with pytest.raises(RuntimeError):
        run(b"no", X.ExtractionOptions())
    assert X.from_api(lambda raw, **o: str(sorted(o)))(b"", X.ExtractionOptions()) == "['format', 'image_output', 'sanitize', 'use_struct_tree']"


def test_paths():
    assert X.input_paths([], "p") == ["p/input/book.pdf"] and X.input_paths(["a"], "p") == ["a"] and X.input_paths([], None) == []
    assert X.output_dir(None, None) == "projects/imported/source" and X.output_dir(None, "p") == "p/source" and X.output_dir("o", "p") == "o"
    assert X.metadata_file([]) == "extracted.json" and X.metadata_file(["z.json", "b.json"]) == "b.json" and X.metadata_file(["a.json", "extracted.json"]) == "extracted.json"


def test_projects(spark, tmp_path):
    books = spark.createDataFrame([("in/My Book.pdf", None, None), ("x.pdf", "T", "own")], "input_file string, title string, book_id string")
    metadata, states = PR.create(books)
    assert {r["book_id"]: r["title"] for r in metadata.collect()} == {"my-book": "My Book", "own": "T"}
    assert states.where("current_stage = 'extract' and stages['init'] = 'done'").count() == 2
    with pytest.raises(ValueError):
        PR.create(books, "eng")
    path = f"file://{tmp_path}/meta"
    PR.write_version(metadata, path, "1")
    PR.write_version(metadata.limit(1), path, "2")
    assert PR.read_latest(spark, path).count() == 1 and spark.read.parquet(f"{path}/v=1").count() == 2
    assert json.loads(PR.export_json(metadata).where("book_id = 'own'").first()["json"])["target_language"] == "ru"


def test_validated_chunks(spark):
    schema = "chunk_id string, chapter_id string, sequence int, content string"
    good = spark.createDataFrame([("b", "02", 1, "x"), ("a", "01", 2, "x"), ("c", "01", 10, "x")], schema)
    assert [r["chunk_id"] for r in PR.validated_chunks(good).collect()] == ["a", "c", "b"]
    for row in (("a", "", 1, "x"), ("a", "01", None, "x"), ("a", "01", 0, "x"), ("a", "01", 1, None)):
        with pytest.raises(Exception, match="chunk a has"):
            PR.validated_chunks(spark.createDataFrame([row], schema)).collect()


def test_reports(spark):
    rows = spark.createDataFrame([("b", 2, "two"), ("b", 1, "one"), ("b", 3, None)], "book_id string, chapter_pos int, content string")
    assert PR.read_all_translated(rows).first()["text"] == "one\ntwo"
    terms = spark.createDataFrame([(0, "a", "x", "")], "pos int, english string, russian string, notes string")
    own = terms.withColumn("russian", F.lit("y"))
    report = PR.terminology_report(G.merge(terms, own), G.conflicts(terms, own)).first()["report"]
    assert "Terms: 1" in report and "- a: root='x' project='y'" in report
    assert "None." in PR.terminology_report(G.merge(terms, terms), G.conflicts(terms, terms)).first()["report"]
