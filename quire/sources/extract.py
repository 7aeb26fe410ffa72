"""Extraction of markdown from book files: an adapter for extractors that are not part of this engine.

``extract`` reads files with the binaryFile source and calls an extractor on the
executors, one file at a time; a failing file is a row with an error.
"""

from __future__ import annotations

import subprocess
import tempfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import newlines


@dataclass(frozen=True)
class ExtractionOptions:
    format: str = "markdown,json"
    image_output: str = "external"
    use_struct_tree: bool = False
    pages: str | None = None
    use_cli: bool = False
    hybrid: str | None = None
    sanitize: bool = False

    def arguments(self) -> dict[str, object]:
        """The options that are set, as keyword arguments of an extractor's API."""
        given = {"format": self.format, "image_output": self.image_output, "use_struct_tree": self.use_struct_tree, "sanitize": self.sanitize, "pages": self.pages, "hybrid": self.hybrid}
        return {k: v for k, v in given.items() if v is not None}


#: Bytes of a book file to its markdown.
Extractor = Callable[[bytes, ExtractionOptions], str]


def from_api(convert: Callable[..., str]) -> Extractor:
    """An extractor from a library's convert(bytes, **options)."""
    return lambda raw, options: convert(raw, **options.arguments())


def from_command(command: str) -> Extractor:
    """An extractor from a program that takes an input file and an output folder and leaves markdown there."""

    def run(raw: bytes, options: ExtractionOptions) -> str:
        with tempfile.TemporaryDirectory() as folder:  # of this task only
            source, out = Path(folder, "book.pdf"), Path(folder, "out")
            source.write_bytes(raw)
            words = [command, str(source), "--output-dir", str(out)]
            for name, value in options.arguments().items():
                words += [f"--{name.replace('_', '-')}"] * (value is not False) + ([] if isinstance(value, bool) else [str(value)])
            done = subprocess.run(words, capture_output=True, text=True)
            if done.returncode:
                raise RuntimeError(f"{command} failed with {done.returncode}: {done.stderr[-500:]}")
            return "\n".join(p.read_text(encoding="utf-8") for p in sorted(out.rglob("*.md")))

    return run


def input_paths(inputs: list[str], project: str | None) -> list[str]:
    """Given paths, else the project's book."""
    return list(inputs) or ([f"{project}/input/book.pdf"] if project else [])


def output_dir(given: str | None, project: str | None) -> str:
    return given or (f"{project}/source" if project else "projects/imported/source")


def metadata_file(names: list[str]) -> str:
    """extracted.json, else the first JSON file, else extracted.json to be."""
    found = sorted(n for n in names if n.endswith(".json"))
    return "extracted.json" if "extracted.json" in found or not found else found[0]


def extract(spark: SparkSession, paths: list[str], extractor: Extractor, options: ExtractionOptions = ExtractionOptions()) -> DataFrame:
    """(path, md, error) of every file."""

    def task(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for path, raw in zip(part["path"], part["content"], strict=True):
                try:
                    out.append((path, extractor(bytes(raw), options), None))
                except Exception as error:  # noqa: BLE001  a file's failure is data
                    out.append((path, None, str(error)))
            yield pd.DataFrame(out, columns=["path", "md", "error"], dtype=object)

    files = spark.read.format("binaryFile").load(paths).select("path", "content")
    return files.mapInPandas(task, "path string, md string, error string").withColumn("md", newlines(F.col("md")))
