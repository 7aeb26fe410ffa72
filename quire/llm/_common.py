"""What the operators share: the shared folder, written intermediate tables, Arrow batches."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text handled by one numpy pass.
BATCH_BYTES = 1 << 20


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below spark.checkpoint.dir, which driver and executors share.

    Where the setting is absent, a local session, as in tests, gets a folder of
    this machine; on a cluster that would not be shared, so it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        root = "/tmp/checkpoints/quire"
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def unshuffled(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the jobs within go when the job has ended; for jobs whose result is written."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def saved(df: DataFrame, path: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet and read it again: cuts the lineage, survives lost executors."""
    with unshuffled(df.sparkSession):
        df.write.mode("overwrite").options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete tables of this run that nothing reads any more."""
    for path in paths:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_of(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Two columns, doc_id and text, with a null text as an empty one; other columns are not read."""
    return df.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))


def rows_of(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """text_of with a column ``row``, a 64-bit hash of id and text: with doc_id it tells unlike rows of one id apart,
    and stays the same however often the table is read. Only equal rows share it."""
    return text_of(df, id_column, text_column).withColumn("row", row_hash())


def row_hash(id_column: str = "doc_id", text_column: str = "text") -> Column:
    text = F.coalesce(F.col(text_column), F.lit(""))
    return F.xxhash64(F.col(id_column).cast("long"), F.octet_length(text), text)


def on_row(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """Join on (doc_id, row), null ids included; the right side's two columns go.

    The right side has a row for each key, so it is the one to be hashed: texts are not sorted.
    """
    b = right.withColumnsRenamed({"doc_id": "_doc_id", "row": "_row"}).hint("shuffle_hash")
    return left.join(b, (left["row"] == b["_row"]) & left["doc_id"].eqNullSafe(b["_doc_id"]), how).drop("_doc_id", "_row")


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without copies, and the offsets of its rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, ends, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(ends, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def trim() -> None:
    """Give freed memory back to the system: a Python worker outlives its task and shares the executor's limit."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library keeps it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        _, offsets = utf8(batch.column(batch.schema.get_field_index(column)))
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
            yield batch.slice(i, j - i)
            i = j
        del batch, offsets
        trim()


def binary(chunks: list[bytes]) -> pa.Array:
    return pa.array(chunks, pa.binary())
