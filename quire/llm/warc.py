"""WARC archives of captures, and their index by an external merge of locally sorted runs.

``write_archives`` writes one record per page, each a gzip member of its own, so a
capture can be read by its offset and length in the archive. An archive is one
value of Spark's text writer (followed by a line end, which gzip readers skip), so
archives are committed like any other output and survive lost executors. Of pages with
equal payloads of at least ``REVISIT_BYTES``, the one with the largest page_id
is a response and the others are revisits that refer to it.

``read_captures`` streams the archives and checks each payload against its
digest. Every archive is a run, sorted by URL key, time and page_id.
``merged_index`` deals the runs into key ranges by a sample of all runs' keys
and merges the range's run segments with a loser tree, so captures come in one
global order: ascending (range, place), and ``rank`` over all. Ranges cut at the
whole sort key, so a hot URL spans several, and hold about RANGE_ROWS captures.

Defined results: a null html is empty, a null url becomes urn:page:<id>; page_ids
are distinct (of rows with an equal page_id each is written); an empty table
gives an empty result; further columns are ignored; null page_ids are dropped.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import binary, saved, shared_dir, unshuffled

REVISIT_BYTES = 1000
#: Uncompressed bytes of an archive, about, and captures of a key range.
ARCHIVE_BYTES = 16 << 20
RANGE_ROWS = 20_000
SAMPLES = 50_000
EPOCH = "2024-01-01 00:00:00"
CAPTURE = "page_id long, url_key string, captured string, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string, offset long, length long"
_NAMES = [x.split()[0] for x in CAPTURE.split(", ")]
_TYPES = [pa.int64() if x.endswith("long") else pa.string() for x in CAPTURE.split(", ")]


def records(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """The records' text."""
    base = pages.where(F.col(id_column).isNotNull()).select(F.col(id_column).cast("long").alias("page_id"), F.col(url_column).alias("url"), F.coalesce(F.col(html_column), F.lit("")).alias("html"))
    base = base.withColumns({"digest": F.sha1("html"), "size": F.octet_length("html").cast("long")})
    copies = base.where(F.col("size") >= REVISIT_BYTES).groupBy("digest", "size").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    rows = base.join(copies, ["digest", "size"], "left")
    revisit = F.coalesce(F.col("first") != F.col("page_id"), F.lit(False))
    url = F.coalesce(F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20"), F.concat(F.lit("urn:page:"), F.col("page_id")))
    date = F.date_format(F.timestamp_seconds(F.unix_timestamp(F.lit(EPOCH)) + F.pmod("page_id", F.lit(1 << 30))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit("\r\n\r\n"))
    body = F.when(revisit, F.lit("")).otherwise(F.col("html"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), F.col("page_id").cast("string"),
        F.lit(">\r\nWARC-Target-URI: "), url,
        F.lit("\r\nWARC-Date: "), date,
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: <urn:page:"), F.col("first").cast("string"), F.lit(">"))).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), (F.octet_length(http) + F.octet_length(body)).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return rows.select(F.concat(head, http, body, F.lit("\r\n\r\n")).alias("value"))


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records as gzip members, about ARCHIVE_BYTES of records to a row."""
    held, size = [], 0
    for batch in batches:
        for record in batch.column(0):
            raw = record.as_py().encode()
            held.append(gzip.compress(raw, 6, mtime=0))
            size += len(raw)
            if size >= ARCHIVE_BYTES:
                yield pa.record_batch([binary([b"".join(held)])], ["value"])
                held, size = [], 0
    if held:
        yield pa.record_batch([binary([b"".join(held)])], ["value"])


def write_archives(pages: DataFrame, path: str, **columns: str) -> None:
    archives = records(pages, **columns).mapInArrow(_members, "value binary").select(F.col("value").cast("string"))
    with unshuffled(pages.sparkSession):
        archives.write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)


def _each_member(raw: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, record) of an archive's gzip members."""
    at, end = 0, len(raw)
    while at < end and raw[at : at + 2] == b"\x1f\x8b":
        inflate, out, step = zlib.decompressobj(31), [], 1 << 14
        low = at
        while not inflate.eof:
            part = raw[low : low + step]
            if not part:
                raise ValueError("an archive ends within a record")
            out.append(inflate.decompress(part))
            low += len(part)
        low -= len(inflate.unused_data)
        yield at, low - at, b"".join(out)
        at = low
    if raw[at:].strip():
        raise ValueError("an archive holds what is no record")


def url_key(url: str) -> str:
    """Host labels from the last to the first, the port unless it is the scheme's, then path and query: captures of a site sort together."""
    parts = urlsplit(url if "://" in url else f"urn://{url}") if not url.startswith("urn:") else None
    if parts is None or not parts.netloc:
        return url
    host, _, port = parts.netloc.lower().rpartition("@")[2].partition(":")
    port = "" if port in ("", {"http": "80", "https": "443"}.get(parts.scheme)) else f":{port}"
    return ",".join(reversed(host.removeprefix("www.").split("."))) + port + ")" + (parts.path or "/") + ("?" + parts.query if parts.query else "")


def captures(raw: bytes, archive: str) -> Iterator[tuple]:
    """One tuple (columns of CAPTURE) per record, in the archive's order."""
    for begin, length, record in _each_member(raw):
        head, _, rest = record.partition(b"\r\n\r\n")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode().split("\r\n")[1:])}
        block = rest[: int(fields["content-length"])]
        if rest[len(block) :] != b"\r\n\r\n":
            raise ValueError("a record isn't closed")
        http, _, payload = block.partition(b"\r\n\r\n")
        size = next(int(x.partition(b":")[2]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
        digest, kind, refers = fields["warc-payload-digest"].partition(":")[2], fields["warc-type"], None
        if kind == "response":
            if len(payload) != size or hashlib.sha1(payload).hexdigest() != digest:
                raise ValueError(f"the payload of {fields['warc-record-id']} isn't what its digest says")
        else:
            refers = int(fields["warc-refers-to"].strip("<>").rpartition(":")[2])
        yield int(fields["warc-record-id"].strip("<>").rpartition(":")[2]), url_key(fields["warc-target-uri"]), fields["warc-date"], size, digest, kind, refers, archive, begin, length


def _key(capture: tuple) -> tuple:
    return capture[1], capture[2], capture[0]


def _batch(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    return pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            run = sorted(captures(raw.as_py(), path.rpartition("/")[2]), key=_key)
            for k in range(0, len(run), 4096):
                yield _batch(run[k : k + 4096], _NAMES, _TYPES)


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """All captures; those of one archive stand together, sorted by URL key, time and page_id."""
    return spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content").mapInArrow(_runs, CAPTURE)


class LoserTree:
    """k-way merge: inner nodes hold the loser of their match, so a new head replays one path to the root."""

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs = runs
        self.heads = [next(r, None) for r in runs]
        self.keys = [None if h is None else _key(h) for h in self.heads]
        k = len(runs)
        self.losers = [-1] * max(k, 1)
        self.winner = self._play(1) if k > 1 else 0

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.keys[a], self.keys[b]
        return y is None or (x is not None and (x, a) <= (y, b))

    def _play(self, node: int) -> int:
        k = len(self.runs)
        if node >= k:
            return node - k
        a, b = self._play(2 * node), self._play(2 * node + 1)
        if not self._beats(a, b):
            a, b = b, a
        self.losers[node] = b
        return a

    def __iter__(self) -> Iterator[tuple]:
        k = len(self.runs)
        while self.runs and self.keys[self.winner] is not None:
            best = self.winner
            yield self.heads[best]
            head = self.heads[best] = next(self.runs[best], None)
            self.keys[best] = None if head is None else _key(head)
            node = (best + k) // 2
            while node >= 1:
                if not self._beats(best, self.losers[node]):
                    best, self.losers[node] = self.losers[node], best
                node //= 2
            self.winner = best


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    runs: dict[str, list[tuple]] = {}
    where = None
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            where = row[0]
            runs.setdefault(row[8], []).append(row[1:])
    for run in runs.values():  # a run's batches may come in any order
        if any(_key(a) > _key(b) for a, b in zip(run, run[1:])):
            run.sort(key=_key)
    rows = []
    for place, row in enumerate(LoserTree([iter(r) for r in runs.values()])):
        rows.append((where, place, *row))
        if len(rows) == 4096:
            yield _batch(rows, ["range", "place", *_NAMES], [pa.int32(), pa.int64(), *_TYPES])
            rows = []
    if rows:
        yield _batch(rows, ["range", "place", *_NAMES], [pa.int32(), pa.int64(), *_TYPES])


def merged_index(runs: DataFrame) -> DataFrame:
    """All captures of ``runs`` (written) in one order: by (range, place)."""
    total = runs.count()
    ranges = max(1, total // RANGE_ROWS)
    cuts: list[tuple] = []
    if ranges > 1:  # the cuts come from about SAMPLES keys, by hash; every capture is merged
        step = max(1, total // SAMPLES)
        keys = runs.where(F.pmod(F.xxhash64("page_id"), F.lit(step)) == 0).select("url_key", "captured", "page_id").collect()
        keys = sorted(tuple(k) for k in keys)
        cuts = [keys[len(keys) * k // ranges] for k in range(1, ranges)] if len(keys) >= ranges else keys

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in (1, 2, 0)), strict=True)
            yield pa.record_batch([pa.array([bisect.bisect_left(cuts, k) for k in keys], pa.int32()), *batch.columns], ["range", *_NAMES])

    dealt = runs.mapInArrow(deal, f"range int, {CAPTURE}").repartitionById(len(cuts) + 1, F.col("range"))
    return dealt.mapInArrow(_merge, f"range int, place long, {CAPTURE}")


def archive_and_index(pages: DataFrame, **columns: str) -> DataFrame:
    """Write the archives, read them back, and merge their runs to one index."""
    spark = pages.sparkSession
    work = shared_dir(spark, "warc")
    write_archives(pages, f"{work}/archives", **columns)
    runs = saved(read_captures(spark, f"{work}/archives"), f"{work}/runs")
    index = saved(merged_index(runs), f"{work}/index")
    # Captures before each range: a row per RANGE_ROWS captures.
    before = F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    sizes = index.groupBy("range").agg(F.count("*").alias("n")).select("range", F.coalesce(before, F.lit(0)).alias("before"))
    return index.join(sizes, "range").withColumn("rank", F.col("before") + F.col("place") + 1).drop("before")


def fetch(raw: bytes, offset: int, length: int) -> bytes:
    """The record that the index names, from the bytes of its archive at that place alone."""
    return gzip.decompress(raw[offset : offset + length])
