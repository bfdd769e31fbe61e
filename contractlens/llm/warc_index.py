"""WARC archives with an external index merge.

Pages are written as WARC 1.1 records; of equal payloads the one with the
smallest id is stored and the others are revisit records that refer to it.
Reading an archive back gives one capture run per file, sorted by URL key and
time.  The runs are range-partitioned, and each range is put together by a
k-way merge with a loser tree, so that the partitions, one after the other, hold
the capture history of every URL.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractlens.llm.common import small_batches, work_dir

FILE_BYTES = 16 << 20  # payload bytes per archive file, about
RANGE_ROWS = 50_000  # captures per merged range, about
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"  # fixed value
INDEX = (
    "url_key string, captured string, page_id long, url string, record_type string, refers_to long, "
    "payload_bytes long, payload_digest string, file string, offset long"
)
KEY = (0, 1, 2)  # url_key, captured, page_id order a history


def base32_sha1(digits: Column) -> Column:
    """Bare upper-case base32 of a SHA-1 in hex: every fifteen hex digits are twelve digits to the base 32."""
    parts = [(1, 15, 12), (16, 15, 12), (31, 10, 8)]  # fifteen hex digits fit a long
    base32 = [F.lpad(F.conv(F.substring(digits, at, n), 16, 32), to, "0") for at, n, to in parts]
    return F.translate(F.concat(*base32), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def with_revisits(pages: DataFrame) -> DataFrame:
    """Adds payload, its size and digest, `record_type` and `refers_to`.

    The first page of a payload comes from an aggregation (combined before the
    shuffle) that is joined back; a payload shared by many pages is split by the
    skew join.
    """
    known = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload")).withColumns(
        {"payload_bytes": F.octet_length("payload").cast("long"), "_digits": F.sha1(F.col("payload").cast("binary"))}
    )
    # joined by the hex digits, which are never NULL: a key that could be is tested for it by a filter that hashes the payload anew
    first = known.groupBy("_digits", "payload_bytes").agg(F.min("page_id").alias("first_id"))
    again = F.col("page_id") != F.col("first_id")
    return (
        known.join(first, ["_digits", "payload_bytes"])
        .withColumn("payload_digest", base32_sha1(F.col("_digits")))
        .withColumn("record_type", F.when(again, F.lit("revisit")).otherwise(F.lit("response")))
        .withColumn("refers_to", F.when(again, F.col("first_id")))
        .drop("first_id", "_digits")
    )


def record(captured: Column) -> Column:
    """Text of one WARC record without the end that separates records."""
    line = lambda name, value: F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")))
    one_line = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit(END)
    )
    revisit = F.col("record_type") == "revisit"
    size = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", urn(F.col("page_id"))),
        line("WARC-Target-URI", one_line),
        line("WARC-Date", captured),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("WARC-Refers-To", urn(F.col("refers_to"))),
        line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", size.cast("string")),
        F.lit("\r\n"),
        http,
        F.when(revisit, F.lit("")).otherwise(F.col("payload")),
    )


def capture_time(page_id: Column) -> Column:
    """A time for pages that carry none: one second per id from a fixed day on."""
    seconds = F.lit(1_577_836_800) + F.pmod(F.coalesce(page_id, F.lit(0)), F.lit(1_000_000_000))
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def write_archives(pages: DataFrame, folder: str) -> int:
    """Writes gzipped archives below ``folder``; returns the number of pages."""
    n, size = pages.agg(F.count("*"), F.sum(F.octet_length("html"))).first()
    per_file = max(1, n * FILE_BYTES // max(1, size or 0))
    (
        with_revisits(pages)
        .select(record(capture_time(F.col("page_id"))).alias("value"))
        .write.option("lineSep", END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", per_file)
        .text(folder)
    )
    return n


def url_key(url: str | None) -> str:
    """Sort key of a URL: host reversed, without `www.` and port, then path and query in lower case."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host = (parts.hostname or "").lower().removeprefix("www.")
    except ValueError:
        return url.lower()
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}){parts.path or '/'}{query}".lower()


def records(content: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of every record of one gzipped archive, read by declared length."""
    stream = gzip.GzipFile(fileobj=io.BytesIO(content))
    while True:
        at, first = stream.tell(), stream.readline()
        if not first:
            return
        if not first.startswith(b"WARC/"):
            raise ValueError(f"no record at {at}")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8", "replace").rstrip("\r\n").partition(": ")
            headers[name] = value
        block = stream.read(int(headers["Content-Length"]))
        if stream.read(4) != END.encode():
            raise ValueError(f"the record at {at} is not whole")
        yield at, headers, block


def page_of(urn: str | None) -> int | None:
    return int(urn[len("<urn:page:") : -1]) if urn else None


def run_of(file: str, content: bytes) -> list[tuple]:
    """Index rows of one archive, sorted: one capture run."""
    rows = []
    for at, headers, block in records(content):
        http, _, payload = block.partition(END.encode())
        size = int(http.rpartition(b": ")[2])
        digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
        if headers["WARC-Type"] == "response":
            if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest or len(payload) != size:
                raise ValueError(f"{file}: the payload at {at} differs from its digest")
        url = headers.get("WARC-Target-URI")
        rows.append(
            (url_key(url), headers["WARC-Date"], page_of(headers.get("WARC-Record-ID")), url, headers["WARC-Type"],
             page_of(headers.get("WARC-Refers-To")), size, digest, file, at)
        )
    rows.sort(key=order)
    return rows


def order(row: tuple) -> tuple:
    return row[0], row[1], row[2] is not None, row[2] or 0, row[8], row[9]


class LoserTree:
    """Merges sorted runs: every inner node keeps the loser of its match, the winner moves up."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs, self.at, self.k = runs, [0] * len(runs), len(runs)
        self.heads = [order(r[0]) if r else None for r in runs]
        self.losers = [-1] * self.k
        for leaf in range(self.k):
            self._play(leaf, building=True)

    def _less(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None and x is not None or x is not None and x < y

    def _play(self, leaf: int, building: bool = False) -> None:
        winner, node = leaf, (leaf + self.k) // 2
        while node > 0:
            if self.losers[node] < 0 and building:  # the other side of this match has not come yet
                self.losers[node] = winner
                return
            if self._less(self.losers[node], winner):
                winner, self.losers[node] = self.losers[node], winner
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.k and self.heads[winner := self.losers[0]] is not None:
            run, i = self.runs[winner], self.at[winner]
            yield run[i]
            self.at[winner] = i + 1
            self.heads[winner] = order(run[i + 1]) if i + 1 < len(run) else None
            self._play(winner)


def table_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


ARROW_INDEX = pa.schema(
    [(n, pa.int64() if kind == "long" else pa.string()) for n, kind in (x.strip().split(" ") for x in INDEX.split(","))]
)


def read_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content")):
            yield table_of(run_of(path.as_py().rpartition("/")[2], content.as_py()), ARROW_INDEX)


def merge_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    runs: dict[str, list[list[tuple]]] = {}
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            own = runs.setdefault(row[8], [[]])
            if own[-1] and order(row) < order(own[-1][-1]):  # a run that came in several pieces
                own.append([])
            own[-1].append(row)
    held = []
    for row in LoserTree([r for own in runs.values() for r in own if r]):
        held.append(row)
        if len(held) == 4096:
            yield table_of(held, ARROW_INDEX)
            held = []
    yield table_of(held, ARROW_INDEX)


def capture_index(folder: str, spark, n: int) -> DataFrame:
    """Index of all archives below ``folder``; partitions follow each other in (URL key, time, id)."""
    small_batches(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("path", "content")
    runs = files.mapInArrow(read_runs, INDEX)
    ranges = runs.repartitionByRange(max(1, n // RANGE_ROWS), "url_key", "captured", "page_id")
    return ranges.mapInArrow(merge_runs, INDEX)


def archive(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) as archives, reads them back: the merged capture index.

    NULL html is an empty payload; empty payloads are equal payloads like
    others.  NULL urls have the empty key; rows repeated with one id are all
    responses (or all revisits).  An empty table gives an empty index.  Other
    columns play no part.  ``folder`` defaults to one below the shared folder.
    """
    spark = pages.sparkSession
    folder = folder or f"{work_dir(spark)}/contractlens/warc-{uuid.uuid4().hex}"
    n = write_archives(pages, folder)
    if not n:
        return spark.createDataFrame([], INDEX)
    return capture_index(folder, spark, n)


def oracle() -> str:
    """What the archives give back, from the pages themselves."""
    digit = "cast('0x' || digits[5 * x + 1 : 5 * x + 5] as integer)"
    four = " || ".join(f"'{BASE32}'[1 + (({digit} >> {shift}) & 31)]" for shift in (15, 10, 5, 0))
    return f"""
with known as (select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as digits from pages),
named as (select *, array_to_string([{four} for x in range(8)], '') as payload_digest, min(page_id) over (partition by payload) as first_id from known)
select page_id, cast(octet_length(encode(payload)) as bigint) as payload_bytes, payload_digest,
  case when page_id <> first_id then 'revisit' else 'response' end as record_type,
  case when page_id <> first_id then first_id end as refers_to
from named"""
