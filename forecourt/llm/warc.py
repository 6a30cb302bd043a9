"""WARC archives with an index that is written first and read by coalesced byte ranges.

Every task writes one archive, each record a gzip member of its own, and one index row per record:
file, offset, length, URL and digest. The index is a Parquet table that Spark commits, so it names
just the archives of tasks that finished. Readers select rows of the index, sort them by place, and
read ranges that lie close together at once; they never scan an archive.

Of records with equal payloads the one with the largest page_id is a response and the others are
revisits of it, which hold the HTTP headers but no payload. Payloads below ``least_bytes`` are all
responses. Equality is that of SHA-1 digests. Which digests occur more than once is found from
digests alone, pre-aggregated; payloads of any length are whole.

A null page is an empty payload. A null url leaves the target header out; a null page_id is written
as ``-`` and revisits any equal payload that has one. Rows that share the largest page_id of their
payload are responses each. An empty table gives an empty index and no archives.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.llm import shared_files
from forecourt.llm.common import only, slices
from forecourt.session import scratch_path, stage

# Names of the WARC 1.1 format.
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP_TYPE = "application/http; msgtype=response"
_DATE = "2020-01-01T00:00:00Z"  # the pages carry no date of capture
_CONTROL = re.compile(r"[\x00-\x20\x7f]")
_LEVEL = 6


def digest_of(payload: bytes) -> str:
    """The bare base32 SHA-1 of a payload."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'-' if page_id is None else page_id}>"


def _page_id(record_id: str) -> int | None:
    number = record_id.removeprefix("<urn:page:").removesuffix(">")
    return None if number == "-" else int(number)


def _target(url: str) -> str:
    """The URL with control characters and blanks percent-encoded."""
    return _CONTROL.sub(lambda c: f"%{ord(c[0]):02X}", url)


def record(page_id: int | None, url: str | None, payload: bytes, original: int | None, digest: str) -> bytes:
    """A response, or a revisit of the record of page ``original``, as one gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if original is None else b"")
    headers = [
        ("WARC-Type", "response" if original is None else "revisit"),
        ("WARC-Record-ID", _record_id(page_id)),
        ("WARC-Date", _DATE),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{digest_of(block)}"),
        ("Content-Type", _HTTP_TYPE),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", _target(url)))
    if original is not None:
        headers += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", _record_id(original))]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in headers) + "\r\n"
    compress = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
    return compress.compress(head.encode() + block + b"\r\n\r\n") + compress.flush()


def parse(member: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers (both by lower-case name) and body of one record."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError(f"no WARC record: {version[:20]!r}")
    headers = {name.lower(): value for name, _, value in (line.partition(": ") for line in lines)}
    block = rest[: int(headers["content-length"])]
    http, _, body = block.partition(b"\r\n\r\n")
    named = (line.partition(": ") for line in http.decode().split("\r\n")[1:])
    return headers, {name.lower(): value for name, _, value in named}, body


def with_originals(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, html and ``original``: the page a revisit refers to, null for responses."""
    rows = only(pages, "page_id", "url", "html").select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce("html", F.lit("")).alias("html"),
    )
    rows = rows.withColumn("sha1", F.sha1("html"))
    repeated = stage(
        rows.where(F.octet_length("html") >= least_bytes)
        .groupBy("sha1")
        .agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND last IS NOT NULL")
        .drop("n"),
        "repeated",
    )
    original = F.when(F.col("last").eqNullSafe(F.col("page_id")), None).otherwise(F.col("last"))
    return rows.join(repeated, "sha1", "left").select("page_id", "url", "html", original.alias("original"))


_INDEX = pa.schema(
    [
        ("file", pa.string()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
        ("url", pa.string()),
        ("digest", pa.string()),
    ]
)


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write a record per row of ``pages`` below ``folder`` and return the index."""

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file = "", None
        for batch in slices(batches):
            if file is None:
                name = shared_files.new_name(TaskContext.get().partitionId(), ".warc.gz")
                file = shared_files.Appender(folder, name)
            urls = batch.column("url").to_pylist()
            places, digests = [], []
            ids, originals = batch.column("page_id").to_pylist(), batch.column("original").to_pylist()
            for page_id, url, page, original in zip(ids, urls, batch.column("html").to_pylist(), originals):
                payload = page.encode()
                digests.append(digest_of(payload))
                places.append(file.write(record(page_id, url, payload, original, digests[-1])))
            columns = [[name] * len(urls), *zip(*places), urls, digests]
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, _INDEX)], schema=_INDEX)
        if file is not None:
            file.close()

    index = with_originals(pages, least_bytes).mapInArrow(
        write, "file string, offset long, length long, url string, digest string"
    )
    return stage(index, "warc_index")


_RECORD = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("refers_to", pa.int64()),
        ("html", pa.string()),
    ]
)


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """The records that the rows of ``index`` name; ``html`` is null for revisits.

    A response whose payload does not have its digest fails the job.
    """

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ranges = zip(*[batch.column(c).to_pylist() for c in ("file", "offset", "length")])
            rows = []
            for member in shared_files.read_ranges(folder, ranges):
                headers, http, body = parse(member)
                digest = headers["warc-payload-digest"].removeprefix("sha1:")
                refers = headers.get("warc-refers-to")
                if refers is None and digest_of(body) != digest:
                    raise ValueError(f"{headers['warc-record-id']}: the payload does not have its digest")
                rows.append(
                    (
                        _page_id(headers["warc-record-id"]),
                        headers.get("warc-target-uri"),
                        headers["warc-type"],
                        int(http["content-length"]) if refers else len(body),
                        digest,
                        _page_id(refers) if refers else None,
                        None if refers else body.decode(),
                    )
                )
            columns = [pa.array(c, t.type) for c, t in zip(zip(*rows), _RECORD)]
            yield pa.RecordBatch.from_arrays(columns, schema=_RECORD)

    return index.sortWithinPartitions("file", "offset").mapInArrow(
        read,
        "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, html string",
    )


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """All records of newly written archives, as read back."""
    folder = scratch_path(spark, "warc")
    return read_archives(write_archives(pages, folder), folder)
