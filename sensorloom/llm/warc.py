"""WARC archives: written by Spark's text writer, read back by a reader that salvages what is damaged.

A record is its header lines, an empty line and its payload; the text writer puts CR LF CR LF after each, which is just
how a WARC record ends. So archives are ordinary output files: committed task by task, on any file system Spark knows.
The reader takes plain archives and gzip members, together or apart. Where a record fails its checks it looks for the next
member or version line, goes on from there, and reports the bytes that it left out.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm.common import column_of
from sensorloom.session import scratch_dir

#: Payloads of fewer bytes are always stored.
LEAST_REVISIT = 1000
#: Records in a file: keeps what a reading task holds small.
FILE_RECORDS = 2_000
#: Bytes in a file: a reader takes files whole, and Spark none of 2 GB or more.
FILE_BYTES = 256 << 20
#: Groups of equal payloads that are sent to all tasks (44 bytes each); more are joined by a shuffle.
GROUPS_SENT = 500_000

# Compressed bytes that are inflated at once: what a damaged member loses is found byte by byte in the last of them.
_STEP = 1 << 16
_END = "\r\n\r\n"
_VERSION = re.compile(rb"WARC/\d\.\d\r?\n")
_NEXT = re.compile(rb"WARC/\d\.\d\r?\n|\x1f\x8b\x08")


def records(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """One column ``value``: the WARC record of every page, without the empty lines that end it.

    Of pages with equal payloads of ``least`` bytes or more the one with the largest id is a response, the others
    revisit it; smaller payloads are always responses. Null payloads are empty. Rows of equal ids and payloads are
    alike. A row without an id is a response with an empty id in its header. Line breaks in a url are escaped.
    """
    body = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    rows = pages.select(F.col(key).cast("bigint").alias("id"), F.col(url).cast("string").alias("url"), body.alias("body"))
    rows = rows.withColumn("size", F.octet_length("body").cast("bigint")).withColumn("digest", F.sha1(F.col("body").cast("binary")))
    long = rows.filter((F.col("size") >= least) & F.col("id").isNotNull())
    groups = long.groupBy("digest").agg(F.max("id").alias("first"), F.count("*").alias("c")).filter("c > 1").select("digest", "first")
    if groups.limit(GROUPS_SENT + 1).count() <= GROUPS_SENT:
        groups = F.broadcast(groups)
    rows = rows.join(groups, "digest", "left")
    revisit = (F.col("size") >= least) & F.col("id").isNotNull() & F.col("first").isNotNull() & (F.col("id") != F.col("first"))
    uri = F.regexp_replace(F.col("url"), "[\\x00-\\x20]", "%20")
    kind = F.when(revisit, "revisit").otherwise("response")
    content = F.when(revisit, F.lit("")).otherwise(F.col("body"))
    name = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(">"))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit("WARC-Record-ID: "), name),
        F.lit("WARC-Date: 1970-01-01T00:00:00Z"),
        F.when(uri.isNotNull(), F.concat(F.lit("WARC-Target-URI: "), uri)),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.concat(F.lit("X-Payload-Length: "), F.col("size").cast("string")),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("first").cast("string"), F.lit(">"))),
        F.lit("Content-Type: text/html"),
        F.concat(F.lit("Content-Length: "), F.octet_length(content).cast("string")),
    ]
    return rows.select(F.concat_ws("\r\n", *lines, F.lit(""), content).alias("value"))


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html") -> None:
    """Write the pages as plain WARC files of at most FILE_RECORDS records and, but for a single longer record, about FILE_BYTES.

    An empty table gives no record."""
    longest = pages.agg(F.max(F.octet_length(F.col(payload).cast("string")) + F.coalesce(F.octet_length(F.col(url).cast("string")), F.lit(0)))).first()[0]
    out = records(pages, key, url, payload).write.mode("overwrite").option("lineSep", _END)
    out.option("maxRecordsPerFile", max(1, min(FILE_RECORDS, FILE_BYTES // ((longest or 0) + 1000)))).text(folder)


def salvage(content: bytes) -> Iterator[tuple[int, int, dict | None, bytes, str]]:
    """(offset, length, header, payload, problem) of every record, and of every gap (header None) in the bytes.

    A plain record must have a version line, a Content-Length that fits, and CR LF CR LF after it; a payload of a
    response must have its digest. A gzip member is inflated as far as it goes, and the records in it are salvaged alike.
    Names of header fields are lower-cased; the last of repeated ones counts. Gaps say why they were left out. Offsets
    of records and gaps inside a member are those of the member; a gap inside of it names the inflated bytes. A member that is
    damaged itself is a gap as well, up to the next record or member, whatever was recovered from it.
    """
    at, size = 0, len(content)
    gap, why = None, ""
    while at < size:
        member = content[at : at + 2] == b"\x1f\x8b"
        found, end, problem = _member(content, at) if member else _record(content, at)
        if problem:
            next_ = _NEXT.search(content, at + 1)
            end = next_.start() if next_ else size
        if gap is not None and (found or not problem):
            yield gap, at - gap, None, b"", why
            gap = None
        for header, payload, inner in found:
            yield at, end - at, header, payload, inner
        if problem and gap is None:
            gap, why = at, problem
        at = end
    if gap is not None:
        yield gap, size - gap, None, b"", why


def _inflated(content: bytes, at: int) -> tuple[bytes, int, str]:
    """What a gzip member holds, up to where it is damaged, and its end."""
    inflate, out, view = zlib.decompressobj(31), [], memoryview(content)
    while not inflate.eof and at < len(content):
        before, step = inflate.copy(), view[at : at + _STEP]
        try:
            out.append(inflate.decompress(step))
        except zlib.error:
            try:
                for k in range(len(step)):
                    out.append(before.decompress(step[k : k + 1]))
            except zlib.error:
                pass
            return b"".join(out), at, "bad gzip member"
        at += len(step)
    return b"".join(out), at - len(inflate.unused_data), "" if inflate.eof else "gzip member without end"


def _member(content: bytes, at: int) -> tuple[list[tuple[dict | None, bytes, str]], int, str]:
    plain, end, problem = _inflated(content, at)
    found: list[tuple[dict | None, bytes, str]] = []
    inner = 0
    while inner < len(plain):
        got, inner_end, wrong = _record(plain, inner)
        if wrong:
            next_ = _VERSION.search(plain, inner + 1)
            inner_end = next_.start() if next_ else len(plain)
            got = [(None, b"", f"{wrong}, bytes {inner} to {inner_end} of the member")]
        # the gap of a damaged member covers those inside of it, and what it holds uncompressed is found after it
        if not problem or (not wrong and content.find(plain[inner:inner_end], at) < 0):
            found += got
        inner = inner_end
    return found, end, problem


def _record(content: bytes, at: int) -> tuple[list[tuple[dict | None, bytes, str]], int, str]:
    if not _VERSION.match(content, at):
        return [], at, "no version line"
    stop = content.find(b"\r\n\r\n", at)
    if stop < 0:
        return [], at, "header without end"
    header = {}
    for line in content[at:stop].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return [], at, "bad header line"
        header[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    if "warc-type" not in header or "warc-record-id" not in header:
        return [], at, "header fields are missing"
    length = header.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        return [], at, "no content length"
    start, end = stop + 4, stop + 4 + int(length)
    if content[end : end + 4] != b"\r\n\r\n":
        return [], at, "content does not end where it should"
    payload = content[start:end]
    digest = header.get("warc-payload-digest", "")
    if header.get("warc-type") == "response" and digest.startswith("sha1:") and digest[5:] != hashlib.sha1(payload).hexdigest():
        return [], at, "payload digest differs"
    return [(header, payload, "")], end + 4, ""


_RECORD = (
    "archive string, record_offset bigint, record_length bigint, page_id bigint, url string, record_type string, refers_to bigint, "
    "payload_digest string, payload_bytes bigint, payload binary, problem string"
)


def _page(text: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", text or "")
    return int(found[1]) if found else None


def _read(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split(" ")[0] for f in _RECORD.split(", ")]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.string()]
        for batch in batches:
            for path, content in zip(column_of(batch, "path"), column_of(batch, "content")):
                rows = []
                for at, length, header, payload, problem in salvage(content.as_py() or b""):
                    if header is None:
                        rows.append((path.as_py(), at, length, None, None, None, None, None, None, None, problem))
                        continue
                    digest = header.get("warc-payload-digest", "")
                    digest = digest[5:] if digest.startswith("sha1:") else hashlib.sha1(payload).hexdigest()
                    # a revisit does not hold the payload that it tells the length of
                    full = header.get("x-payload-length", "") if header.get("warc-type") == "revisit" else ""
                    rows.append(
                        (path.as_py(), at, length, _page(header.get("warc-record-id")), header.get("warc-target-uri"), header.get("warc-type"),
                         _page(header.get("warc-refers-to")), digest, int(full) if full.isdigit() else len(payload), payload if with_payload else None, None)
                    )
                columns = list(zip(*rows)) if rows else [[] for _ in names]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return run


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """All records of the archives in a folder, and the gaps: rows with a ``problem`` and nothing else but their place.

    Columns: archive, record_offset, record_length, page_id, url, record_type, refers_to, payload_digest,
    payload_bytes (both of the full payload, also for revisits), payload (null when not asked for; empty for
    revisits), problem (null for records).
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "content")
    return files.mapInArrow(_read(payloads), _RECORD)


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the pages to archives in the shared scratch folder (or ``folder``) and read records and gaps back."""
    folder = folder or scratch_dir(pages.sparkSession, "warc")
    write_archives(pages, folder)
    return read_archives(pages.sparkSession, folder, payloads=False)
