"""WARC archives: written by the tasks, indexed as they are written, read back by coalesced byte ranges.

Every record is a gzip member of its own, so that offset and length in the index are enough to
read it. The index is the first thing a reader meets: it selects records there, sorts them by
file and offset, joins ranges that lie close together, and reads each joined range once.
"""

from __future__ import annotations

import datetime as dt
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.llm.keys import sendable
from smelter.operators.lineage import scratch_folder

INDEX_TYPE = ("record_id bigint, url string, file string, offset bigint, length bigint, payload_bytes bigint, "
              "payload_digest string, record_type string")
RECORD_TYPE = ("record_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
               "refers_to bigint, payload binary")

#: Smaller payloads are always written whole.
REVISIT_BYTES = 1000
#: Ranges closer than this are read as one, up to READ_BYTES at once.
GAP_BYTES = 64 * 1024
READ_BYTES = 8 * 1024 * 1024
#: Records of one task of the reader lie in one span of a file.
SPAN_BYTES = 4 * 1024 * 1024


def plan_records(pages: DataFrame, record_id: str = "page_id", url: str = "url", payload: str = "html",
                 revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Each page with its payload, digest and the record it refers to (null: it is a response).

    Digests that occur once take no part beyond the aggregation, which sums up before its shuffle. The repeated ones
    are sent to the pages while their counted size allows it, so that payloads stay where they are read; beyond it pages
    and digests meet by an equi-join whose hot digests adaptive execution splits.
    """
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = pages.select(F.col(record_id).cast("bigint").alias("record_id"), F.col(url).alias("url"),
                        body.alias("payload")).select(
        "*", F.sha1("payload").alias("payload_digest"), F.octet_length("payload").cast("bigint").alias("payload_bytes"))
    large = rows.filter(F.col("payload_bytes") >= revisit_bytes)
    kept = (large.groupBy("payload_digest").agg(F.max("record_id").alias("kept"), F.count(F.lit(1)).alias("copies"))
            .filter("copies > 1").drop("copies"))
    refers = F.when((F.col("payload_bytes") >= revisit_bytes) & (F.col("record_id") < F.col("kept")), F.col("kept"))
    return rows.join(sendable(kept), "payload_digest", "left").withColumn("refers_to", refers).drop("kept")


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder named as Hadoop does, and the path in it."""
    short = folder.startswith("file:/") and not folder.startswith("file://")
    return fs.FileSystem.from_uri("file://" + folder.removeprefix("file:") if short else folder)


def _member(row, record_type: str, date: str) -> bytes:
    """A record as one gzip member: its block is the page as an HTTP response, or of a revisit only the response's head."""
    revisit = record_type == "revisit"
    target = "" if pd.isna(row.url) else " ".join(row.url.split())
    record_id = "" if pd.isna(row.record_id) else row.record_id
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row.payload_bytes}\r\n\r\n".encode()
    block = http if revisit else http + bytes(row.payload)
    names = [
        "WARC/1.1", f"WARC-Type: {record_type}", f"WARC-Record-ID: <urn:page:{record_id}>", f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{row.payload_digest}",
    ]
    if revisit:
        names += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <urn:page:{row.refers_to}>"]
    names += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return gzip.compress("\r\n".join(names).encode() + block + b"\r\n\r\n", compresslevel=3, mtime=0)


def write_archives(planned: DataFrame, folder: str, date: str | None = None) -> DataFrame:
    """Write every planned record to an archive in ``folder`` and give the index, stored beside it.

    ``date`` is the records' time (as 2026-01-31T12:00:00Z), now unless given; all records have the same.

    Each attempt of a task writes a file of its own name; the index holds the rows of the attempts
    that Spark committed, so what a lost executor left half written is never read.
    """
    date = date or dt.datetime.now(dt.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = _opened(folder)
        name, out, offset = f"{uuid.uuid4().hex}.warc.gz", None, 0
        try:
            for frame in frames:
                places = []
                for row in frame.itertuples(index=False):
                    if out is None:
                        store.create_dir(root, recursive=True)
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                    record_type = "response" if pd.isna(row.refers_to) else "revisit"
                    member = _member(row, record_type, date)
                    out.write(member)
                    record_id = None if pd.isna(row.record_id) else int(row.record_id)
                    places.append((record_id, row.url, name, offset, len(member), row.payload_bytes,
                                   row.payload_digest, record_type))
                    offset += len(member)
                columns = [f.split()[0] for f in INDEX_TYPE.split(", ")]
                yield pd.DataFrame(places, columns=columns, dtype=object)
        finally:
            if out is not None:
                out.close()

    # Ids travel as strings: pandas would turn a whole number beside a null into a float.
    index = planned.select(F.col("record_id").cast("string"), "url", "payload", "payload_digest", "payload_bytes",
                           F.col("refers_to").cast("string"))
    index.mapInPandas(write, INDEX_TYPE).write.parquet(f"{folder}/index")
    return planned.sparkSession.read.schema(INDEX_TYPE).parquet(f"{folder}/index")


def joined_ranges(offsets: list[int], lengths: list[int], gap: int = GAP_BYTES,
                  most: int = READ_BYTES) -> list[tuple[int, int, int, int]]:
    """Sorted ranges joined where they lie close: (offset, end, first, after last) of each joined one.

    A single range larger than ``most`` is read whole.
    """
    joined: list[tuple[int, int, int, int]] = []
    for i, (offset, length) in enumerate(zip(offsets, lengths)):
        end = offset + length
        if joined and offset - joined[-1][1] <= gap and end - joined[-1][0] <= most:
            joined[-1] = (joined[-1][0], max(end, joined[-1][1]), joined[-1][2], i + 1)
        else:
            joined.append((offset, end, i, i + 1))
    return joined


def parse_record(member: bytes) -> tuple:
    """The fields of RECORD_TYPE from one gzip member."""
    raw = gzip.decompress(member)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}
    block = rest[:int(fields["content-length"])]

    def number(field: str) -> int | None:
        digits = fields.get(field, "").removeprefix("<urn:page:").removesuffix(">")
        return int(digits) if digits else None

    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    http, _, payload = block.partition(b"\r\n\r\n")
    lengths = [line.partition(b":")[2] for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")]
    if fields["warc-type"] == "response" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != int(lengths[0])):
        raise ValueError(f"payload of record {fields['warc-record-id']} does not have its digest")
    return (number("warc-record-id"), fields.get("warc-target-uri"), int(lengths[0]), digest,
            fields["warc-type"], number("warc-refers-to"), payload)


def read_records(selected: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records that the rows of an index select, read by sorted and joined byte ranges.

    Rows are dealt by file and span of ``SPAN_BYTES``; responses are checked against their digest.
    A revisit has an empty payload.
    """
    columns = [f.split()[0] for f in RECORD_TYPE.split(", ")]

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = _opened(folder)
        for frame in frames:
            for file, rows in frame.groupby("file", sort=False):
                rows = rows.sort_values("offset")
                offsets, lengths = rows["offset"].tolist(), rows["length"].tolist()
                with store.open_input_file(f"{root}/{file}") as source:
                    for start, end, first, last in joined_ranges(offsets, lengths):
                        block = source.read_at(end - start, start)
                        found = [parse_record(block[o - start:o - start + n])
                                 for o, n in zip(offsets[first:last], lengths[first:last])]
                        out = pd.DataFrame(found, columns=columns, dtype=object)
                        if not with_payload:
                            out["payload"] = None
                        yield out

    # By the bytes to read: adaptive execution would see only the index's few rows and put them into one task.
    size = selected.agg(F.sum("length")).collect()[0][0] or 0
    tasks, span = max(1, -(-size // SPAN_BYTES)), F.floor(F.col("offset") / SPAN_BYTES)
    dealt = selected.select("file", "offset", "length").repartition(tasks, "file", span).sortWithinPartitions("file", "offset")
    return dealt.mapInPandas(read, RECORD_TYPE)


def round_trip(pages: DataFrame, with_payload: bool = True) -> DataFrame:
    """Write a record per page to archives in the session's shared folder, and read all of them back.

    Null payloads are empty; null urls are empty; white space runs inside a url become one space in the
    archive. Of records with equal payloads of at least ``REVISIT_BYTES`` bytes that with the largest id
    is the response and the others revisit it; where that largest id is repeated, each of its rows is a
    response. Records with a null id are responses. An empty table gives an empty result; further
    columns are left out.
    """
    folder = scratch_folder(pages.sparkSession)
    index = write_archives(plan_records(pages), folder)
    return read_records(index, folder, with_payload)
