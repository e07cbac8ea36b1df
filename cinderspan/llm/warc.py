"""WARC archives: written with an index, read back by coalesced byte ranges.

Records are gzip members of their own, so any one can be read alone. While a task writes an
archive it notes each record's file, offset, length, URL and digest; that index is a table. A
read takes selected index rows, sorts them by file and offset, merges neighbouring ranges up
to a gap and a size, fetches each merged range once and cuts the records out.

Of pages with equal payloads of at least ``least`` bytes, that with the largest id becomes a
response and the others revisit it; smaller payloads are all responses. A null payload is empty.
Pages with a null id are archived under no id and never refer to, nor are referred to by, others.
Rows that repeat an id and payload are responses alike. Every record has an id of its own, made from
its file and offset; the page's id is a field beside it. A payload of any length is one record. An
empty table gives an empty index. Only ``page_id``, ``url`` and ``html`` are read, so other columns
cannot clash.

Archives go to the shared folder under names that no other attempt uses; an attempt that fails
leaves a file that no index row names.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderspan.llm.arrow import groups
from cinderspan.session import cut, shared_path

INDEX = "page_id long, url string, payload_digest string, record_type string, refers_to long, file string, offset long, length long"
RECORD = "record_id string, page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
DATE = "2024-01-01T00:00:00Z"


def record(name: str, page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One response or revisit record as a gzip member; ``name`` makes its id. A revisit keeps the HTTP header alone."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = head if revisit else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>",
        f"X-Page-ID: {'' if page_id is None else page_id}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page-ID: {refers_to}"]
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 4, mtime=0)


def parse(member: bytes) -> dict:
    """The fields of a record, ``payload`` included (None in a revisit)."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    told = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    number = lambda x: int(x) if x else None
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit:
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if f"sha1:{digest}" != fields["WARC-Payload-Digest"] or len(payload) != int(told["Content-Length"]):
            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return {
        "record_id": fields["WARC-Record-ID"],
        "page_id": number(fields["X-Page-ID"]),
        "url": fields["WARC-Target-URI"],
        "payload_bytes": int(told["Content-Length"]),
        "payload_digest": fields["WARC-Payload-Digest"][5:],
        "record_type": fields["WARC-Type"],
        "refers_to": number(fields.get("X-Refers-To-Page-ID")),
        "payload": None if revisit else payload,
    }


def write_archives(pages: DataFrame, folder: str | None = None, least: int = 0, archive_bytes: int = 128 << 20) -> DataFrame:
    """Archive ``pages`` (page_id, url, html) and return the index, which is written too."""
    folder = folder or shared_path(pages.sparkSession, "warc")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    digests = rows.select("page_id", F.sha1(F.col("html").cast("binary")).alias("sha1"), F.octet_length("html").alias("size")).where("page_id IS NOT NULL").where(F.col("size") >= least)
    # The smallest payload repeats in many pages at most as a count: a map-side combined maximum.
    newest = digests.groupBy("sha1").agg(F.max("page_id").alias("newest"), F.count("*").alias("n")).where("n > 1").drop("n")
    refers = digests.join(newest, "sha1").where("page_id <> newest").select("page_id", "sha1", "newest").distinct()
    keyed = rows.withColumn("sha1", F.sha1(F.col("html").cast("binary")))
    marked = keyed.join(refers, ["page_id", "sha1"], "left").select("page_id", "url", "html", "newest")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        out = name = None
        at = 0
        try:
            for batch in batches:
                index = []
                for page_id, url, html, newest_id in zip(*(c.to_pylist() for c in batch.columns)):
                    if out is None or at >= archive_bytes:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = system.open_output_stream(f"{root}/{name}", compression=None)
                    payload = html.encode()
                    clean = "".join(url.splitlines())
                    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    member = record(f"{name}#{at}", page_id, clean, payload, digest, newest_id)
                    out.write(member)
                    index.append((page_id, clean, digest, "response" if newest_id is None else "revisit", newest_id, f"{folder}/{name}", at, len(member)))
                    at += len(member)
                kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
                if out is not None:
                    out.flush()
                if index:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*index), kinds)], [f.split()[0] for f in INDEX.split(", ")])
        finally:
            if out is not None:
                out.close()

    return cut(marked.mapInArrow(work, INDEX), "warc-index")


def read_records(index: DataFrame, gap: int = 64 << 10, most: int = 8 << 20, with_payload: bool = False, per_task: int = 32 << 20) -> DataFrame:
    """The records of the selected index rows, each merged range fetched once.

    An archive's rows are dealt by stretches of ``most`` bytes of it, so a large archive is read by
    several tasks, and the tasks are as many as the bytes that they read ask for (about ``per_task``
    each): the index alone is small, and by its own size one task would read every archive.
    """
    stretch = F.floor(F.col("offset") / F.lit(most))
    total = index.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = max(index.sparkSession.sparkContext.defaultParallelism, total // per_task + 1)
    dealt = index.select("file", "offset", "length").withColumn("key", F.concat_ws("#", "file", stretch.cast("string")))
    dealt = dealt.repartition(tasks, "key").sortWithinPartitions("key", "offset")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in RECORD.split(", ")] + ["payload"] * with_payload
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        for group in groups(batches, "key"):
            system, path = fs.FileSystem.from_uri(group.column("file")[0].as_py())
            spans = list(zip(group.column("offset").to_pylist(), group.column("length").to_pylist()))
            with system.open_input_file(path) as file:
                first = 0
                while first < len(spans):
                    begin, end, stop = spans[first][0], sum(spans[first]), first + 1
                    while stop < len(spans) and spans[stop][0] - end <= gap and sum(spans[stop]) - begin <= most:
                        end = max(end, sum(spans[stop]))
                        stop += 1
                    file.seek(begin)
                    data = file.read(end - begin)
                    found = [parse(data[a - begin : a - begin + n]) for a, n in spans[first:stop]]
                    yield pa.RecordBatch.from_arrays([pa.array([r[x] for r in found], k) for x, k in zip(names, kinds)], names)
                    first = stop

    return dealt.mapInArrow(work, RECORD + ", payload binary" * with_payload)
