"""WARC archives: one gzip member a record, an index of every record first, then byte-range reads of those selected.

Writing: each task streams its rows to archives of its own in a shared folder and returns an index row (path, offset,
length, URL, digest) for each record. A task that runs again writes new files; only the rows of the attempt that Spark
committed name files, others are never read. Reading: the wanted index rows are sorted by place, near
ranges are coalesced to one read, and records are cut out of it.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varlake.llm.arrays import slices
from varlake.llm.common import shared_folder, stage

#: Bytes of an archive beyond which the next record begins another.
ARCHIVE_BYTES = 1 << 30
#: Ranges no further apart than this are read at once, up to so many bytes a read (a longer record is read alone).
GAP_BYTES, READ_BYTES = 64 << 10, 8 << 20
#: Bytes of archive that a reading task gets at most, about.
TASK_BYTES = 128 << 20
#: Payloads of more rows than HOT_ROWS and more than one MOST_HOT-th of all repeated rows are joined apart.
HOT_ROWS, MOST_HOT = 1000, 10_000
#: A fixed capture time, as the tables have none.
DATE = "2000-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None, turn: str) -> str:
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:uuid:{turn}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str = DATE) -> bytes:
    """One record: a response with its payload, or a revisit that only has the response's HTTP header."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_record_id(page_id, uuid.uuid4().hex)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_record_id(refers_to, '')}", f"WARC-Profile: {_PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    pack = zlib.compressobj(4, zlib.DEFLATED, 31)
    return pack.compress(("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n") + pack.flush()


def parse(member: bytes) -> dict:
    """Type, ids, URL, digest and payload of one record; the digest of a response is checked."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")

    def page(name: str) -> int | None:
        value = fields.get(name, "").removeprefix("<urn:page:").removesuffix(">")
        return int(value) if value.lstrip("-").isdigit() else None

    return {"page_id": page("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"], "refers_to": page("WARC-Refers-To"), "payload_bytes": size, "payload_digest": digest, "payload": payload if fields["WARC-Type"] == "response" else None}


def roles(pages: DataFrame, revisit_bytes: int = 0) -> DataFrame:
    """pages (page_id long, url, html) as page_id, url, html (null: empty), refers_to: of rows with equal payloads of at least
    revisit_bytes the one with the smallest page_id is referred to by the others. Rows of a null page_id, or
    that repeat the smallest, refer to none. Payloads are equal if length and SHA-1 are."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.sha1(F.col("html").cast("binary"))).withColumn("size", F.octet_length("html"))
    repeated = rows.where(F.col("size") >= revisit_bytes).groupBy("sha", "size").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    repeated = stage(repeated, "repeated")  # its size is known to the planner, which broadcasts it only if small
    # payloads of so many rows are MOST_HOT at most; their rows need no shuffle
    copies = repeated.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = repeated.where(F.col("n") > max(HOT_ROWS, copies // MOST_HOT)).select("sha", "size", "first")
    joined = rows.join(repeated.select("sha", "size", "first"), ["sha", "size"], "left") if hot.isEmpty() else _apart(rows, repeated, hot)
    return joined.select("page_id", "url", "html", F.expr("if(page_id <> first, first, NULL)").alias("refers_to"))


def _apart(rows: DataFrame, repeated: DataFrame, hot: DataFrame) -> DataFrame:
    few = F.broadcast(hot)
    rest = rows.join(few, ["sha", "size"], "left_anti").join(repeated.select("sha", "size", "first"), ["sha", "size"], "left")
    return rows.join(few, ["sha", "size"]).unionByName(rest)


INDEX = "page_id long, url string, digest string, record_type string, path string, offset long, length long"


def write_warc(pages: DataFrame, revisit_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES, date: str = DATE) -> DataFrame:
    """Archives of pages in the shared folder; returns the index, which is written there, too. The folder may be in any store
    that pyarrow reaches by its URI. An empty table gives no archive and an empty index."""
    folder = f"{shared_folder(pages.sparkSession)}/warc-{uuid.uuid4().hex}"

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, out, path, at, number = TaskContext.get(), None, "", 0, 0
        store, root = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        try:
            for batch in slices(batches, "html"):
                rows = []
                for page_id, url, html, first in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to"))):
                    payload = html.encode()
                    digest = base32_sha1(payload)
                    member = record(page_id, url, payload, digest, first, date)
                    if out is None or at + len(member) > archive_bytes:
                        if out is not None:
                            out.close()
                        store.create_dir(root, recursive=True)
                        path = f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{number:03d}.warc.gz"
                        out, at, number = store.open_output_stream(f"{root}/{path}", compression=None), 0, number + 1
                    out.write(member)
                    rows.append((page_id, url, digest, "response" if first is None else "revisit", f"{folder}/{path}", at, len(member)))
                    at += len(member)
                columns = list(zip(*rows))
                kinds = [pa.int64(), *[pa.string()] * 4, pa.int64(), pa.int64()]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=["page_id", "url", "digest", "record_type", "path", "offset", "length"])
        finally:
            if out is not None:
                out.close()

    return stage(roles(pages, revisit_bytes).mapInArrow(written, INDEX), "warc-index")


def coalesced(offset: np.ndarray, length: np.ndarray, gap: int = GAP_BYTES, most: int = READ_BYTES) -> list[tuple[int, int]]:
    """First and last-but-one numbers of the sorted ranges that one read covers."""
    cuts, lo = [], 0
    for i in range(1, len(offset) + 1):
        if i == len(offset) or offset[i] - (offset[i - 1] + length[i - 1]) > gap or offset[i] + length[i] - offset[lo] > most:
            cuts.append((lo, i))
            lo = i
    return cuts


RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def read_warc(index: DataFrame, payload: bool = True) -> DataFrame:
    """The records that rows of index (path, offset, length) name, one row each; payload is null for revisits, and for all
    if not wanted. Rows that are repeated are read again; no rows, no reads. Index rows are tiny, but what they name is not:
    they are dealt out by their bytes, over all cores at least."""
    total = index.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = max(index.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    places = index.select("path", "offset", "length").repartitionByRange(tasks, "path", "offset").sortWithinPartitions("path", "offset")
    schema = RECORDS if payload else RECORDS.removesuffix(", payload binary")
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            path, offset, length = batch.column("path").to_pylist(), batch.column("offset").to_numpy(), batch.column("length").to_numpy()
            lo = 0
            while lo < len(path):
                hi = lo
                while hi < len(path) and path[hi] == path[lo]:
                    hi += 1
                store, name = fs.FileSystem.from_uri(path[lo] if "://" in path[lo] else f"file://{path[lo]}")
                with store.open_input_file(name) as source:
                    for a, b in coalesced(offset[lo:hi], length[lo:hi]):
                        begin = int(offset[lo + a])
                        end = int(max(offset[lo + a : lo + b] + length[lo + a : lo + b]))
                        data = memoryview(source.read_at(end - begin, begin))
                        rows = [parse(data[int(o) - begin : int(o) - begin + int(n)]) for o, n in zip(offset[lo + a : lo + b], length[lo + a : lo + b])]
                        yield pa.record_batch([pa.array([r[c] for r in rows], k) for c, k in zip(names, kinds)], names=names)
                lo = hi

    return places.mapInArrow(fetched, schema)
