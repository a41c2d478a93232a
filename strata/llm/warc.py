"""WARC archives by way of a chunked record table.

A page's payload is cut into rows (record, chunk number, bytes) of bounded
size. Each carries the digest of the payload up to its end, so the last chunk
holds the digest and length of the whole, and no later step needs a record in
one piece. Which record is a response and which a revisit is decided on the
last chunks alone. Then chunks are partitioned by record, sorted by chunk
number behind a row that holds the decision, and streamed into gzip members,
one a record. Reading streams the archives into chunk rows again, checking the
digest as it goes.

A task that is run again writes files of another name; readers follow the
manifest, which holds the files of the attempts that counted. Archives go to a
folder that all executors share.
"""
from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: bytes of a chunk, of a batch of chunks, and after which the next archive starts
CHUNK, BATCH, ARCHIVE = 1 << 18, 1 << 23, 1 << 30
#: smaller payloads are never revisited; deflate level of chunks and archives
LEAST, LEVEL = 100, 5
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CHUNKS = ("record long, page_id long, url string, chunk int, last boolean, upto long, digest string, "
          "payload binary")
RECORDS = ("record_id string, record_type string, page_id long, url string, refers_to_id string, refers_to long, "
           "payload_bytes long, payload_digest string, chunk int, last boolean, upto long, digest string, "
           "payload binary")


class _Rows:
    """Collects rows and gives them back as batches of bounded bytes."""

    def __init__(self, names: list[str], types: list[pa.DataType]):
        self.schema = pa.schema(list(zip(names, types)))
        self.rows, self.held = [], 0

    def add(self, row: tuple, size: int) -> pa.RecordBatch | None:
        self.rows.append(row)
        self.held += size + 256
        return self.flush() if self.held >= BATCH else None

    def flush(self) -> pa.RecordBatch:
        cols = list(zip(*self.rows)) or [()] * len(self.schema)
        out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, self.schema)], schema=self.schema)
        self.rows, self.held = [], 0
        return out


def chunked(pages: DataFrame, size: int = CHUNK, packed: bool = False) -> DataFrame:
    """The chunk table of ``pages`` (page_id, url, html): payloads are the html
    in UTF-8. A null or empty one is a single empty chunk. ``packed`` chunks are
    deflated, each on its own, for the way to the archives."""

    def run(batches):
        out = _Rows(["record", "page_id", "url", "chunk", "last", "upto", "digest", "payload"],
                    [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.bool_(), pa.int64(), pa.string(), pa.binary()])
        for b in batches:
            payloads = b.column(3).cast(pa.binary())
            for i, (record, page, url) in enumerate(zip(*(c.to_pylist() for c in b.columns[:3]))):
                view = memoryview(payloads[i].as_buffer() if payloads[i].is_valid else b"")
                digest = hashlib.sha256()
                for no, lo in enumerate(range(0, max(1, len(view)), size)):
                    part = view[lo:lo + size]
                    digest.update(part)
                    full = out.add((record, page, url, no, lo + size >= len(view), lo + len(part),
                                    digest.hexdigest(), zlib.compress(part, LEVEL) if packed else bytes(part)), len(part))
                    if full:
                        yield full
        yield out.flush()

    numbered = pages.select(F.monotonically_increasing_id().alias("record"), F.col("page_id").cast("long"),
                            F.col("url").cast("string"), F.col("html").cast("string"))
    return numbered.mapInArrow(run, CHUNKS)


def decided(chunks: DataFrame, least: int = LEAST) -> DataFrame:
    """(record, page_id, url, payload_bytes, payload_digest, first): one row a
    record; ``first`` is the record and page that it revisits, null for a
    response. Of equal payloads the smallest page_id is the response, a record
    without page_id only where no other has one, and of several records of
    that page the first."""
    whole = chunks.where("last").select("record", "page_id", "url", F.col("upto").alias("payload_bytes"),
                                        F.col("digest").alias("payload_digest"))
    rank = F.struct(F.col("page_id").isNull().alias("keyless"), "page_id", "record")
    first = (whole.where(F.col("payload_bytes") >= least).groupBy("payload_digest")
             .agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).drop("n"))
    return whole.join(first, "payload_digest", "left").withColumn(
        "first", F.when(F.col("first.record") != F.col("record"), F.struct("first.record", "first.page_id")))


def _uri(archive: str, record: int) -> str:
    return uuid.uuid5(uuid.NAMESPACE_URL, f"{archive}/{record}").urn


def _header(archive: str, row: dict) -> tuple[bytes, bytes]:
    """WARC header, and the HTTP header that opens the block."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {row['payload_bytes']}\r\n\r\n").encode()
    length = len(http) + (0 if row["first"] else row["payload_bytes"])
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if row['first'] else 'response'}",
             f"WARC-Record-ID: <{_uri(archive, row['record'])}>", f"WARC-Date: {DATE}"]
    if row["url"] is not None:
        # no line end may enter a header
        lines.append("WARC-Target-URI: " + row["url"].replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    if row["page_id"] is not None:
        lines.append(f"X-Page-ID: {row['page_id']}")
    lines.append(f"WARC-Payload-Digest: sha256:{row['payload_digest']}")
    if row["first"]:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{_uri(archive, row['first']['record'])}>"]
        if row["first"]["page_id"] is not None:
            lines.append(f"X-Refers-To-Page-ID: {row['first']['page_id']}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {length}", "", ""]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass"), http


def write_warc(pages: DataFrame, path: str, least: int = LEAST, size: int = CHUNK) -> DataFrame:
    """Write a record for every row of ``pages`` into gzip archives below the
    shared folder ``path`` and return their manifest (file, records, bytes).
    An empty table gives no archives."""
    with common.temporary(chunked(pages, size, packed=True), "chunks") as chunks:
        heads = decided(chunks, least).select(
            "record", F.lit(-1).alias("chunk"), F.lit(None).cast("binary").alias("payload"),
            F.struct("record", "page_id", "url", "payload_bytes", "payload_digest", "first").alias("head"))
        bodies = chunks.select("record", "chunk", "payload").withColumn("head", F.lit(None).cast(heads.schema["head"].dataType))
        rows = heads.unionByName(bodies).repartition("record").sortWithinPartitions("record", "chunk")
        archive = path.rstrip("/").rsplit("/", 1)[-1]

        def run(batches):
            out, name, written, records, pack, skip = None, None, 0, 0, None, False
            done = []

            def put(data):
                nonlocal written
                written += out.write(data) if data else 0

            def end_record():
                if pack is not None:
                    put(pack.compress(b"\r\n\r\n") + pack.flush())

            def end_file():
                if out is not None:
                    out.close()
                    done.append((name, records, written))

            for b in batches:
                for record, payload, head in zip(b.column("record").to_pylist(), b.column("payload"), b.column("head")):
                    if head.is_valid:
                        end_record()
                        if out is None or written >= ARCHIVE:
                            end_file()
                            name = f"{path.rstrip('/')}/{uuid.uuid4().hex}.warc.gz"
                            out, written, records = common.open_write(name), 0, 0
                        row = head.as_py()
                        pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                        for part in _header(archive, row):
                            put(pack.compress(part))
                        records, skip = records + 1, bool(row["first"])
                    elif not skip:
                        put(pack.compress(zlib.decompress(payload.as_buffer())))
            end_record()
            end_file()
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], t) for i, t in
                                              enumerate([pa.string(), pa.int64(), pa.int64()])],
                                             ["file", "records", "bytes"])

        return common.written(rows.mapInArrow(run, "file string, records long, bytes long"), "manifest")


def _headers(stream) -> dict[str, str]:
    found = {}
    while (line := stream.readline()) not in (b"\r\n", b""):
        name, _, value = line.decode("utf-8", "surrogatepass").partition(":")
        found[name.strip().lower()] = value.strip()
    return found


def records(stream, size: int = CHUNK):
    """Chunk rows (the columns of ``RECORDS``) of an open archive, at most
    ``size`` bytes each; a payload that does not have its digest raises."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record starts with {line[:20]!r}")
        h = _headers(stream)
        left = int(h["content-length"])
        http = 0
        length = None
        while True:
            line = stream.readline()
            http += len(line)
            if line.lower().startswith(b"content-length:"):
                length = int(line.split(b":")[1])
            if line in (b"\r\n", b""):
                break
        left -= http
        want = h["warc-payload-digest"].removeprefix("sha256:")
        page, target = h.get("x-page-id"), h.get("x-refers-to-page-id")
        url = h.get("warc-target-uri")
        if url is not None:
            url = url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
        about = (h["warc-record-id"].strip("<>"), h["warc-type"], None if page is None else int(page), url,
                 h.get("warc-refers-to", "").strip("<>") or None, None if target is None else int(target), length, want)
        if h["warc-type"] == "revisit":
            yield (*about, 0, True, 0, hashlib.sha256().hexdigest(), b"")
            continue
        digest, upto, no = hashlib.sha256(), 0, 0
        while True:
            part = stream.read(min(size, left))
            if len(part) < min(size, left):
                raise ValueError(f"record {about[0]} is cut off")
            left -= len(part)
            upto += len(part)
            digest.update(part)
            if not left and (upto != length or digest.hexdigest() != want):
                raise ValueError(f"record {about[0]} does not have its digest")
            yield (*about, no, not left, upto, digest.hexdigest(), part)
            no += 1
            if not left:
                break


def read_warc(spark: SparkSession, manifest: DataFrame, payloads: bool = True, size: int = CHUNK) -> DataFrame:
    """The archives of ``manifest`` as chunk rows; without ``payloads`` one
    row a record (its last chunk, no bytes), after its digest was checked."""
    names = [f.strip().split(" ")[0] for f in RECORDS.split(",")]
    types = {"long": pa.int64(), "string": pa.string(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}

    def run(batches):
        out = _Rows(names, [types[f.strip().split(" ")[1]] for f in RECORDS.split(",")])
        for b in batches:
            for name in b.column(0).to_pylist():
                with common.open_read(name) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    for row in records(stream, size):
                        if payloads or row[9]:
                            full = out.add(row if payloads else (*row[:-1], None), len(row[-1]) if payloads else 0)
                            if full:
                                yield full
        yield out.flush()

    # a task an archive
    return manifest.select("file").repartition(max(1, manifest.count())).mapInArrow(run, RECORDS)
