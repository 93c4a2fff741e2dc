"""WARC archives: written whole, then normalised to one gzip member per record.

Many archives are a single gzip stream, of which no record can be read without all
before it. The normaliser inflates such a stream once, front to back, writes every
record again as a member of its own, and writes a sidecar index with each member's
offset, so records can be read alone and files be split.

Tasks write files of their own names below a shared folder; the table of files that
a job returns is what counts, so files of a lost or repeated task are never read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.scratch import materialise, scratch_path

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP = 31  # window bits that ask zlib for gzip members
FILE_BYTES = 64 << 20  # of payload in an archive
CHUNK = 1 << 18
# archives that one task normalises, once every core has one
TASK_FILES = 16
# payloads of fewer bytes are always written in full
LEAST_REVISIT = 1000


def _id(page) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def _header_value(text: str) -> str:
    """Text that cannot end a header line."""
    return "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in text)


def record(page, url: str | None, payload: bytes, sha1: str, refers_to, revisit: bool) -> bytes:
    """A response with its payload, or a revisit that names the record with the same."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_id(page)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"Content-Type: application/http; msgtype=response\r\nContent-Length: {len(block)}",
    ]
    if url is not None:
        lines.insert(4, f"WARC-Target-URI: {_header_value(url)}")
    if revisit:
        lines[-1:] = [f"WARC-Refers-To: {_id(refers_to)}", f"WARC-Profile: {PROFILE}", lines[-1]]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers(block: bytes) -> dict[str, str]:
    """Header fields by lower-case name; the first line is left out."""
    lines = block.decode().split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines if x)}


# --- writing -----------------------------------------------------------------


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Archives of about ``FILE_BYTES``, each one gzip stream; returns their paths.

    ``pages`` has ``page, url, payload, sha1, refers_to, revisit``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        sink = stream = None
        path, size, count = "", 0, 0

        def closed() -> pa.RecordBatch:
            sink.write(stream.flush())
            sink.close()
            return pa.RecordBatch.from_pydict({"path": [path], "records": [count]})

        for batch in batches:
            for row in batch.to_pylist():
                if sink is None:
                    path, size, count = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    sink = store.open_output_stream(path, compression=None)
                    stream = zlib.compressobj(1, zlib.DEFLATED, GZIP)
                sink.write(stream.compress(record(**row)))
                size, count = size + len(row["payload"]), count + 1
                if size >= FILE_BYTES:
                    yield closed()
                    sink = None
        if sink is not None:
            yield closed()

    columns = ("page", "url", "payload", "sha1", "refers_to", "revisit")
    return pages.select(*columns).mapInArrow(run, "path string, records bigint")


# --- normalising -------------------------------------------------------------


class Inflated:
    """A gzip file of one or many members as one stream of bytes, read once.

    What is held grows at its end and is cut at its front, so a record of any length
    is copied once; at most ``CHUNK`` bytes are inflated at a time.
    """

    def __init__(self, source: BinaryIO):
        self.source, self.held = source, bytearray()
        self.inflater, self.waiting = zlib.decompressobj(GZIP), b""

    def _more(self) -> bool:
        data = self.waiting or self.source.read(CHUNK)
        if self.inflater.eof:
            if not data:
                return False
            self.inflater = zlib.decompressobj(GZIP)
        elif not data:
            raise EOFError("the gzip stream ends inside a member")
        self.held += self.inflater.decompress(data, CHUNK)
        ended = self.inflater.eof
        self.waiting = self.inflater.unused_data if ended else self.inflater.unconsumed_tail
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to and with ``mark``; None at the end of the stream."""
        searched = 0
        while (found := self.held.find(mark, searched)) < 0:
            searched = max(0, len(self.held) - len(mark) + 1)
            if not self._more():
                if self.held.strip():
                    raise EOFError("the stream ends inside a record")
                return None
        return self.take(found + len(mark))

    def take(self, size: int) -> bytes:
        while len(self.held) < size:
            if not self._more():
                raise EOFError("the stream ends inside a record")
        taken = bytes(memoryview(self.held)[:size])
        del self.held[:size]
        return taken


def records(source: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and all bytes of every record of a gzip stream."""
    stream = Inflated(source)
    while (head := stream.until(b"\r\n\r\n")) is not None:
        fields = headers(head)
        yield fields, head + stream.take(int(fields["content-length"]) + 4)


def normalise(files: DataFrame, folder: str) -> DataFrame:
    """Rewrite archives with a member per record and a sidecar index beside each.

    Returns the index: ``path, offset, length, record_id, record_type``.
    """
    names = ["path", "offset", "length", "record_id", "record_type"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        for batch in batches:
            for old in batch.column(0).to_pylist():
                path, rows, at = f"{root}/{uuid.uuid4().hex}.warc.gz", [], 0
                source = store.open_input_stream(old, compression=None)
                with source, store.open_output_stream(path, compression=None) as sink:
                    for fields, whole in records(source):
                        packer = zlib.compressobj(4, zlib.DEFLATED, GZIP)
                        member = packer.compress(whole) + packer.flush()
                        sink.write(member)
                        rows.append((path, at, len(member), fields["warc-record-id"], fields["warc-type"]))
                        at += len(member)
                with store.open_output_stream(f"{path}.idx") as index:
                    index.write("".join("%d %d %s %s\n" % row[1:] for row in rows).encode())
                columns = list(zip(*rows)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    count, cores = files.count(), files.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(count, cores), -(-count // TASK_FILES))
    spread = files.select("path").repartition(tasks)
    schema = "path string, offset bigint, length bigint, record_id string, record_type string"
    return spread.mapInArrow(run, schema)


# --- reading -----------------------------------------------------------------


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """Every record of an index over files of ``folder``, read alone at its offset.

    Returns ``record_id, record_type, refers_to, payload_bytes, payload_digest``;
    the last two are of the full payload, which a revisit names and does not hold.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = fs.FileSystem.from_uri(folder)[0]
        path, source = None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["path"] != path:
                    path, source = row["path"], store.open_input_file(row["path"])
                member = source.read_at(row["length"], row["offset"])
                out.append(_read(zlib.decompress(member, GZIP)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    names = ["record_id", "record_type", "refers_to", "payload_bytes", "payload_digest"]
    types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()]
    return index.mapInArrow(
        run,
        "record_id string, record_type string, refers_to string, payload_bytes bigint, payload_digest string",
    )


def _read(whole: bytes) -> tuple:
    head, _, rest = whole.partition(b"\r\n\r\n")
    fields = headers(head)
    http, _, payload = rest[: int(fields["content-length"])].partition(b"\r\n\r\n")
    size = int(headers(http)["content-length"])
    named = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    if fields["warc-type"] == "response":
        if hashlib.sha1(payload).hexdigest() != named or len(payload) != size:
            raise ValueError(f"record {fields['warc-record-id']} is damaged")
    return fields["warc-record-id"], fields["warc-type"], fields.get("warc-refers-to"), size, named


# --- operator ----------------------------------------------------------------


def archive(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    body_col: str = "html",
    folder: str | None = None,
) -> DataFrame:
    """Write every page to WARC archives, normalise these, and read them back.

    Of pages with equal payloads of at least ``LEAST_REVISIT`` bytes the one with
    the largest id is written in full, and the others as revisits of it; a null id
    is smaller than any. Returns ``read_records`` of the normalised archives below
    ``folder`` (default: the shared scratch folder). A null body is an empty
    payload, a null url is left out; rows that repeat the id of the page written in
    full are written in full; an empty table writes no archive. Other columns are
    not read.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col(body_col), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).alias("page"), F.col(url_col).alias("url"), payload.alias("payload")
    ).withColumns({"sha1": F.sha1("payload"), "content": F.sha2("payload", 256)})
    repeated = (
        rows.where(F.octet_length("payload") >= LEAST_REVISIT)
        .groupBy("content")
        .agg(F.max("page").alias("refers_to"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .drop("copies")
    )
    repeated = materialise(repeated, "warc-repeated")
    marked = rows.join(repeated, "content", "left").withColumn(
        "revisit",
        F.col("refers_to").isNotNull() & ~F.col("page").eqNullSafe(F.col("refers_to")),
    )
    whole = scratch_path(spark, "warc-whole")
    folder = folder or scratch_path(spark, "warc")
    files = materialise(write_archives(marked, whole), "warc-files")
    index = materialise(normalise(files, folder), "warc-index")
    return read_records(index, folder)
