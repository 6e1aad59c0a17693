"""WARC archives: a writer of one gzip member per record, and a sequential reader.

The writer puts each page into a response record, or into a revisit record
when an earlier page (smaller id) has the same payload. Each task writes its
own archives under a folder that all executors share, and returns a manifest
row per finished archive; only archives of tasks that Spark committed are in
the manifest, so a retried or speculative task leaves no doubles.

The reader goes through an archive once from front to back: it inflates member
after member in bounded reads, frames the record by its header and
Content-Length, checks that the member ends with the record, and verifies
block and payload digests while the bytes pass. Memory is one record's header
and one read buffer, for payloads that are not asked for.

Defined results
    null html               empty payload; equal to other empty payloads
    null url                empty target
    null page id            written as the empty id, read as null; never referred
                            to while a page with an id has the payload
    ties, repeated rows     rows that share the smallest id are responses alike
    line ends in urls       percent-encoded (a header is one line)
    empty table             no archive, empty result
    extra columns           ignored
    damaged archive         the read fails, naming file and offset
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterable, Iterator
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievekit.llm.common import hinted, prepare_python, stage
from sievekit.session import fresh_folder

ARCHIVE_BYTES = 256 * 1024 * 1024  # a task begins another archive beyond this
READ_BYTES = 1 << 16
DATE = "1970-01-01T00:00:00Z"  # pages have no crawl time; a fixed one keeps archives reproducible
LEVEL = 6


def sha1_base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


# ---------------------------------------------------------------- writer

def http_head(length: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record as one gzip member."""
    kind = "response" if refers_to is None else "revisit"
    head = http_head(len(payload))
    block = head + payload if kind == "response" else head
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha1:{sha1_base32(hashlib.sha1(payload).digest())}"),
        ("WARC-Block-Digest", f"sha1:{sha1_base32(hashlib.sha1(block).digest())}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if kind == "revisit":
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                   ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    fields.append(("Content-Length", str(len(block))))
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return pack.compress(text.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n") + pack.flush()


def _write_task(folder: str, archive_bytes: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pa.fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        out, path, size, n = None, "", 0, 0

        def row() -> pa.RecordBatch:
            out.close()
            return pa.record_batch([[path], [n], [size]], names=["archive", "records", "bytes"])

        for b in batches:
            html = b.column("_html").cast(pa.binary())
            for page, url, payload, refers in zip(b.column("_id").to_pylist(), b.column("_url").to_pylist(),
                                                  html, b.column("_refers").to_pylist(), strict=True):
                if out is None:
                    path, size, n = posixpath.join(root, f"pages-{uuid.uuid4().hex}.warc.gz"), 0, 0
                    out = files.open_output_stream(path, compression=None)
                member = record(page, url, payload.as_py() or b"", refers)
                out.write(member)
                size, n = size + len(member), n + 1
                if size >= archive_bytes:
                    yield row()
                    out = None
        if out is not None:
            yield row()

    return run


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write every row; returns the staged manifest (archive, records, bytes).

    ``folder`` is a URI that all executors reach (``file://`` on a shared
    disk, ``hdfs://``, ``s3://``, ...)."""
    prepare_python(pages.sparkSession)
    payload = F.coalesce(F.col("_html"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("_id"), F.col(url_col).alias("_url"), F.col(html_col).alias("_html"))
    rows = rows.withColumn("_key", F.concat(F.unhex(F.sha1(payload)), F.unhex(F.md5(payload))))
    # only keys are grouped; a payload on a third of all pages is one row a task
    firsts = rows.groupBy("_key").agg(F.min("_id").alias("_first"), F.count("*").alias("n")).filter("n > 1")
    firsts = stage(firsts.select("_key", "_first"), "warc-repeated")
    rows = rows.join(hinted(firsts), "_key", "left")
    refers = F.when(~F.col("_first").eqNullSafe(F.col("_id")), F.col("_first"))
    told = rows.select("_id", "_url", "_html", refers.alias("_refers"))
    return stage(told.mapInArrow(_write_task(folder, archive_bytes), "archive string, records long, bytes long"), "warc-manifest")


# ---------------------------------------------------------------- reader

class Damaged(ValueError):
    """An archive that breaks the format or fails a digest."""


class MemberReader:
    """The inflated bytes of one gzip member after another, read in bounded steps."""

    def __init__(self, source: BinaryIO):
        self.source, self.raw, self.offset = source, b"", 0  # offset: of the first unread compressed byte
        self.buffer, self.inflate = bytearray(), None

    def next_member(self) -> bool:
        """Go to the next member; False at the end of the archive."""
        if self.inflate is not None and (self.buffer or not self._ended()):
            raise Damaged(f"bytes after the record in the member before {self.offset}")
        if not self.raw:
            self.raw = self.source.read(READ_BYTES)
        if not self.raw:
            return False
        self.inflate = zlib.decompressobj(31)
        return True

    def _ended(self) -> bool:
        while not self.inflate.eof:
            if not self._fill():
                raise Damaged(f"the archive ends within a member, at {self.offset}")
            if self.buffer:
                return False
        return True

    def _fill(self) -> bool:
        """Inflate one step into the buffer; False when the member has no more."""
        if self.inflate.eof:
            return False
        if not self.raw:
            self.raw = self.source.read(READ_BYTES)
            if not self.raw:
                raise Damaged(f"the archive ends within a member, at {self.offset}")
        try:
            self.buffer += self.inflate.decompress(self.raw, READ_BYTES)
        except zlib.error as e:
            raise Damaged(f"{e} at {self.offset}") from e
        rest = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
        self.offset += len(self.raw) - len(rest)
        self.raw = rest
        return True

    def line(self) -> bytes:
        while (end := self.buffer.find(b"\r\n")) < 0:
            if not self._fill():
                raise Damaged(f"a header line without end before {self.offset}")
        out = bytes(self.buffer[:end])
        del self.buffer[: end + 2]
        return out

    def take(self, n: int) -> Iterator[bytes]:
        """The next n bytes, in pieces."""
        while n:
            if not self.buffer and not self._fill():
                raise Damaged(f"a record shorter than its Content-Length before {self.offset}")
            piece = bytes(self.buffer[:n])
            del self.buffer[: len(piece)]
            n -= len(piece)
            if piece:
                yield piece


def _headers(reader: MemberReader) -> dict[str, str]:
    out = {}
    while line := reader.line():
        name, sep, value = line.decode("utf-8", "surrogatepass").partition(":")
        if not sep:
            raise Damaged(f"a header line without a colon before {reader.offset}")
        out[name.strip().lower()] = value.strip()
    return out


def _page(value: str | None) -> int | None:
    inner = (value or "").removeprefix("<urn:page:").removesuffix(">")
    return int(inner) if inner else None


def _split_head(pieces: Iterator[bytes]) -> tuple[bytes, Iterator[bytes]]:
    """The HTTP header of a block, and the payload's pieces."""
    head = bytearray()
    for piece in pieces:
        head += piece
        if (end := head.find(b"\r\n\r\n")) >= 0:
            rest = bytes(head[end + 4 :])

            def payload(first: bytes = rest) -> Iterator[bytes]:
                if first:
                    yield first
                yield from pieces

            return bytes(head[: end + 4]), payload()
    raise Damaged("a block without an HTTP header")


def read_records(source: BinaryIO, with_payload: bool = False) -> Iterator[dict]:
    """The records of an archive in order, each verified."""
    reader = MemberReader(source)
    while reader.next_member():
        start = reader.offset
        if reader.line() != b"WARC/1.1":
            raise Damaged(f"no WARC record at {start}")
        fields = _headers(reader)
        if not fields.get("content-length", "").isdigit():
            raise Damaged(f"no Content-Length at {start}")
        block_sha = hashlib.sha1()

        def seen(pieces: Iterator[bytes], sha=block_sha) -> Iterator[bytes]:
            for piece in pieces:
                sha.update(piece)
                yield piece

        head, pieces = _split_head(seen(reader.take(int(fields["content-length"]))))
        payload_sha, size, kept = hashlib.sha1(), 0, []
        for piece in pieces:
            payload_sha.update(piece)
            size += len(piece)
            if with_payload:
                kept.append(piece)
        if b"".join(reader.take(4)) != b"\r\n\r\n":
            raise Damaged(f"no record end after {start}")
        stated = fields.get("warc-payload-digest", "").removeprefix("sha1:")
        if fields.get("warc-block-digest", "").removeprefix("sha1:") != sha1_base32(block_sha.digest()):
            raise Damaged(f"block digest differs at {start}")
        length = next((int(v) for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")) if k.lower() == b"content-length"), None)
        kind = fields.get("warc-type")
        if kind == "response" and (stated != sha1_base32(payload_sha.digest()) or length != size):
            raise Damaged(f"payload differs from its digest or length at {start}")
        yield {"page_id": _page(fields.get("warc-record-id")), "url": fields.get("warc-target-uri", ""),
               "payload_bytes": length, "payload_digest": stated, "record_type": kind,
               "refers_to": _page(fields.get("warc-refers-to")), "offset": start,
               "payload": b"".join(kept) if with_payload and kind == "response" else None}


RECORD = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
          "offset long, payload binary")
_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                    ("record_type", pa.string()), ("refers_to", pa.int64()), ("offset", pa.int64()), ("payload", pa.binary())])


def _read_task(folder: str, with_payload: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = pa.fs.FileSystem.from_uri(folder)
        for b in batches:
            for path in b.column("archive").to_pylist():
                rows, held = [], 0
                with files.open_input_stream(path, compression=None) as source:
                    try:
                        for r in read_records(source, with_payload):
                            rows.append(r)
                            held += len(r["payload"] or b"")
                            if len(rows) >= 5000 or held > 8 * READ_BYTES * 16:
                                yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                                rows, held = [], 0
                    except Damaged as e:
                        raise Damaged(f"{path}: {e}") from e
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    return run


def read_warc(manifest: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """The verified records of the manifest's archives, one task an archive."""
    prepare_python(manifest.sparkSession)
    archives = manifest.select("archive")
    n = max(1, archives.count())
    return archives.repartition(n, "archive").mapInArrow(_read_task(folder, with_payload), RECORD)


def archive_folder(pages: DataFrame) -> str:
    """A fresh folder in the application's part of the shared folder, as a URI."""
    folder = fresh_folder(pages.sparkSession, "warc")
    return folder if "://" in folder else f"file://{folder.removeprefix('file:')}"


def check_revisits(records: DataFrame) -> None:
    """Raise if a revisit states another payload digest than the response it
    refers to, or refers to none. Equal claims are one row before they are joined."""
    claims = records.filter("record_type = 'revisit'").groupBy("refers_to", "payload_digest").agg(F.min("page_id").alias("one"))
    known = records.filter("record_type = 'response'").select(F.col("page_id").alias("refers_to"), "payload_digest")
    wrong = claims.join(known, ["refers_to", "payload_digest"], "left_anti").first()
    if wrong is not None:
        raise Damaged(f"revisit {wrong['one']} differs from record {wrong['refers_to']}")


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write all pages, read the archives back: one row per page."""
    folder = archive_folder(pages)
    manifest = write_warc(pages, folder, id_col, url_col, html_col)
    records = stage(read_warc(manifest, folder).drop("payload", "offset"), "warc-records")
    check_revisits(records)
    return records
