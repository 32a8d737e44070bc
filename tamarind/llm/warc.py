"""WARC archives (operator 11): writing, normalising and reading web archives.

* ``write_archives``: one WARC/1.1 record per page, in archives that are one gzip stream each
  (the monolithic kind that many tools produce). Of pages with equal payloads the one with the
  largest id is a response, the others are revisits that refer to it and hold no payload.
* ``normalise``: inflates each archive once, as a stream, rewrites every record as a gzip
  member of its own and writes a sidecar index (``.idx``: offset, length, id, type, digest of
  each record, one line each), also returned as a table.
* ``read_records``: records by the index, each from its own offset.

Archives are written by tasks into the shared scratch folder through ``pyarrow.fs`` (file, s3,
gs, hdfs) under names that no other attempt of the task uses; only files listed in the table
that Spark commits count, so a retried or lost task leaves nothing that is read. An archive is
closed at ``ARCHIVE_BYTES``; memory per task is one record and a buffer, never an archive.

Rows: a null or empty html is a record with an empty payload; a null id is written as an empty
one and read back as null, and stands below every other id; pages with the same id and payload
are all responses if that id is the largest; a null url has no target line, line breaks in one
are percent-encoded. Other columns of the input are not looked at. In ``normalise`` members
that hold several records, one or a part of one are all read alike, archives without
compression too; a cut-off or damaged archive keeps the records before the damage and is
reported (``damaged``).
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarind.llm.common import Workspace, small_batches
from tamarind.operators.joins import maybe_broadcast

ARCHIVE_BYTES = 256 << 20
#: Bytes of an archive that one group of reads covers.
READ_SPAN = 32 << 20
BUFFER = 1 << 20
DATE = "2000-01-01T00:00:00Z"
SCHEME = "urn:page:"
#: Fixed values of the format: the profile of a revisit with an equal payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

ARCHIVES = "archive string, n_records long, n_bytes long"
INDEX = ("archive string, offset long, length long, record_id string, record_type string, target string, refers_to string, "
         "payload_digest string, source string, damaged string")
RECORDS = ("record_id string, record_type string, target string, refers_to string, payload_digest string, payload_bytes long, payload binary, "
           "archive string, offset long")


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a string or binary column. The hash stands in it 32 times:
    where Spark cannot share it, as in a condition, hash first and give ``base32`` the column."""
    return base32(F.sha1(data))


def base32(digest: Column) -> Column:
    """Bare upper-case base32 of a SHA-1 in hex: 20 bits are four digits."""
    digits, out = F.lit(BASE32), []
    for i in range(8):
        bits = F.conv(F.substring(digest, 5 * i + 1, 5), 16, 10).cast("int")
        out += [F.substring(digits, F.shiftright(bits, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*out)


def _open(path: str):
    """(file system, path on it) of a path or URI."""
    return fs.FileSystem.from_uri(path if re.match(r"[a-z][\w+.-]*:", path) else f"file://{path}")


def _record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    head = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields if v is not None), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def page_record(page_id, url, payload: bytes, digest: str, refers_to, revisit: bool, date: str) -> bytes:
    """One page as a record: an HTTP response, of which a revisit holds the header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    target = None if url is None else "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in url)
    name = "" if page_id is None else page_id
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<{SCHEME}{name}>"), ("WARC-Date", date),
              ("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response"),
              ("WARC-Refers-To", f"<{SCHEME}{refers_to}>" if revisit else None), ("WARC-Profile", PROFILE if revisit else None)]
    return _record(fields, http if revisit else http + payload)


def first_copies(pages: DataFrame, ws: Workspace, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(digest, size, first): of payloads that several ids share, the largest id; one scan that reads the
    html only, and a partial maximum in each task."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    keys = pages.select(base32_sha1(html).alias("digest"), F.octet_length(html).cast("long").alias("size"), F.col(id_col).alias("id"))
    return ws.write(keys.groupBy("digest", "size").agg(F.max("id").alias("first"), F.min("id").alias("least"), F.count("id").alias("known"),
                                                       F.count(F.lit(1)).alias("n"))
                    .where("n > 1 AND first IS NOT NULL AND (first > least OR known < n)").select("digest", "size", "first"), "first_copies")


def write_archives(pages: DataFrame, folder: str, ws: Workspace, least_bytes: int = 0, date: str = DATE, archive_bytes: int = ARCHIVE_BYTES,
                   id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes the pages as monolithic archives into ``folder``; the committed list of archives.

    Payloads under ``least_bytes`` are never revisits. The lookup of shared payloads is broadcast
    only behind a check of its written size; beyond that it is a shuffle join on the digest,
    whose hot keys Spark's skew join splits.
    """
    small_batches(pages.sparkSession)
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), html.alias("html"), base32_sha1(html).alias("digest"),
                        F.octet_length(html).cast("long").alias("size"))
    shared = maybe_broadcast(first_copies(pages, ws, id_col, html_col).where(F.col("size") >= least_bytes))
    rows = rows.join(shared, ["digest", "size"], "left")
    rows = rows.select("id", "url", "html", "digest", F.col("first").cast("string").alias("refers_to"),
                       (F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))).alias("revisit"))

    def run(batches):
        out = None
        for b in batches:
            for page_id, url, text, digest, refers_to, revisit in zip(*(c.to_pylist() for c in b.columns)):
                if out is None:
                    out = _Archive(folder, "whole")
                out.add(page_record(page_id, url, text.encode(), digest, refers_to, revisit, date))
                if out.size >= archive_bytes:
                    yield _table(ARCHIVES, [out.close()])
                    out = None
        if out is not None:
            yield _table(ARCHIVES, [out.close()])

    return ws.write(rows.mapInArrow(run, ARCHIVES), f"archives-{uuid.uuid4().hex}")


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


_ARROW = {"string": pa.string(), "long": pa.int64(), "binary": pa.large_binary()}


def _table(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = [_ARROW[part.split()[1]] for part in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * len(kinds), kinds)], _names(schema))


class _Archive:
    """A new archive: one gzip stream, or a member for each record."""

    def __init__(self, folder: str, kind: str, level: int = 6):
        self.path = f"{folder}/{kind}-{uuid.uuid4().hex}.warc.gz"
        system, path = _open(self.path)
        system.create_dir(path.rpartition("/")[0])
        self.file, self.level, self.members = system.open_output_stream(path, compression=None), level, kind == "members"
        self.size = self.written = self.n = 0
        # the stream that is about to be inflated again is packed fast
        self.zip = None if self.members else zlib.compressobj(1, zlib.DEFLATED, 31)

    def add(self, record: bytes) -> tuple[int, int]:
        """(offset, length) of the record's member in the file."""
        offset, self.size, self.n = self.written, self.size + len(record), self.n + 1
        if self.members:
            z = zlib.compressobj(self.level, zlib.DEFLATED, 31)
            self._put(z.compress(record) + z.flush())
        else:
            self._put(self.zip.compress(record))
        return offset, self.written - offset

    def _put(self, data: bytes) -> None:
        self.file.write(data)
        self.written += len(data)

    def close(self) -> tuple:
        if self.zip:
            self._put(self.zip.flush())
        self.file.close()
        return self.path, self.n, self.written


class Inflated:
    """The plain bytes of a gzip file of any number of members, or of a file without compression;
    read as a stream, once."""

    def __init__(self, file):
        self.file, self.zip, self.plain = file, None, None
        self.buffer, self.over = bytearray(), False

    def _more(self) -> bool:
        data = self.file.read(BUFFER)
        if self.plain is None and data:
            self.plain = data[:2] != b"\x1f\x8b"
        if not data:
            if self.zip is not None and not self.zip.eof:
                raise ValueError("the stream ends within a member")
            return False
        while data:
            if self.plain:
                self.buffer += data
                break
            if self.zip is None or self.zip.eof:
                data = data.lstrip(b"\0") if self.zip is not None else data  # padding between members
                if not data:
                    break
                self.zip = zlib.decompressobj(31)
            self.buffer += self.zip.decompress(data)
            data = self.zip.unused_data
        return True

    def line(self) -> bytes | None:
        """Up to the next line feed; None at the end."""
        at = self.buffer.find(b"\n")
        while at < 0:
            seen = len(self.buffer)
            if not self._more():
                if self.buffer:
                    raise ValueError("the stream ends within a record")
                return None
            at = self.buffer.find(b"\n", seen)
        return self.take(at + 1)

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n:
            if not self._more():
                raise ValueError("the stream ends within a record")
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out


def records(stream: Inflated):
    """(header fields in lower case, bytes of the whole record, place of its block) of each record."""
    while (line := stream.line()) is not None:
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("no record begins here")
        head, fields = [line], {}
        while (line := stream.line()) is not None and line.strip():
            head.append(line)
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        if line is None or not fields.get("content-length", "").isdigit():
            raise ValueError("a record has no length")
        start = b"".join(head) + b"\r\n"
        yield fields, start + stream.take(int(fields["content-length"])) + b"\r\n\r\n", len(start)


def _reference(value: str | None) -> str | None:
    return None if value is None else value.strip("<>").removeprefix(SCHEME)


def normalise(archives: DataFrame, folder: str, ws: Workspace, level: int = 6) -> DataFrame:
    """Rewrites each archive of the list with a member per record and writes its sidecar index;
    the committed index of all records. One task per archive: a gzip stream has one beginning."""
    def run(batches):
        for b in batches:
            for source in b.column(0).to_pylist():
                yield from rewrite(source)

    def rewrite(source: str):
        out, rows, lines, damage = _Archive(folder, "members", level), [], [], None
        system, path = _open(source)
        side = _open(f"{out.path.removesuffix('.warc.gz')}.idx")
        try:
            with system.open_input_stream(path, compression=None) as file, side[0].open_output_stream(side[1], compression=None) as index:
                try:
                    for f, record, _ in records(Inflated(file)):
                        offset, length = out.add(record)
                        rows.append((out.path, offset, length, _reference(f.get("warc-record-id")), f.get("warc-type"), f.get("warc-target-uri"),
                                     _reference(f.get("warc-refers-to")), f.get("warc-payload-digest", "").removeprefix("sha1:") or None, source, None))
                        lines.append("\t".join(str(x if x is not None else "-") for x in rows[-1][1:8]) + "\n")
                        if len(rows) >= 1000:
                            index.write("".join(lines).encode())
                            yield _table(INDEX, rows)
                            rows, lines = [], []
                except (ValueError, zlib.error) as e:
                    damage = str(e)
                index.write("".join(lines).encode())
        finally:
            out.close()
        if damage:
            rows.append((out.path, out.written, 0, None, None, None, None, None, source, damage))
        if rows:
            yield _table(INDEX, rows)

    # a whole archive per row: dealt one by one, so that a task inflates a few at most
    n = max(1, archives.count())
    return ws.write(archives.select("archive").repartition(n, "archive").mapInArrow(run, INDEX), f"index-{uuid.uuid4().hex}")


def read_records(index: DataFrame, span: int = READ_SPAN) -> DataFrame:
    """The records that an index lists, each read from its own member. Index rows of one stretch
    of an archive go to one task; a stretch has ``span`` bytes, so work is even whatever the
    archives' sizes. ``payload_bytes`` is the length in the HTTP header, also of a revisit,
    whose ``payload`` is null."""
    rows = index.where("damaged IS NULL").select("archive", "offset", "length")
    total = rows.agg(F.sum("length").alias("s")).first().s or 0
    rows = (rows.repartition(max(index.sparkSession.sparkContext.defaultParallelism, total // span), "archive", F.floor(F.col("offset") / span))
            .sortWithinPartitions("archive", "offset"))

    def run(batches):
        path = file = None
        for b in batches:
            out, held = [], 0
            for archive, offset, length in zip(*(c.to_pylist() for c in b.columns)):
                if archive != path:
                    if file is not None:
                        file.close()
                    system, place = _open(archive)
                    path, file = archive, system.open_input_file(place)
                data = zlib.decompress(file.read_at(length, offset), 31)
                fields, record, block = next(records(Inflated(pa.BufferReader(data))))
                http, _, payload = record[block:-4].partition(b"\r\n\r\n")
                size = re.search(rb"(?im)^content-length:\s*(\d+)", http)
                kind = fields.get("warc-type")
                out.append((_reference(fields.get("warc-record-id")), kind, fields.get("warc-target-uri"), _reference(fields.get("warc-refers-to")),
                            fields.get("warc-payload-digest", "").removeprefix("sha1:") or None, int(size[1]) if size else None,
                            None if kind == "revisit" else payload, archive, offset))
                held += len(data)
                if held >= BUFFER:
                    yield _table(RECORDS, out)
                    out, held = [], 0
            if out:
                yield _table(RECORDS, out)
        if file is not None:
            file.close()

    return rows.mapInArrow(run, RECORDS)


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def archive_pages(pages: DataFrame, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES, **columns: str) -> DataFrame:
    """Pages written as monolithic archives, normalised, and read back: the records, with the
    payload's size and digest. A response's are taken from its payload as read, a revisit's from
    its record; a response whose digest differs from its record's is an error."""
    ws = Workspace(pages.sparkSession, "warc")
    whole = f"{ws.root}/whole"
    listed = write_archives(pages, whole, ws, least_bytes, archive_bytes=archive_bytes, **columns)
    index = normalise(listed, f"{ws.root}/members", ws)
    if not index.where("damaged IS NOT NULL").isEmpty():
        raise ValueError("an archive could not be read back whole")
    ws.drop("whole")  # the rewritten archives take its place
    return check_payloads(read_records(index))


def check_payloads(found: DataFrame) -> DataFrame:
    """``found`` with size and digest computed from each payload that is there, held against
    the record's own."""
    # one step each for the hash and its digits: inside the condition below each use would hash the payload again
    digests = found.withColumn("_sha1", F.sha1("payload")).withColumn("_digest", base32(F.col("_sha1")))
    size = F.octet_length("payload").cast("long")
    same = (F.col("_digest") == F.col("payload_digest")) & (size == F.col("payload_bytes"))
    damaged = F.raise_error(F.concat(F.lit("damaged payload of record "), F.coalesce("record_id", F.lit("-"))))
    checked = F.when(F.col("payload").isNull(), F.col("payload_digest")).when(same, F.col("_digest")).otherwise(damaged)
    return digests.withColumn("payload_digest", checked).drop("_sha1", "_digest")
