"""WARC archives: written with one gzip member a record, equal payloads as revisits, and read back one record after another.

Writing: payload digests are taken where the pages lie. A payload that occurs more than once has its smallest page_id as
response; the other pages look this up by digest, narrow rows spread over tasks where one payload is frequent. Pages then
meet their look-up by page_id and digest, and each task turns its pages into records.

Spark's text writer puts the records into files, so any file system that Spark writes to will do. Its line separator is a
zero byte, and a record's row leaves that byte out: a gzip member ends with the size of its content, whose last byte is
zero below 16 MB. A larger record is followed by an empty member, which ends so too. The files are plain WARC archives.

Reading: a member is decompressed in small pieces. The record's header ends at an empty line, its block has the announced
number of bytes, two line ends follow, and then the member must end. Digests are summed as the pieces go by, so that a
record of any size takes little memory unless its payload is wanted.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilcount.operators.skew import heavy_rows, spread_join
from veilcount.session import new_work_folder

#: Fixed values of the format.
VERSION, END = b"WARC/1.1", b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes of compressed data that are decompressed at once, and the most that a header may have.
PIECE, MOST_HEADER = 1 << 16, 1 << 20
#: Records in a file, besides the bound that the size of a task sets.
RECORDS_PER_FILE = 20_000
DATE = "2024-01-01T00:00:00Z"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_id(page_id: int | None, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{payload_digest}')}>"


def _header_text(url: str) -> str:
    """A url as a header value: control characters and blanks are percent-encoded."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """One record: a response with the payload, or a revisit of the page `refers_to` without it."""
    payload_digest = base32(hashlib.sha1(payload).digest())
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id, payload_digest)),
        ("WARC-Date", date),
        ("WARC-Block-Digest", f"sha1:{base32(hashlib.sha1(block).digest())}"),
        ("WARC-Payload-Digest", f"sha1:{payload_digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", _header_text(url)))
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, payload_digest)), ("X-Refers-To-Page-ID", str(refers_to))]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields).encode()
    return VERSION + b"\r\n" + head + b"\r\n" + block + END


def member(content: bytes) -> bytes:
    """A gzip member; it ends in a zero byte, if need be that of an empty member behind it."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    packed = packer.compress(content) + packer.flush()
    return packed if packed[-1] == 0 else packed + member(b"")


def _pieces(archive: bytes) -> Iterator[tuple[bytes, bool]]:
    """Decompressed pieces of an archive, with whether a member ends there."""
    view, at = memoryview(archive), 0
    while at < len(view):
        unpacker = zlib.decompressobj(31)
        pending = b""
        while not unpacker.eof:
            if not pending:
                pending = bytes(view[at : at + PIECE])
                at += len(pending)
            piece = unpacker.decompress(pending, PIECE)
            if not (pending or piece or unpacker.eof):
                raise ValueError("the archive ends inside a member")
            pending = unpacker.unconsumed_tail
            yield piece, unpacker.eof
        at -= len(unpacker.unused_data)


class _Sums:
    """A block that goes by: its digest, and that of what follows the HTTP header."""

    def __init__(self, keep: bool):
        self.block, self.payload = hashlib.sha1(), hashlib.sha1()
        self.head, self.in_payload, self.size = b"", False, 0
        self.kept = [] if keep else None

    def add(self, piece: bytes) -> None:
        self.block.update(piece)
        if not self.in_payload:
            self.head += piece
            end = self.head.find(END)
            if end < 0:
                if len(self.head) > MOST_HEADER:
                    raise ValueError("an HTTP header does not end")
                return
            self.in_payload, piece = True, self.head[end + len(END) :]
            self.head = self.head[:end]
        self.payload.update(piece)
        self.size += len(piece)
        if self.kept is not None:
            self.kept.append(piece)


def _fields(header: bytes) -> dict[str, str]:
    """Names in lower case and values of header lines behind the first."""
    found = {}
    for line in header.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError(f"a header line without a name: {line[:80]!r}")
        found[name.decode().strip().lower()] = value.decode().strip()
    return found


def read_records(archive: bytes, keep: bool = False) -> Iterator[tuple[dict[str, str], _Sums]]:
    """Header fields and sums of each record of an archive, in order. Empty members are passed over.

    An archive that ends early, a block of another length than announced, and a member that does not end behind its record
    raise a ValueError.
    """
    buffer, fields, sums, left = b"", None, None, 0
    for piece, ends in _pieces(archive):
        buffer += piece
        if fields is None:
            end = buffer.find(END)
            if end >= 0:
                if not buffer.startswith(VERSION):
                    raise ValueError(f"no record starts with {buffer[:20]!r}")
                fields, buffer, sums = _fields(buffer[:end]), buffer[end + len(END) :], _Sums(keep)
                left = int(fields["content-length"])
            elif len(buffer) > MOST_HEADER:
                raise ValueError("a record's header does not end")
        if fields is not None and left:
            sums.add(buffer[:left])
            buffer, left = buffer[left:], max(0, left - len(buffer))
        if ends:
            if fields is None and not buffer:
                continue
            if fields is None or left or buffer != END:
                raise ValueError("a member does not end with its record")
            yield fields, sums
            buffer, fields = b"", None


def _int_or_none(value: str | None) -> int | None:
    return None if value is None else int(value)


def described(fields: dict[str, str], sums: _Sums) -> dict:
    """A record as a row. A revisit's payload figures are those it announces; a response's are those that were read."""
    announced = fields["warc-payload-digest"].partition(":")[2]
    http = _fields(sums.head)
    read = base32(sums.payload.digest())
    is_response = fields["warc-type"] == "response"
    size = int(http["content-length"])
    whole = fields["warc-block-digest"].partition(":")[2] == base32(sums.block.digest())
    return {
        "page_id": _int_or_none(fields.get("x-page-id")),
        "url": fields.get("warc-target-uri"),
        "payload_bytes": sums.size if is_response else size,
        "payload_digest": read if is_response else announced,
        "record_type": fields["warc-type"],
        "refers_to": _int_or_none(fields.get("x-refers-to-page-id")),
        "verified": whole and (read == announced and sums.size == size if is_response else sums.size == 0),
        "payload": b"".join(sums.kept) if sums.kept is not None and is_response else None,
    }


_ROWS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, verified boolean"


def write_archives(pages: DataFrame, folder: str, least: int = 0, date: str = DATE) -> None:
    """Pages (page_id, url, html) as archives below `folder`, one record a row. A null html is an empty payload.

    Of the pages with the same payload of at least `least` bytes the one with the smallest page_id is the response; the
    others revisit it. Rows that repeat that page_id, too, are responses with the same record id. Null page_ids are passed
    over in the search for the smallest; if there is no other, all such pages are responses. Null urls have no target.
    """
    spark = pages.sparkSession
    work = new_work_folder(spark, "warc")
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    page_id = F.col("page_id").cast("long").alias("page_id")
    known = [F.sha1(payload).alias("digest"), F.octet_length(payload).alias("bytes")]
    pages.select(page_id, *known).write.parquet(f"{work}/digests")
    digests = spark.read.parquet(f"{work}/digests")
    frequent = digests.where(F.col("bytes") >= least).groupBy("digest", "bytes").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    frequent.where("n > 1 AND first IS NOT NULL").write.parquet(f"{work}/frequent")
    frequent = spark.read.parquet(f"{work}/frequent")
    again = spread_join(digests, frequent, ["digest", "bytes"], heavy_rows(digests.count()), "page_id")
    again = again.where(~F.col("page_id").eqNullSafe(F.col("first"))).select(
        F.col("page_id").alias("of_page"), F.col("digest").alias("of_digest"), F.col("first").alias("refers_to")
    )
    rows = pages.select(page_id, F.col("url").cast("string").alias("url"), payload.alias("payload"), known[0])
    same = F.col("page_id").eqNullSafe(F.col("of_page")) & (F.col("digest") == F.col("of_digest"))
    rows = rows.join(again.distinct(), same, "left").select("page_id", "url", "payload", "refers_to")

    def packed(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                made = [
                    member(record(*row, date))[:-1]
                    for row in zip(part["page_id"].to_pylist(), part["url"].to_pylist(), part["payload"].to_pylist(), part["refers_to"].to_pylist())
                ]
                yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["value"])

    members = rows.mapInArrow(packed, "value binary").select(F.col("value").cast("string").alias("value"))
    members.write.option("lineSep", "\x00").option("maxRecordsPerFile", RECORDS_PER_FILE).text(folder)


def read_archives(spark: SparkSession, folder: str, keep_payload: bool = False) -> DataFrame:
    """The records of all archives below `folder`: page_id, url, payload_bytes, payload_digest (base32), record_type,
    refers_to, verified (the digests and lengths hold) and, if wanted, the responses' payload.

    Each file is read by one task, from its first record to its last. A damaged archive fails the run. No files, no rows.
    """
    files = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").load(folder)
    schema = _ROWS + (", payload binary" if keep_payload else "")
    names = [entry.split()[0] for entry in schema.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
    types = [kinds[entry.split()[1]] for entry in schema.split(", ")]

    def rows(batches):
        for batch in batches:
            for archive in batch["content"]:
                held = []
                for fields, sums in read_records(archive.as_buffer(), keep_payload):
                    held.append(described(fields, sums))
                    if len(held) == 256:
                        yield _batch(held)
                        held = []
                if held:
                    yield _batch(held)

    def _batch(held):
        return pa.RecordBatch.from_arrays([pa.array([row[name] for row in held], kind) for name, kind in zip(names, types)], names)

    return files.select("content").mapInArrow(rows, schema)


def report(pages: DataFrame) -> DataFrame:
    """Writes the pages as archives and reads them back; a record that does not verify fails the run."""
    folder = f"{new_work_folder(pages.sparkSession, 'archives')}"
    write_archives(pages, folder)
    read = read_archives(pages.sparkSession, folder)
    failed = F.raise_error(F.concat(F.lit("a record does not verify: "), F.coalesce(F.col("page_id").cast("string"), F.lit("null"))))
    digest = F.when(F.col("verified"), F.col("payload_digest")).otherwise(failed)
    return read.select("page_id", "payload_bytes", digest.alias("payload_digest"), "record_type", "refers_to")
