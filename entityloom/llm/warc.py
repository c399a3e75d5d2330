"""WARC archives of gzip members, written by tasks and read back by byte ranges.

Every record is one gzip member. A reading task gets a byte range of a file,
scans it for the gzip magic, and takes a candidate for a member only if the
bytes from there on inflate to a WARC header. It owns the records that start
inside its range and reads beyond the end of the range to finish the last one;
after a record it goes on at the byte behind it, so the inside of a known
member is never searched.

A file is opened by ``pyarrow.fs`` from its address, so any store with such an
address will do. A repeated task writes a file with another name; only the
files named in the manifest, which holds one row per file of a task that
succeeded, belong to the archive.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityloom.llm.common import ship_package, stored

MAGIC = b"\x1f\x8b\x08"
RANGE_BYTES = 16 * 1024 * 1024
FILE_BYTES = 1 << 30
_BLOCK = 1 << 18
# Inflated bytes that are looked at first; a longer header is read on.
_HEADER_BYTES = 1 << 16
_URN = "urn:x-record:"


def _store(address: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(address.replace("s3a://", "s3://", 1))


def record_bytes(record_id: str | None, url: str | None, payload: bytes, digest: str, revisit: bool, refers_to: str | None) -> bytes:
    """One gzip member with a response or revisit record."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    urn = lambda x: f"<{_URN}{'' if x is None else '=' + quote(x, safe='')}>"
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {urn(record_id)}", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {urn(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + squeeze.flush()


def mark_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 100) -> DataFrame:
    """``id, url, payload, digest, refers_to`` of every row.

    Of rows with equal payloads of at least ``least_bytes`` those with the
    smallest id are responses, all others refer to it. Ids that are missing
    come after all others. Rows repeated with the smallest id are all
    responses.
    """
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload")).withColumn(
        "digest", F.sha2("payload", 256)
    )
    long = rows.filter(F.octet_length("payload") >= least_bytes)
    found = stored(long.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1"))
    # both sides come from storage, so adaptive execution can split what meets a hot digest
    joined = rows.join(found.select("digest", "first"), "digest", "left")
    same = F.col("id").eqNullSafe(F.col("first")) | (F.octet_length("payload") < least_bytes)
    return joined.select("id", "url", "payload", "digest", F.when(~same, F.col("first")).alias("refers_to"))


def write_archive(records: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write rows of ``mark_revisits`` below ``folder``; returns the stored manifest ``path, bytes, records``.

    One task writes the rows of one partition, a record at a time, and starts
    a new file when one has ``file_bytes``. No rows give no files.
    """
    ship_package(records.sparkSession)
    store, place = _store(folder)
    store.create_dir(place, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = _store(folder)
        out, name, written, count = None, "", 0, 0
        files: list[tuple[str, int, int]] = []
        for batch in batches:
            for row in range(batch.num_rows):
                record, url, payload, digest, refers, revisit = (c[row].as_py() for c in batch.columns)
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, written, count = store.open_output_stream(f"{place}/{name}", compression=None), 0, 0
                member = record_bytes(record, url, payload, digest, revisit, refers)
                out.write(member)
                written, count = written + len(member), count + 1
                if written >= file_bytes:
                    out.close()
                    files.append((f"{folder}/{name}", written, count))
                    out = None
        if out is not None:
            out.close()
            files.append((f"{folder}/{name}", written, count))
        if files:
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in files]), pa.array([f[1] for f in files], pa.int64()), pa.array([f[2] for f in files], pa.int64())],
                ["path", "bytes", "records"],
            )

    rows = records.select(
        F.col("id").cast("string"), "url", "payload", "digest", F.col("refers_to").cast("string"),
        (F.col("refers_to").isNotNull()).alias("revisit"),
    )
    return stored(rows.mapInArrow(run, "path string, bytes bigint, records bigint"))


def archive_files(spark, folder: str) -> DataFrame:
    """``path, bytes`` of the archives below a folder of any origin; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.warc.gz").load(folder)
    return files.select("path", F.col("length").alias("bytes"))


class _Member:
    """Inflates one gzip member of an open file."""

    def __init__(self, file, start: int, size: int):
        self._file, self._place, self._size = file, start, size
        self._inflate = zlib.decompressobj(31)
        self.truncated = False

    def read(self, least: int | None) -> bytes:
        """At least ``least`` bytes more, or all to the end of the member (also if fewer are left)."""
        parts, got = [], 0
        while not self._inflate.eof and (least is None or got < least):
            self._file.seek(self._place)
            data = self._file.read(min(_BLOCK, self._size - self._place))  # empty at the end: what was held back comes
            if least is not None:
                part = self._inflate.decompress(data, least - got)
                rest = self._inflate.unconsumed_tail or self._inflate.unused_data
            else:
                part = self._inflate.decompress(data)
                rest = self._inflate.unused_data
            self._place += len(data) - len(rest)
            if not data and not part and not self._inflate.eof:
                self.truncated = True  # the file ends inside the member
                break
            parts.append(part)
            got += len(part)
        return b"".join(parts)

    @property
    def end(self) -> int:
        return self._place


def _start_of_record(file, start: int, size: int) -> tuple[_Member, bytes] | None:
    """The member at a candidate place and the first bytes of it, if it begins with a WARC header.

    A header may have any length: what starts like one is read on until its
    blank line or the end of the member.
    """
    member = _Member(file, start, size)
    try:
        head = bytearray(member.read(_HEADER_BYTES))
        if not head.startswith(b"WARC/1."):
            return None
        searched = 0
        while head.find(b"\r\n\r\n", searched) < 0:
            searched = max(0, len(head) - 3)
            more = member.read(_BLOCK)
            if not more:
                return None
            head += more
    except zlib.error:
        return None
    return member, bytes(head)


def _candidates(file, start: int, end: int, size: int) -> Iterator[int]:
    """Places of the gzip magic in ``[start, end)``."""
    place = start
    while place < end:
        file.seek(place)
        data = file.read(min(_BLOCK, size - place))
        at = data.find(MAGIC)
        while at >= 0 and place + at < end:
            yield place + at
            at = data.find(MAGIC, at + 1)
        if place + len(data) >= size or len(data) <= len(MAGIC):
            return
        place += len(data) - len(MAGIC) + 1


def records_of_range(file, start: int, end: int, size: int) -> Iterator[tuple[bytes, bool]]:
    """The inflated records that start in ``[start, end)``, and whether the file ends or breaks inside them."""
    place = start
    while place < end:
        found = None
        for candidate in _candidates(file, place, end, size):
            found = _start_of_record(file, candidate, size)
            if found:
                break
        if not found:
            return
        member, head = found
        try:
            record = head + member.read(None)
        except zlib.error:
            # broken data: what was read first stands, and the next record is searched behind its beginning
            yield head, True
            place = candidate + len(MAGIC)
            continue
        yield record, member.truncated
        place = max(member.end, candidate + len(MAGIC))


def _text(raw: bytes) -> str:
    """Header text: UTF-8, or else one character for each byte."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return raw.decode("latin-1")


def _number(raw: bytes | str | None) -> int | None:
    raw = raw.strip() if raw else raw
    return int(raw) if raw and raw.isdigit() else None


def parse_record(record: bytes, truncated: bool = False) -> dict:
    """The fields of one record; the digest is that of the payload if the record holds it.

    The payload is the body of an HTTP message where the content type is
    ``application/http``, and the whole block otherwise. A length that is missing
    or no number counts as that of the bytes there are. Names of headers are
    compared without case, and of repeated ones the last counts.
    """
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[_text(name.strip().lower())] = _text(value.strip())
    length = _number(fields.get("content-length"))
    block = rest if length is None else rest[:length]
    is_http = fields.get("content-type", "").lower().replace(" ", "").startswith("application/http")
    declared_length = None
    if is_http:
        http, _, payload = block.partition(b"\r\n\r\n")
        declared_length = next((_number(x.partition(b":")[2]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")), None)
    else:
        payload = block
    of_urn = lambda x: unquote(x.strip("<>").removeprefix(_URN)[1:]) if x and x.strip("<>").startswith(_URN) and "=" in x else x.strip("<>") if x and not x.strip("<>").startswith(_URN) else None
    revisit = fields.get("warc-type") == "revisit"
    declared = fields.get("warc-payload-digest", "").removeprefix("sha256:") or None
    return {
        "record_id": of_urn(fields.get("warc-record-id")),
        "record_type": fields.get("warc-type"),
        "target_uri": fields.get("warc-target-uri"),
        "payload": None if revisit else payload,
        "payload_bytes": declared_length if revisit else len(payload),
        "payload_digest": declared if revisit else hashlib.sha256(payload).hexdigest(),
        "declared_digest": declared,
        "refers_to": of_urn(fields.get("warc-refers-to")),
        "truncated": truncated or length is not None and len(rest) < length,
    }


_RECORD = pa.schema(
    [("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("payload", pa.binary()),
     ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("declared_digest", pa.string()), ("refers_to", pa.string()),
     ("truncated", pa.bool_())]
)
_RECORD_SQL = (
    "record_id string, record_type string, target_uri string, payload binary, payload_bytes bigint, payload_digest string, "
    "declared_digest string, refers_to string, truncated boolean"
)


def read_archive(files: DataFrame, range_bytes: int = RANGE_BYTES, with_payload: bool = True) -> DataFrame:
    """All records of the files ``path, bytes``, one row each.

    Every byte range of every file is a task's work of its own, so one large
    file is read by many tasks. ``with_payload=False`` leaves the payload out
    after its digest and length are taken. Files of 0 bytes give no rows;
    bytes between members that are no record are passed over. A record whose
    header is whole, but not what follows, is a row with ``truncated``, its
    digest and length those of the bytes there are; what ends inside its header
    is no record. Records of any type and content are rows, see ``parse_record``.
    """
    ship_package(files.sparkSession)
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("bytes") - 1, F.lit(range_bytes).cast("bigint")))
    ranges = stored(files.filter("bytes > 0").select("path", "bytes", starts.alias("start")))
    # ranges are tiny rows but much work: a task for each, where a number that is not named would be coalesced by bytes
    ranges = ranges.repartition(max(1, ranges.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, start in zip(*[c.to_pylist() for c in batch.columns]):
                store, place = _store(path)
                rows, held = [], 0
                with store.open_input_file(place) as file:
                    for record, truncated in records_of_range(file, start, min(start + range_bytes, size), size):
                        row = parse_record(record, truncated)
                        if not with_payload:
                            row["payload"] = None
                        rows.append(row)
                        held += len(record) if with_payload else 300 + len(row["target_uri"] or "")
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, _RECORD)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _RECORD)

    return ranges.mapInArrow(run, _RECORD_SQL)
