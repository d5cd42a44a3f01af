"""WARC archives: one gzip member per record, written by partition and read record by record.

Equal payloads of at least `MIN_REVISIT` bytes are written once: the row with the largest key is
the response, the others are revisits that refer to it. A null payload counts as empty. Rows with
a null key are never the largest; repeated rows with the largest key are all responses. A null
URL gives a record without target URI. Extra columns are ignored.

Writers name their files at random and report them in a manifest that Spark commits, so files of
lost or repeated attempts are never read. The reader decompresses a few hundred kilobytes at a
time, frames records by Content-Length and checks block and payload digests.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.context import shared_folder

from .common import map_batches, record, stored

MIN_REVISIT = 1000
#: A file is closed and the next one begun beyond this size.
FILE_BYTES = 256 << 20
_READ = 1 << 18
_DATE = "1970-01-01T00:00:00Z"
_PREFIX = "urn:page:"
_SAME = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_MANIFEST = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
RECORDS = pa.schema(
    [
        ("record_key", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.string()),
        ("payload", pa.binary()),
    ]
)


class DamagedArchive(ValueError):
    """Framing or digest of a record is wrong."""


def assign(pages: DataFrame, key: str = "page_id", payload: str = "html", url: str = "url") -> DataFrame:
    """(key, uri, payload, keeper): keeper is the response's key where the payload is shared."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("uri"), body.alias("payload"))
    rows = rows.withColumn("same", F.sha2("payload", 256))
    shared = (
        rows.filter(F.length("payload") >= MIN_REVISIT)
        .groupBy("same")
        .agg(F.max("key").alias("keeper"), F.count("*").alias("copies"))
        .filter("copies > 1")
        .select("same", "keeper")
    )
    return rows.join(shared, "same", "left").drop("same")


def _sha1(data: bytes) -> bytes:
    return hashlib.sha1(data).digest()


def _header(text: str) -> str:
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def pack(key, uri, payload: bytes, keeper, date: str = _DATE) -> bytes:
    """The gzip member of one row."""
    revisit = keeper is not None and key != keeper
    name = "" if key is None else key
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    digest = {k: base64.b32encode(_sha1(v)).decode() for k, v in (("Block", block), ("Payload", payload))}
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{_PREFIX}{_header(str(name))}>",
        f"WARC-Date: {date}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Block-Digest: sha1:{digest['Block']}",
        f"WARC-Payload-Digest: sha1:{digest['Payload']}",
        f"Content-Length: {len(block)}",
    ]
    if uri is not None:
        lines.insert(3, f"WARC-Target-URI: {_header(uri)}")
    if revisit:
        lines += [f"WARC-Profile: {_SAME}", f"WARC-Refers-To: <{_PREFIX}{_header(str(keeper))}>"]
    whole = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    gz = zlib.compressobj(6, zlib.DEFLATED, 31)
    return gz.compress(whole) + gz.flush()


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        out, name, count, size = None, "", 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                columns = [c.to_pylist() for c in batch.slice(at, 64).columns]
                for key, uri, payload, keeper in zip(*columns):
                    if out is None:
                        name, count, size = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, 0
                        out = store.open_output_stream(name, compression=None)
                    member = pack(key, uri, payload, keeper)
                    out.write(member)
                    count, size = count + 1, size + len(member)
                    if size >= FILE_BYTES:
                        out.close()
                        out = None
                        yield record(_MANIFEST, [name], [count], [size])
        if out is not None:
            out.close()
            yield record(_MANIFEST, [name], [count], [size])

    return run


def write(pages: DataFrame, folder: str | None = None, key: str = "page_id") -> tuple[str, DataFrame]:
    """Write archives below `folder` (a new shared one by default); returns it and the manifest."""
    folder = folder or f"{shared_folder(pages.sparkSession)}/llm/warc-{uuid.uuid4().hex}"
    rows = assign(pages, key).select("key", "uri", "payload", "keeper")
    return folder, stored(map_batches(rows, _write(folder), "path string, records long, bytes long"), "warc-manifest")


class _Stream:
    """Bytes of one gzip member at a time, decompressed as they are asked for."""

    def __init__(self, source):
        self.source, self.packed, self.plain = source, b"", bytearray()
        self.member = None

    def next_member(self) -> bool:
        if self.plain:
            raise DamagedArchive("a gzip member holds more than one record")
        if not self.packed:
            self.packed = self.source.read(_READ)
        self.member = zlib.decompressobj(31) if self.packed else None
        return self.member is not None

    def _more(self) -> bool:
        if self.member.eof:
            return False
        if not self.packed:
            self.packed = self.source.read(_READ)
            if not self.packed:
                raise DamagedArchive("the archive ends inside a record")
        try:
            self.plain += self.member.decompress(self.packed, _READ)
        except zlib.error as e:
            raise DamagedArchive(f"not a gzip member: {e}") from e
        self.packed = self.member.unused_data if self.member.eof else self.member.unconsumed_tail
        return True

    def until(self, mark: bytes) -> bytes:
        seen = 0
        while (at := self.plain.find(mark, seen)) < 0:
            seen = max(0, len(self.plain) - len(mark))
            if not self._more():
                raise DamagedArchive("a record has no end of header")
        return self.take(at + len(mark))

    def take(self, n: int) -> bytes:
        while len(self.plain) < n:
            if not self._more():
                raise DamagedArchive("a record is shorter than its Content-Length")
        out = bytes(self.plain[:n])
        del self.plain[:n]
        return out

    def finish(self) -> None:
        while self._more():
            pass


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise DamagedArchive("a record does not begin with its version")
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def _check(fields: dict[str, str], name: str, data: bytes) -> str:
    kind, _, digest = fields.get(name, "").partition(":")
    if kind != "sha1" or base64.b32decode(digest) != _sha1(data):
        raise DamagedArchive(f"{name} of {fields.get('warc-record-id')} is wrong")
    return _sha1(data).hex()


def _key(field: str | None) -> str | None:
    return None if field is None else field.strip("<>").removeprefix(_PREFIX) or None


def records(source) -> Iterator[tuple]:
    """Each record of an open archive, in order, as a row of `RECORDS`."""
    stream = _Stream(source)
    while stream.next_member():
        fields = _fields(stream.until(b"\r\n\r\n"))
        block = stream.take(int(fields["content-length"]))
        if stream.take(4) != b"\r\n\r\n":
            raise DamagedArchive("a record does not end where its Content-Length says")
        stream.finish()
        _check(fields, "warc-block-digest", block)
        http, _, payload = block.partition(b"\r\n\r\n")
        named = {k.lower(): v for k, _, v in (x.partition(b": ") for x in http.split(b"\r\n")[1:])}
        size, kind = int(named[b"content-length"]), fields["warc-type"]
        if kind == "revisit":
            digest, payload = base64.b32decode(fields["warc-payload-digest"].partition(":")[2]).hex(), None
        else:
            digest = _check(fields, "warc-payload-digest", payload)
            if size != len(payload):
                raise DamagedArchive("the payload is not as long as its HTTP header says")
        refers = _key(fields.get("warc-refers-to"))
        yield _key(fields["warc-record-id"]), kind, fields.get("warc-target-uri"), size, digest, refers, payload


def _read(folder: str, payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, size = [], 0
                with store.open_input_stream(path, compression=None) as source:
                    for row in records(source):
                        rows.append(row if payloads else (*row[:-1], None))
                        size += 200 + len(row[-1] or b"") * payloads
                        if size > 1 << 22:
                            yield record(RECORDS, *zip(*rows))
                            rows, size = [], 0
                if rows:
                    yield record(RECORDS, *zip(*rows))

    return run


def read(spark: SparkSession, folder: str, manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """Every record of the archives in `manifest`; a damaged one stops the read."""
    files = manifest.count()
    spread = manifest.select("path").repartition(max(1, files))
    return map_batches(
        spread, _read(folder, payloads),
        "record_key string, record_type string, target_uri string, payload_bytes long, "
        "payload_digest string, refers_to string, payload binary",
    )
