"""WARC archives: write, normalise and read back.

``write_monolithic`` writes one gzip stream per file, as some crawlers do: no
record can be reached without inflating all before it. ``normalise`` inflates
each such stream once, rewrites every record as a gzip member of its own and
writes a sidecar index of offsets. ``read_records`` then fetches members by
offset. Files go to the shared folder through ``pyarrow.fs`` (local or mounted
paths, HDFS, object stores). Each file has a name of its own attempt and is
listed in the step's stored output, so a lost or repeated task leaves at most
an unlisted file behind.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import json
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import batch, new_folder, small, stored, texts_of

FILE_BYTES = 256 << 20
CHUNK = 1 << 20
GZIP = 31  # zlib's window setting for a gzip wrapper
REVISIT_FROM = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_RECORDS = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                      ("record_type", pa.string()), ("refers_to", pa.int64())])
_FILES = pa.schema([("path", pa.string()), ("records", pa.int64())])


def _open(uri: str):
    return fs.FileSystem.from_uri(uri)


# ---- records ----

def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def make_record(page_id: int | None, url: str | None, payload: bytes, sha1: bytes, length: int,
                refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One uncompressed record; a revisit holds the HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}",
            f"WARC-Date: {date}",
            "WARC-Target-URI: " + urllib.parse.quote(url or "about:blank", safe="!#$%&'()*+,/:;=?@[]~"),
            "WARC-Payload-Digest: sha1:" + base64.b32encode(sha1).decode()]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page-Id: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_head(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:] if line)}


class Inflated:
    """Reads a gzip stream (of one member or several) piece by piece."""

    def __init__(self, raw):
        self.raw, self.z, self.rest, self.buf = raw, zlib.decompressobj(GZIP), b"", bytearray()

    def _more(self) -> bool:
        data = self.rest or self.raw.read(CHUNK)
        self.rest = b""
        if not data:
            return False
        if self.z.eof:
            self.z = zlib.decompressobj(GZIP)
        self.buf += self.z.decompress(data, 4 * CHUNK)
        self.rest = self.z.unused_data if self.z.eof else self.z.unconsumed_tail
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Up to and with the mark; None at the end of the stream."""
        at = 0
        while (end := self.buf.find(mark, max(0, at - len(mark)))) < 0:
            at = len(self.buf)
            if not self._more():
                if self.buf.strip():
                    raise ValueError("the stream ends inside a record's header")
                return None
        out = bytes(self.buf[:end + len(mark)])
        del self.buf[:end + len(mark)]
        return out

    def pieces(self, n: int) -> Iterator[bytes]:
        """The next n bytes, piece by piece."""
        while n:
            if not self.buf and not self._more():
                raise ValueError("the stream ends inside a record")
            out = bytes(self.buf[:n])
            del self.buf[:n]
            n -= len(out)
            if out:
                yield out


# ---- steps ----

def _packed(batches):
    """Digests of each payload, which travels deflated."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("length", pa.int64()), ("sha1", pa.binary()),
                        ("same", pa.binary()), ("packed", pa.binary())])
    for b in small(batches):
        payloads = texts_of(b.column(2))
        yield batch(schema, b.column(0), b.column(1), map(len, payloads), [hashlib.sha1(p).digest() for p in payloads],
                    [hashlib.sha256(p).digest() for p in payloads], [zlib.compress(p, 1) for p in payloads])


def decided(pages: DataFrame, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """Rows of ``pages`` with digests and, for revisits, the page referred to."""
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"),
                        F.col("html").cast("string").cast("binary")).mapInArrow(
        _packed, "page_id long, url string, length long, sha1 binary, same binary, packed binary")
    first = (rows.where(F.col("length") >= revisit_from).groupBy("same")
             .agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    # A null page_id is below all others.
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return (rows.join(first, "same", "left").withColumn("revisit", revisit)
            .select("page_id", "url", "length", "sha1", "revisit", F.when(F.col("revisit"), F.col("first")).alias("refers_to"),
                    F.when(~F.col("revisit"), F.col("packed")).alias("packed")))


def write_monolithic(rows: DataFrame, folder: str, file_bytes: int = FILE_BYTES,
                     date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write ``decided`` rows as archives of one gzip stream each; lists them."""

    def run(batches):
        out = z = path = None
        n = size = 0
        for b in small(batches):
            for r in b.to_pylist():
                if out is None:
                    store, base = _open(folder)
                    path = f"mono-{uuid.uuid4().hex}.warc.gz"
                    out, z, n, size = store.open_output_stream(f"{base}/{path}", compression=None), zlib.compressobj(6, zlib.DEFLATED, GZIP), 0, 0
                payload = b"" if r["packed"] is None else zlib.decompress(r["packed"])
                record = make_record(r["page_id"], r["url"], payload, r["sha1"], r["length"], r["refers_to"], r["revisit"], date)
                out.write(z.compress(record))
                n, size = n + 1, size + len(record)
                if size >= file_bytes:
                    out.write(z.flush())
                    out.close()
                    out = None
                    yield batch(_FILES, [path], [n])
        if out is not None:
            out.write(z.flush())
            out.close()
            yield batch(_FILES, [path], [n])

    store, base = _open(folder)
    store.create_dir(base, recursive=True)
    return stored(rows.mapInArrow(run, "path string, records long"), "warc-monolithic")


def normalise(files: DataFrame, source: str, target: str) -> DataFrame:
    """Rewrite each listed archive with one gzip member per record.

    Beside ``x.warc.gz`` goes ``x.idx``: one JSON line per record with offset,
    length, type, page_id. Streams of any length pass through in pieces."""

    def one(name: str) -> tuple[str, int]:
        (store, base), (to, to_base) = _open(source), _open(target)
        out_name, n, offset = f"part-{uuid.uuid4().hex}", 0, 0
        with store.open_input_stream(f"{base}/{name}", compression=None) as raw, \
                to.open_output_stream(f"{to_base}/{out_name}.warc.gz", compression=None) as out, \
                to.open_output_stream(f"{to_base}/{out_name}.idx", compression=None) as index:
            stream = Inflated(raw)
            while (head := stream.until(b"\r\n\r\n")) is not None:
                fields = parse_head(head)
                z, length = zlib.compressobj(6, zlib.DEFLATED, GZIP), 0
                body = stream.pieces(int(fields["content-length"]) + 4)  # the record's end mark too
                for data in itertools.chain([z.compress(head)], map(z.compress, body), map(lambda _: z.flush(), [0])):
                    out.write(data)
                    length += len(data)
                page = fields.get("x-page-id")
                index.write(json.dumps({"offset": offset, "length": length, "type": fields["warc-type"],
                                        "page_id": None if page is None else int(page)}).encode() + b"\n")
                offset, n = offset + length, n + 1
        return out_name, n

    def run(batches):
        for b in batches:
            for name in b.column(0).to_pylist():
                yield batch(_FILES, *[[x] for x in one(name)])

    to, base = _open(target)
    to.create_dir(base, recursive=True)
    return stored(_one_per_task(files).mapInArrow(run, "path string, records long"), "warc-normalised")


def _one_per_task(files: DataFrame) -> DataFrame:
    """Deal the list of files out: by name, over as many tasks as shuffles have."""
    n = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.select("path").repartition(n, "path")


def read_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one record's gzip member."""
    raw = zlib.decompress(data, GZIP)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = parse_head(head)
    return fields, rest[:int(fields["content-length"])]


def read_records(archives: DataFrame, folder: str) -> DataFrame:
    """The records of normalised archives, each fetched by its index entry.

    A response's digest is computed from its payload and must match the header."""

    def one(fields: dict[str, str], block: bytes) -> tuple:
        http, _, payload = block.partition(b"\r\n\r\n")
        length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
        digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
        if fields["warc-type"] == "response" and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
            raise ValueError(f"payload of {fields['warc-record-id']} does not match its header")
        page, first = fields.get("x-page-id"), fields.get("x-refers-to-page-id")
        return (None if page is None else int(page), length, digest, fields["warc-type"], None if first is None else int(first))

    def run(batches):
        store, base = _open(folder)
        for b in batches:
            for name in b.column(0).to_pylist():
                out = []
                with store.open_input_file(f"{base}/{name}.warc.gz") as archive, \
                        store.open_input_stream(f"{base}/{name}.idx", compression=None) as index:
                    for entry in map(json.loads, _lines(index)):
                        archive.seek(entry["offset"])
                        out.append(one(*read_record(archive.read(entry["length"]))))
                        if len(out) >= 4096:
                            yield batch(_RECORDS, *zip(*out))
                            out = []
                if out:
                    yield batch(_RECORDS, *zip(*out))

    return _one_per_task(archives).mapInArrow(
        run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def _lines(stream) -> Iterator[bytes]:
    rest = b""
    while data := stream.read(CHUNK):
        *whole, rest = (rest + data).split(b"\n")
        yield from whole
    if rest:
        yield rest


def archive_pages(pages: DataFrame, revisit_from: int = REVISIT_FROM, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives, normalise and read them.

    One row per input row: page_id, payload_bytes, payload_digest (SHA-1, hex),
    record_type and refers_to. A null html is an empty payload. Of equal
    payloads of at least ``revisit_from`` bytes, the rows with the largest
    page_id are responses (identical repeats of that page too; a null page_id
    is below all others) and the rest revisit it. A null url is written as
    about:blank; other columns are ignored; an empty table gives no record."""
    spark = pages.sparkSession
    mono, final = new_folder(spark, "warc-mono"), new_folder(spark, "warc")
    files = write_monolithic(decided(pages, revisit_from), mono, file_bytes)
    return read_records(normalise(files, mono, final), final)
