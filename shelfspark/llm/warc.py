"""WARC archives: a writer, and a sequential reader with digest checks.

Writer. Each record is a gzip member of its own. Of pages with equal payloads
of at least ``min_revisit_bytes`` bytes, the one with the largest id is a
``response`` record and the others are ``revisit`` records that refer to it and
carry no payload; smaller payloads are always responses. A task writes its rows
to archives of bounded size through ``pyarrow.fs``, under names of their own;
a manifest, written by Spark, lists the archives of the attempts that counted,
so files of lost or repeated attempts are never read.

Reader. A task reads its archives from front to back in small chunks,
decompresses incrementally member by member, frames the record by its
Content-Length and recomputes block and payload digests; a bad length, digest
or a truncated member raises ``WarcError``. Memory is one record.

Defined cases: null html is the empty payload; a null url has no
WARC-Target-URI and reads back as null; white space in a url is
percent-encoded in the header; repeated rows of the chosen id are all
responses; a null id loses against any id, and among null ids alone all are
responses; an empty table gives no archive and no rows; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import join_hot, stored
from shelfspark.session import scratch_path

MIN_REVISIT_BYTES = 1000
ARCHIVE_BYTES = 128 << 20
CHUNK = 256 << 10
DATE = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = ("page_id long, url string, record_type string, refers_to long, payload binary, "
          "payload_bytes long, payload_digest string")
_RECORD = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                     ("refers_to", pa.int64()), ("payload", pa.binary()),
                     ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])


class WarcError(ValueError):
    pass


def filesystem(uri: str):
    """The file system of a URI or path, and the path in it."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def _urn(page_id: int | None) -> str:
    return "<urn:x-page:none>" if page_id is None else f"<urn:x-page:{page_id}>"


def _id(urn: str) -> int | None:
    text = urn[len("<urn:x-page:"):-1]
    return None if text == "none" else int(text)


def member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One WARC record as one gzip member."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}", "", ""]
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(lines).encode()) + z.compress(block + b"\r\n\r\n") + z.flush()


def page_member(page_id, url, payload: bytes, digest: str, refers_to, revisit: bool) -> bytes:
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    headers = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _urn(page_id)),
               ("WARC-Date", DATE), ("Content-Type", "application/http; msgtype=response"),
               ("WARC-Block-Digest", "sha1:" + hashlib.sha1(block).hexdigest()),
               ("WARC-Payload-Digest", "sha1:" + digest)]
    if url is not None:
        headers.append(("WARC-Target-URI", urllib.parse.quote(
            url.encode("utf-8", "surrogatepass"), safe="!#$&'()*+,/:;=?@[]~-._|{}^`\"<>\\")))
    if revisit:
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _urn(refers_to))]
    return member(headers, block)


def _write(folder: str, archive_bytes: int):
    def run(batches):
        fs, path = filesystem(folder)
        out, name, size, n = None, None, 0, 0

        def close():
            out.close()
            return pa.RecordBatch.from_pydict({"path": [name], "records": [n], "bytes": [size]})
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    tail = f"pages-{uuid.uuid4().hex}.warc.gz"
                    name, n = f"{folder}/{tail}", 0
                    out = fs.open_output_stream(f"{path}/{tail}", compression=None)
                    info = member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                                   ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")],
                                  b"format: WARC File Format 1.1\r\n")
                    out.write(info)
                    size = len(info)
                data = page_member(row["page_id"], row["url"], row["payload"], row["payload_digest"],
                                   row["refers_to"], row["revisit"])
                out.write(data)
                size, n = size + len(data), n + 1
                if size >= archive_bytes:
                    yield close()
                    out = None
        if out is not None:
            yield close()
    return run


def write_archives(pages: DataFrame, min_revisit_bytes: int = MIN_REVISIT_BYTES,
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html); the manifest: path, records, bytes."""
    spark = pages.sparkSession
    folder = scratch_path(spark, f"llm/warc-{uuid.uuid4().hex}")
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(folder)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(at)
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = (pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"))
            .withColumn("payload_digest", F.sha1("payload")).withColumn("payload_bytes", F.octet_length("payload")))
    keys = ["payload_digest", "payload_bytes"]
    groups = stored(rows.filter(F.col("payload_bytes") >= min_revisit_bytes).groupBy(*keys)
                    .agg(F.max("page_id").alias("chosen"), F.count("*").alias("copies"))
                    .filter("copies > 1 and chosen is not null"), "payload-groups")
    revisit = F.coalesce(F.col("chosen").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("chosen")), F.lit(False))
    records = join_hot(rows, groups, keys, "copies", "left").select(
        "page_id", "url", "payload", "payload_digest", revisit.alias("revisit"),
        F.when(revisit, F.col("chosen")).alias("refers_to"))
    return stored(records.mapInArrow(_write(folder, archive_bytes), "path string, records long, bytes long"),
                  "warc-manifest")


class _Members:
    """The bytes of one gzip member after another, decompressed as far as asked for."""

    def __init__(self, stream):
        self.stream, self.raw = stream, b""

    def begin(self) -> bool:
        if not self.raw:
            self.raw = self.stream.read(CHUNK)
        if not self.raw:
            return False
        self.z, self.plain = zlib.decompressobj(31), bytearray()
        return True

    def _more(self) -> bool:
        if self.z.eof:
            return False
        if not self.raw:
            self.raw = self.stream.read(CHUNK)
            if not self.raw:
                raise WarcError("the archive ends within a member")
        self.plain += self.z.decompress(self.raw, CHUNK)
        self.raw = self.z.unconsumed_tail or self.z.unused_data
        return True

    def until(self, mark: bytes) -> bytes:
        while (at := self.plain.find(mark)) < 0:
            if not self._more():
                raise WarcError("the member ends within its header")
        got = bytes(self.plain[:at])
        del self.plain[:at + len(mark)]
        return got

    def take(self, n: int) -> bytes:
        parts, left = [], n
        while left:
            if not self.plain and not self._more():
                raise WarcError("the member is shorter than its Content-Length")
            part = bytes(self.plain[:left])
            del self.plain[:left]
            parts.append(part)
            left -= len(part)
        return b"".join(parts)

    def end(self) -> bytes:
        while self._more():
            pass
        return bytes(self.plain)


def _fields(head: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = head.decode().split("\r\n")
    return first, {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def _check(kind: str, said: str | None, data: bytes) -> str:
    found = hashlib.sha1(data).hexdigest()
    if said is not None and said.lower() != f"sha1:{found}":
        raise WarcError(f"{kind} digest {said} is not that of the data, sha1:{found}")
    return found


def read_records(stream) -> Iterator[dict]:
    """The page records of an archive in order; digests and lengths are verified."""
    members = _Members(stream)
    while members.begin():
        version, head = _fields(members.until(b"\r\n\r\n"))
        if not version.startswith("WARC/"):
            raise WarcError(f"not a WARC record: {version[:40]!r}")
        block = members.take(int(head["content-length"]))
        if members.end() != b"\r\n\r\n":
            raise WarcError("the record does not end where its Content-Length says")
        _check("block", head.get("warc-block-digest"), block)
        kind = head["warc-type"]
        if kind not in ("response", "revisit"):
            continue
        http, mark, body = block.partition(b"\r\n\r\n")
        if not mark:
            raise WarcError("no end of the HTTP header")
        length = int(_fields(http)[1]["content-length"])
        said = head["warc-payload-digest"]
        if kind == "response":
            if len(body) != length:
                raise WarcError("the payload is not as long as its HTTP header says")
            _check("payload", said, body)
        url = head.get("warc-target-uri")
        yield {"page_id": _id(head["warc-record-id"]), "url": None if url is None else urllib.parse.unquote(url),
               "record_type": kind,
               "refers_to": _id(head["warc-refers-to"]) if kind == "revisit" else None,
               "payload": body if kind == "response" else None,
               "payload_bytes": length, "payload_digest": said.partition(":")[2]}


def _read(batches):
    for batch in batches:
        for uri in batch.column("path").to_pylist():
            fs, path = filesystem(uri)
            with fs.open_input_stream(path, compression=None) as stream:
                rows, size = [], 0
                for r in read_records(stream):
                    rows.append(r)
                    size += len(r["payload"] or b"")
                    if size > 8 << 20 or len(rows) >= 2000:
                        yield pa.RecordBatch.from_pylist(rows, _RECORD)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _RECORD)


def read_archives(manifest: DataFrame) -> DataFrame:
    """The records of the archives that ``manifest`` (path) lists, an archive after another in a task."""
    tasks = max(1, manifest.count())
    return manifest.select("path").repartition(tasks).mapInArrow(_read, RECORD)
