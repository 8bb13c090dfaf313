"""WARC archives: a Python data source that reads and writes them, and a writer of pages with revisits.

Archives are WARC/1.1, a gzip member per record. The gzip header of a member holds its compressed length
(the extra field ``sl``), so a reader inflates the first bytes of a member, parses the record header and
skips the rest of a record that it doesn't want. Members of other writers lack the field and are
inflated to find their end, without being kept.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, StringStartsWith, WriterCommitMessage

from rillflow.workspace import scratch_path

ROLL_BYTES = 256 << 20
SPLIT_BYTES = 64 << 20
CHUNK = 1 << 20
BATCH_BYTES = 8 << 20
MANIFEST = "_manifest"
NAME = "warc_archive"
# Options that ask for a header field begin so.
ASKED = "header."

# Columns that come from named header fields; ``headers`` holds all of them.
FIELDS = {
    "record_id": "warc-record-id",
    "record_type": "warc-type",
    "target_uri": "warc-target-uri",
    "date": "warc-date",
    "payload_digest": "warc-payload-digest",
    "refers_to": "warc-refers-to",
}
SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in FIELDS]
    + [T.StructField("headers", T.MapType(T.StringType(), T.StringType())), T.StructField("content_length", T.LongType())]
    + [T.StructField("http_headers", T.MapType(T.StringType(), T.StringType())), T.StructField("payload", T.BinaryType())]
)
# Fixed value: what a revisit with the same payload names as its profile.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EPOCH = "1970-01-01T00:00:00Z"


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and plain path of a path or URI."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def member(data: bytes, level: int = 6) -> bytes:
    """A gzip member with its compressed and plain length in the extra field ``sl``."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -zlib.MAX_WBITS)
    body = packer.compress(data) + packer.flush()
    size = 10 + 2 + 12 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, size & 0xFFFFFFFF, len(data) & 0xFFFFFFFF)
    head = b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff" + struct.pack("<H", len(extra)) + extra
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def record(fields: Sequence[tuple[str, str | None]], block: bytes) -> bytes:
    """A WARC record; fields without a value are left out."""
    lines = ["WARC/1.1", *(f"{name}: {value}" for name, value in fields if value is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name, the first line left out."""
    pairs = (line.partition(b":") for line in head.split(b"\r\n")[1:] if b":" in line)
    return {name.strip().lower().decode("utf-8", "replace"): value.strip().decode("utf-8", "replace") for name, _, value in pairs}


@dataclass
class Member:
    """A record of an archive: its header, and how to get at its block."""

    headers: dict[str, str]
    start: bytes
    more: Iterator[bytes]

    def block(self) -> bytes:
        size = int(self.headers.get("content-length", 0))
        parts, have = [self.start], len(self.start)
        while have < size:
            part = next(self.more)
            parts.append(part)
            have += len(part)
        return b"".join(parts)[:size]


def _inflate(stream, limit: int | None, first: bytes) -> Iterator[bytes]:
    """Plain pieces of the member at the stream's place; ends with the stream just behind the member."""
    unpack, data, used = zlib.decompressobj(zlib.MAX_WBITS | 16), first, 0
    while data:
        out = unpack.decompress(data)
        used += len(data) - len(unpack.unused_data)
        if out:
            yield out
        if unpack.eof:
            stream.seek(stream.tell() - len(unpack.unused_data))
            return
        data = stream.read(CHUNK if limit is None else min(CHUNK, max(limit - used, 1)))
    raise ValueError("an archive ends within a record")


def members(stream, peek: int = 2048) -> Iterator[Member]:
    """Records of a gzipped archive. What a caller doesn't read of a block is skipped, not inflated, if its length is known."""
    while True:
        begin = stream.tell()
        first = stream.read(peek)
        if not first:
            return
        size = struct.unpack_from("<I", first, 16)[0] if first[3:4] == b"\x04" and first[12:14] == b"sl" and len(first) >= 24 else None
        if size and len(first) > size:
            first = first[:size]
            stream.seek(begin + size)
        more = _inflate(stream, size, first)
        text = next(more)
        while b"\r\n\r\n" not in text:
            text += next(more)
        head, _, rest = text.partition(b"\r\n\r\n")
        if not head.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        yield Member(_fields(head), rest, more)
        if size:
            stream.seek(begin + size)
        else:
            for _ in more:
                pass


@dataclass
class Files(InputPartition):
    names: list[str] = field(default_factory=list)


def plain_members(stream) -> Iterator[Member]:
    """Records of an archive without compression. What a caller doesn't read of a block is skipped."""
    while True:
        begin = stream.tell()
        data = stream.read(2048)
        # Blank lines between records, and their end.
        blank = len(data) - len(data.lstrip(b"\r\n"))
        if blank:
            stream.seek(begin + blank)
            continue
        if not data:
            return
        while b"\r\n\r\n" not in data:
            more = stream.read(CHUNK)
            if not more:
                raise ValueError("an archive ends within a record")
            data += more
        head, _, rest = data.partition(b"\r\n\r\n")
        if not head.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        headers, place = _fields(head), begin + len(data)
        size = int(headers.get("content-length", 0))

        def follow(place: int = place, left: int = size - len(rest)) -> Iterator[bytes]:
            while left > 0:
                stream.seek(place)
                part = stream.read(min(CHUNK, left))
                if not part:
                    raise ValueError("an archive ends within a record")
                place, left = place + len(part), left - len(part)
                yield part

        yield Member(headers, rest, follow())
        stream.seek(begin + len(head) + 4 + size)


def _wanted(filters: list[Filter], said: dict[str, str], headers: dict[str, str]) -> bool:
    """Whether a record header meets the pushed filters and the header fields asked for."""
    if any(headers.get(name) != value for name, value in said.items()):
        return False
    for f in filters:
        value = headers.get(FIELDS[f.attribute[0]])
        if isinstance(f, EqualTo) and value != f.value:
            return False
        if isinstance(f, In) and value not in f.value:
            return False
        if isinstance(f, IsNotNull) and value is None:
            return False
        if isinstance(f, StringStartsWith) and not (value or "").startswith(f.value):
            return False
    return True


class WarcReader(DataSourceReader):
    """Plans partitions by files; filters on header columns, and options ``header.<name>``, are checked before a payload is touched."""

    def __init__(self, schema: T.StructType, options: dict[str, str]) -> None:
        self.schema, self.path, self.filters = schema, options["path"], []
        self.split = int(options.get("splitbytes", SPLIT_BYTES))
        self.said = {name[len(ASKED) :].lower(): value for name, value in options.items() if name.lower().startswith(ASKED)}

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            ours = isinstance(f, (EqualTo, In, IsNotNull, StringStartsWith)) and len(f.attribute) == 1 and f.attribute[0] in FIELDS
            if ours:
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> Sequence[InputPartition]:
        """Files in runs of about ``splitBytes``. A file is one task's work, so writers start new ones at 256 MB."""
        fs, root = _open(self.path)
        found = {i.path: i.size for i in fs.get_file_info(pafs.FileSelector(root, recursive=True)) if i.is_file}
        manifests = _manifests(found)
        if manifests:
            # Only what finished writes have listed; files of failed tasks are not read.
            found = {path: found[path] for manifest in manifests for path in _listed(fs, manifest)}
        runs, size = [Files()], 0
        for path, length in sorted(found.items()):
            if not path.endswith((".warc", ".warc.gz")):
                continue
            if runs[-1].names and size + length > self.split:
                runs.append(Files())
                size = 0
            runs[-1].names.append(path)
            size += length
        return runs

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        fs, _ = _open(self.path)
        names = self.schema.names
        kinds = pa.schema([(n, {"content_length": pa.int64(), "payload": pa.binary()}.get(n, pa.map_(pa.string(), pa.string()) if n.endswith("headers") else pa.string())) for n in names])
        need_http, need_payload = "http_headers" in names, "payload" in names
        rows: list[tuple] = []
        size = 0
        for name in partition.names:
            with fs.open_input_file(name) as stream:
                for one in plain_members(stream) if name.endswith(".warc") else members(stream):
                    if not _wanted(self.filters, self.said, one.headers):
                        continue
                    http, payload = {}, None
                    if need_http or need_payload:
                        block = one.block()
                        is_http = one.headers.get("content-type", "").startswith("application/http")
                        head, _, body = block.partition(b"\r\n\r\n") if is_http else (b"", b"", block)
                        http, payload = _fields(head), None if one.headers.get("warc-type") == "revisit" else body
                    values = {"headers": list(one.headers.items()), "content_length": int(one.headers.get("content-length", 0)), "http_headers": list(http.items()), "payload": payload}
                    rows.append(tuple(values[n] if n in values else one.headers.get(FIELDS[n]) for n in names))
                    size += len(payload or b"") + 500
                    if size > BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], schema=kinds)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], schema=kinds)


def _manifests(paths: Iterable[str]) -> list[str]:
    return sorted(p for p in paths if p.rpartition("/")[2].startswith(MANIFEST) and p.endswith(".json"))


def _listed(fs: pafs.FileSystem, manifest: str) -> list[str]:
    """The files that a manifest lists, which lie beside it."""
    with fs.open_input_stream(manifest) as file:
        return [f"{manifest.rpartition('/')[0]}/{name}" for name in json.loads(file.read())]


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Rows ``(record_id, target_uri, payload_digest, refers_to, payload, payload_bytes)`` as response and revisit records.

    A task writes files of its own. Every write has a manifest, written when all its tasks have ended, that says which of
    them count; the archive is what all manifests list. ``overwrite`` removes what was listed before.
    """

    def __init__(self, options: dict[str, str], overwrite: bool = False) -> None:
        self.overwrite = overwrite
        self.path, self.level = options["path"], int(options.get("level", 6))
        self.roll = int(options.get("rollbytes", ROLL_BYTES))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = _open(self.path)
        fs.create_dir(root, recursive=True)
        names, stream, size = [], None, 0
        for batch in iterator:
            for row in zip(*(batch.column(c) for c in ("record_id", "target_uri", "payload_digest", "refers_to", "payload", "payload_bytes")), strict=True):
                if stream is None or size > self.roll:
                    if stream is not None:
                        stream.close()
                    names.append(f"part-{uuid.uuid4().hex}.warc.gz")
                    stream, size = fs.open_output_stream(f"{root.rstrip('/')}/{names[-1]}", compression=None), 0
                data = member(page_record(*(v.as_py() for v in row)), self.level)
                stream.write(data)
                size += len(data)
        if stream is not None:
            stream.close()
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = _open(self.path)
        root = root.rstrip("/")
        fs.create_dir(root, recursive=True)
        before = _manifests(i.path for i in fs.get_file_info(pafs.FileSelector(root)) if i.is_file) if self.overwrite else []
        name = f"{MANIFEST}-{uuid.uuid4().hex}"
        with fs.open_output_stream(f"{root}/{name}.tmp") as file:
            file.write(json.dumps([n for m in messages if m for n in m.names]).encode())
        fs.move(f"{root}/{name}.tmp", f"{root}/{name}.json")
        for manifest in before:
            old = _listed(fs, manifest)
            fs.delete_file(manifest)
            for path in old:
                fs.delete_file(path)

    def abort(self, messages: list[Written | None]) -> None:
        fs, root = _open(self.path)
        for name in (n for m in messages if m for n in m.names):
            fs.delete_file(f"{root.rstrip('/')}/{name}")


def page_record(record_id: str, uri: str | None, digest: str, refers_to: str | None, payload: bytes | None, size: int) -> bytes:
    """A response with an HTTP block, or, if it refers to another record, a revisit without the payload."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    head = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id),
        ("WARC-Date", EPOCH),
        ("WARC-Target-URI", None if uri is None else quote(uri, safe="".join(map(chr, range(33, 127))))),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Refers-To", refers_to),
        ("WARC-Profile", REVISIT_PROFILE if revisit else None),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    return record(head, http if revisit else http + (payload or b""))


class WarcSource(DataSource):
    """``spark.read.format("warc_archive")``; name only the columns you need in ``.schema(...)``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> WarcReader:
        return WarcReader(schema, self.options)

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options, overwrite)


def read_warc(spark: SparkSession, path: str, *columns: str, headers: dict[str, str] | None = None) -> DataFrame:
    """Records of the archives below ``path``, gzipped or plain, by default with all columns.

    Without ``payload`` and ``http_headers`` no block is read. ``where`` on ``record_type`` and the other
    header columns is pushed into the source; conditions on other header fields go there as ``headers``, names and the values
    they must have, since Spark pushes no conditions on maps. Once a write of this package has left a manifest, only listed files count.
    """
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    wanted = T.StructType([f for f in SCHEMA if not columns or f.name in columns])
    asked = {f"{ASKED}{name.lower()}": value for name, value in (headers or {}).items()}
    return spark.read.format(NAME).schema(wanted).options(**asked).load(path)


def record_uri(row_id) -> F.Column:
    """Record id of a row id; a NULL id has an empty name."""
    return F.concat(F.lit("<urn:x-row:"), F.coalesce(row_id.cast("string"), F.lit("")), F.lit(">"))


def row_id_of(uri, kind: str) -> F.Column:
    return F.nullif(F.regexp_extract(uri, r"^<urn:x-row:(.*)>$", 1), F.lit("")).cast(kind)


def _base32(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        payloads = batch.column(2)
        digests = [base64.b32encode(hashlib.sha1(p.as_buffer() or b"").digest()).decode() for p in payloads]
        sizes = pa.array([len(p.as_buffer() or b"") for p in payloads], pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests), sizes], names=["id", "uri", "payload", "digest", "size"])


def write_pages(pages: DataFrame, path: str, min_bytes: int = 0, id_col: str = "page_id", uri_col: str | None = "url", payload_col: str = "html", level: int = 6, mode: str = "append") -> None:
    """A record per row, added to the archives at ``path`` or, with ``mode`` ``overwrite``, in their place. Of equal payloads of at least ``min_bytes`` bytes one is a response, the others revisit it.

    The response is the row with the smallest id; rows that repeat this id are responses too. A NULL id is
    larger than any other, a NULL payload is empty, a NULL URI is left out, and blanks and control characters
    in a URI are percent-encoded. Payloads may be text, stored as UTF-8, or binary. Other columns are ignored.
    An empty table adds no records. Roles are given within one write: pages of another write are not looked at. Groups of equal payloads meet only as digests, which are
    counted before they are shuffled.
    """
    pages.sparkSession.dataSource.register(WarcSource)
    uri = F.lit(None) if uri_col is None else F.col(uri_col)
    rows = pages.select(F.col(id_col).alias("id"), uri.cast("string").alias("uri"), F.col(payload_col).cast("binary").alias("payload"))
    kind = rows.schema["id"].dataType.simpleString()
    rows = rows.mapInArrow(_base32, f"id {kind}, uri string, payload binary, digest string, size long")
    keys = rows.where(F.col("size") >= min_bytes).groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    repeated = keys.where("n > 1 and first is not null").select("digest", "first")
    # An outer join on the side of the pages, which run-time re-planning splits where a digest is frequent.
    roles = rows.join(repeated, "digest", "left")
    revisit = (F.col("size") >= min_bytes) & ~F.col("id").eqNullSafe(F.col("first")) & F.col("first").isNotNull()
    roles.select(
        record_uri(F.col("id")).alias("record_id"),
        F.col("uri").alias("target_uri"),
        F.col("digest").alias("payload_digest"),
        F.when(revisit, record_uri(F.col("first"))).alias("refers_to"),
        F.when(~revisit, F.col("payload")).alias("payload"),
        F.col("size").alias("payload_bytes"),
    ).write.format(NAME).mode(mode).option("level", level).save(path)


def read_pages(spark: SparkSession, path: str, id_type: str = "long", id_col: str = "page_id") -> DataFrame:
    """``(id, uri, record_type, payload, payload_bytes, payload_digest, refers_to)`` of archives made by ``write_pages``.

    Digest and length of a response are taken from the payload read, those of a revisit from its headers, as it
    has no payload of its own.
    """
    revisits = read_warc(spark, path, "record_id", "record_type", "target_uri", "refers_to", "payload_digest", "http_headers").where("record_type = 'revisit'")
    responses = read_warc(spark, path, "record_id", "record_type", "target_uri", "refers_to", "payload_digest", "payload").where("record_type = 'response'")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payloads, said = batch.column(1), batch.column(2).to_pylist()
            digests = [base64.b32encode(hashlib.sha1(p.as_buffer() or b"").digest()).decode() for p in payloads]
            if any(s is not None and s.removeprefix("sha1:") != d for s, d in zip(said, digests, strict=True)):
                raise ValueError("a payload differs from its digest")
            yield pa.RecordBatch.from_arrays([batch.column(0), payloads, pa.array(digests), batch.column(3)], names=["record_id", "payload", "digest", "target_uri"])

    checked = responses.select("record_id", "payload", "payload_digest", "target_uri").mapInArrow(check, "record_id string, payload binary, digest string, target_uri string")
    own_id = row_id_of(F.col("record_id"), id_type).alias(id_col)
    return checked.select(
        own_id, F.col("target_uri").alias("uri"), F.lit("response").alias("record_type"), "payload",
        F.octet_length("payload").cast("long").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.lit(None).cast(id_type).alias("refers_to"),
    ).unionByName(
        revisits.select(
            own_id, F.col("target_uri").alias("uri"), "record_type", F.lit(None).cast("binary").alias("payload"),
            F.col("http_headers")["content-length"].cast("long").alias("payload_bytes"),
            F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"), row_id_of(F.col("refers_to"), id_type).alias("refers_to"),
        )
    )


def page_archive(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write ``pages`` and read the archives back; ``path`` is a new scratch folder unless given."""
    path = path or scratch_path(pages.sparkSession, "warc")
    write_pages(pages, path, **options)
    return read_pages(pages.sparkSession, path)
