"""Text lines inside zip archives.

Spark reads gzip and bzip2 but not zip. Archives are listed by Spark, their members are dealt out to
tasks, and each task inflates its members as a stream of fixed-size chunks, so neither an archive nor a
member has to fit in memory. One deflated member cannot be split: it is read by one task. A stored member is cut into
ranges of bytes, like a text file; the lines that begin in a range belong to it.
"""

from __future__ import annotations

import io
import itertools
import re
import sys
import urllib.parse
import zipfile
import zlib
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

CHUNK_BYTES = 4 * 1024 * 1024
# Archives up to this size are read in one go.
TINY_BYTES = 64 * 1024
# Fixed value: length of the header that stands before a member.
LOCAL_HEADER = 30
MEMBER = ("member", "offset", "size", "method", "crc", "encrypted", "low", "high")
# Stored members are cut into ranges of this size.
RANGE_BYTES = 64 * 1024 * 1024
LINE_END = re.compile(rb"\n|\r(?!\n)")

# The task functions below travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def open_file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """Arrow file system and inner path of a Hadoop-style path (local, hdfs, s3a, gs, abfs)."""
    if "://" in path or path.startswith("file:"):
        scheme, rest = path.split(":", 1)
        scheme = "s3" if scheme in ("s3a", "s3n") else scheme
        return pafs.FileSystem.from_uri(f"{scheme}:{urllib.parse.quote(rest, safe='/:@')}")
    return pafs.LocalFileSystem(), path


@contextmanager
def _open_archive(path: str) -> Iterator[zipfile.ZipFile]:
    files, inner = open_file_system(path)
    with files.open_input_file(inner) as file:
        # The directory search steps back past the start of a tiny file, which Arrow files refuse.
        source = io.BytesIO(file.read()) if file.size() <= TINY_BYTES else file
        with zipfile.ZipFile(source) as archive:
            yield archive


def line_blocks(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The same bytes cut at line ends; a line longer than a chunk makes a longer block."""
    pending: list[bytes] = []
    for chunk in chunks:
        if pending and pending[-1].endswith(b"\r"):
            chunk = pending.pop() + chunk
        # A carriage return at the very end may be half of \r\n, so it stays pending.
        cut = max(chunk.rfind(b"\n"), chunk.rfind(b"\r", 0, -1)) + 1
        if cut == 0:
            pending.append(chunk)
            continue
        yield b"".join(pending) + chunk[:cut]
        pending = [chunk[cut:]] if cut < len(chunk) else []
    rest = b"".join(pending)
    if rest:
        yield rest


def block_lines(block: bytes) -> pa.Array:
    r"""Lines of a block, ended by ``\n``, ``\r\n`` or ``\r``; bytes that are not UTF-8 are replaced."""
    if b"\r" in block:
        block = block.replace(b"\r\n", b"\n").replace(b"\r", b"\n")
    block = block.removesuffix(b"\n")
    try:
        text = pa.scalar(block, pa.large_binary()).cast(pa.large_string())
    except pa.ArrowInvalid:
        text = pa.scalar(block.decode("utf-8", "replace"), pa.large_string())
    return pc.split_pattern(text, "\n").values.cast(pa.string())


def _chunks(stream) -> Iterator[bytes]:
    while chunk := stream.read(CHUNK_BYTES):
        yield chunk


def _ranges(member: zipfile.ZipInfo, range_bytes: int) -> Iterator[tuple[int, int]]:
    """The parts of a member that tasks can read by themselves: ranges of a stored one, else all of it."""
    size = member.compress_size
    step = range_bytes if member.compress_type == zipfile.ZIP_STORED and not member.flag_bits & 1 else max(size, 1)
    for low in range(0, max(size, 1), step):
        yield low, min(low + step, size)


def _list_members(batches: Iterator[pa.RecordBatch], range_bytes: int = RANGE_BYTES) -> Iterator[pa.RecordBatch]:
    """Where each member lies, so that reading it needs no directory."""
    for batch in batches:
        for path in batch.column("path").to_pylist():
            with _open_archive(path) as archive:
                found = [
                    (i, m.header_offset, m.compress_size, m.compress_type, m.CRC, m.flag_bits & 1, low, high)
                    for i, m in enumerate(archive.infolist())
                    if not m.is_dir()
                    for low, high in _ranges(m, range_bytes)
                ]
            columns = [pa.array(c, pa.int64()) for c in (zip(*found) if found else [[]] * len(MEMBER))]
            yield pa.RecordBatch.from_arrays([pa.array([path] * len(found), pa.string()), *columns], ["path", *MEMBER])


def _content_place(file, offset: int) -> int:
    """Where the content of the member begins whose header stands at ``offset``."""
    file.seek(offset)
    header = file.read(LOCAL_HEADER)
    if header[:4] != b"PK\x03\x04":
        raise zipfile.BadZipFile("no member where the directory says")
    name, extra = int.from_bytes(header[26:28], "little"), int.from_bytes(header[28:30], "little")
    return offset + LOCAL_HEADER + name + extra


def _line_start(file, place: int, size: int, at: int) -> int:
    """The first place from ``at`` on where a line of a stored member begins; its size if none does."""
    if at == 0 or at >= size:
        return min(at, size)
    # A line begins behind a line end, of which the last byte may stand just before.
    begin = at - 1
    while begin < size:
        file.seek(place + begin)
        data = file.read(min(CHUNK_BYTES, size - begin))
        if not data:
            raise zipfile.BadZipFile("the archive ends within a member")
        # A carriage return at the end of the piece may be half of \r\n: it is looked at again with what follows.
        half = data.endswith(b"\r") and begin + len(data) < size and len(data) > 1
        found = LINE_END.search(data[:-1] if half else data)
        if found:
            return begin + found.end()
        begin += len(data) - half
    return size


def _stored_chunks(file, offset: int, size: int, low: int, high: int) -> Iterator[bytes]:
    """The lines of a stored member that begin between ``low`` and ``high``."""
    place = _content_place(file, offset)
    at, end = _line_start(file, place, size, low), _line_start(file, place, size, high)
    while at < end:
        file.seek(place + at)
        data = file.read(min(CHUNK_BYTES, end - at))
        if not data:
            raise zipfile.BadZipFile("the archive ends within a member")
        at += len(data)
        yield data


def _member_chunks(file, offset: int, size: int, method: int, crc: int) -> Iterator[bytes]:
    """Inflated pieces of one member, read from its place in the archive."""
    file.seek(_content_place(file, offset))
    inflate = zlib.decompressobj(-zlib.MAX_WBITS) if method == zipfile.ZIP_DEFLATED else None
    seen = 0
    while size:
        data = file.read(min(CHUNK_BYTES, size))
        if not data:
            raise zipfile.BadZipFile("the archive ends within a member")
        size -= len(data)
        while data:
            out = data if inflate is None else inflate.decompress(data, CHUNK_BYTES)
            data = b"" if inflate is None else inflate.unconsumed_tail
            seen = zlib.crc32(out, seen)
            if out:
                yield out
    if inflate is not None and (out := inflate.flush()):
        seen = zlib.crc32(out, seen)
        yield out
    if seen != crc:
        raise zipfile.BadZipFile("a member differs from its check sum")


def _read_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = sorted(zip(*(batch.column(c).to_pylist() for c in ("path", *MEMBER))))
        for path, members in itertools.groupby(rows, lambda row: row[0]):
            files, inner = open_file_system(path)
            with files.open_input_file(inner) as file:
                for _, index, offset, size, method, crc, encrypted, low, high in members:
                    if high - low < size:
                        blocks = line_blocks(_stored_chunks(file, offset, size, low, high))
                    elif method in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED) and not encrypted:
                        blocks = line_blocks(_member_chunks(file, offset, size, method, crc))
                    else:
                        blocks = _other_blocks(path, index)
                    yield from _joined(blocks)


def _other_blocks(path: str, index: int) -> Iterator[bytes]:
    """Members in rarer formats, by way of the directory."""
    with _open_archive(path) as archive, archive.open(archive.infolist()[index]) as stream:
        yield from line_blocks(_chunks(stream))


def _joined(blocks: Iterator[bytes]) -> Iterator[pa.RecordBatch]:
    for block in blocks:
        yield pa.RecordBatch.from_arrays([block_lines(block)], ["value"])


def read_zip_lines(spark: SparkSession, paths: str | Sequence[str], tasks: int | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row (``value``) per line of every file in the zip archives below ``paths``.

    ``tasks`` is the number of tasks the members are dealt out to, four per core by default. Stored members of more than
    ``range_bytes`` are cut at line ends and dealt out in parts; no task sees such a member whole, so its check sum is not looked at.
    """
    archives = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.[zZ][iI][pP]")
        .load(paths if isinstance(paths, str) else list(paths))
        .select("path")
    )
    members = archives.mapInArrow(lambda batches: _list_members(batches, range_bytes), "path string, " + ", ".join(f"{c} long" for c in MEMBER))
    # A fixed number of partitions, as these few bytes stand for much data and must not be merged.
    dealt = members.repartition(tasks or 4 * spark.sparkContext.defaultParallelism, "path", "member", "low")
    return dealt.mapInArrow(_read_members, "value string")
