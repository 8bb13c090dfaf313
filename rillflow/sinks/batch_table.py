"""A table of micro-batches with a manifest, which can be compacted while streams write to it.

Folders of data are never changed. Which of them are the table is said by the manifest, a numbered file that lists
folders and the batches that each holds. A change writes the next number and takes effect by one rename that
fails if that number exists, so of two changes at the same time one is repeated on the other's result. A batch belongs
to the table at most once: a replay of a listed batch changes nothing, whether or not its folder has been merged with others.

The rename must be atomic and must not replace a file, as on HDFS and local file systems.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rillflow.sinks.table import query_id
from rillflow.workspace import remove

MANIFESTS = "_manifests"
# Attempts of a change against changes of others.
TRIES = 100


@dataclass(frozen=True)
class Folder:
    """A folder of data, its rows and its batches: ranges of numbers, both ends included, per query."""

    name: str
    rows: int
    batches: dict[str, list[list[int]]]

    def holds(self, query: str, batch: int) -> bool:
        return any(low <= batch <= high for low, high in self.batches.get(query, []))


@dataclass(frozen=True)
class Manifest:
    """The folders of a table as of one number; number 0 is the empty table."""

    number: int = 0
    folders: list[Folder] = field(default_factory=list)
    schema: str | None = None

    def holds(self, query: str, batch: int) -> bool:
        return any(f.holds(query, batch) for f in self.folders)

    def text(self) -> str:
        return json.dumps({"schema": self.schema, "folders": [vars(f) for f in self.folders]})

    @classmethod
    def parse(cls, number: int, text: str) -> Manifest:
        spec = json.loads(text)
        return cls(number, [Folder(**f) for f in spec["folders"]], spec["schema"])


def merged_batches(folders: Iterable[Folder]) -> dict[str, list[list[int]]]:
    """The batches of several folders, neighbouring ranges joined."""
    out: dict[str, list[list[int]]] = {}
    for query, low, high in sorted((q, low, high) for f in folders for q, ranges in f.batches.items() for low, high in ranges):
        own = out.setdefault(query, [])
        if own and low <= own[-1][1] + 1:
            own[-1][1] = max(own[-1][1], high)
        else:
            own.append([low, high])
    return out


class BatchTable:
    """The table below ``path``; see the module."""

    def __init__(self, spark: SparkSession, path: str, fmt: str = "parquet") -> None:
        self.spark, self.path, self.fmt = spark, path.rstrip("/"), fmt

    # The manifest

    def manifest(self) -> Manifest:
        """The newest manifest."""
        return self._read(max(self._numbers(), default=0))

    def _numbers(self) -> list[int]:
        place = self._place(MANIFESTS)
        files = place.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(place):
            return []
        names = [status.getPath().getName() for status in files.listStatus(place)]
        return [int(name.removesuffix(".json")) for name in names if name.endswith(".json") and not name.startswith(("_", "."))]

    def _read(self, number: int) -> Manifest:
        if number == 0:
            return Manifest()
        place = self._place(MANIFESTS, f"{number:012d}.json")
        stream = place.getFileSystem(self.spark._jsc.hadoopConfiguration()).open(place)
        try:
            content = bytes(stream.readAllBytes())
        finally:
            stream.close()
        return Manifest.parse(number, content.decode())

    def _publish(self, manifest: Manifest) -> bool:
        """Make a manifest the newest one; False if its number is taken."""
        jvm, settings = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        draft = self._place(MANIFESTS, f"_{uuid.uuid4().hex}.tmp")
        files = draft.getFileSystem(settings)
        stream = files.create(draft, False)
        try:
            stream.write(manifest.text().encode())
        finally:
            stream.close()
        final = self._place(MANIFESTS, f"{manifest.number:012d}.json")
        # ``Options.Rename`` without OVERWRITE: an existing file makes the rename fail.
        nothing = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), settings).rename(draft, final, nothing)
        except Exception:
            if not files.exists(final):
                raise
            files.delete(draft, False)
            return False
        return True

    def _change(self, make: Callable[[Manifest], Manifest | None]) -> Manifest | None:
        """Publish what ``make`` makes of the newest manifest; None if it makes nothing of it."""
        for _ in range(TRIES):
            now = self.manifest()
            new = make(now)
            if new is None or self._publish(new):
                return new
        raise RuntimeError(f"{self.path} changes too often")

    def _place(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *parts)))

    # Batches

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """Add a micro-batch, unless it is there already; a ``BatchWriter``."""
        self.add(batch, query_id(batch), int(batch_id))

    def add(self, rows: DataFrame, query: str, batch: int) -> None:
        """Add rows as a batch of a query."""
        if self.manifest().holds(query, batch):
            return
        name = f"data/{uuid.uuid4().hex}"
        rows.write.format(self.fmt).save(f"{self.path}/{name}")
        schema = rows.schema
        folder = Folder(name, self._load([name], schema).count(), {query: [[batch, batch]]})

        def listed(now: Manifest) -> Manifest | None:
            if now.holds(query, batch):
                return None
            return Manifest(now.number + 1, [*now.folders, folder], now.schema or schema.json())

        if self._change(listed) is None:
            remove(self.spark, f"{self.path}/{name}")

    def read(self) -> DataFrame:
        """The rows of all batches of the newest manifest, each batch once."""
        now = self.manifest()
        if now.schema is None:
            raise ValueError(f"{self.path} has no batch yet")
        schema = T.StructType.fromJson(json.loads(now.schema))
        return self._load([f.name for f in now.folders], schema) if now.folders else self.spark.createDataFrame([], schema)

    def _load(self, names: list[str], schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).format(self.fmt).load([f"{self.path}/{name}" for name in names])

    # Upkeep

    def compact(self, small_rows: int, file_rows: int = 0) -> int:
        """Merge the folders of up to ``small_rows`` rows into one; returns how many were merged.

        Streams may go on meanwhile: their new folders are kept, and readers see the old folders or the merged one. ``file_rows``
        caps the rows of a file. The old folders stay for readers that still use them, until ``clean``.
        """
        now = self.manifest()
        small = [f for f in now.folders if f.rows <= small_rows]
        if len(small) < 2:
            return 0
        schema = T.StructType.fromJson(json.loads(now.schema))
        name, old = f"data/{uuid.uuid4().hex}", {f.name for f in small}
        rows = self._load(sorted(old), schema).hint("rebalance")
        rows.write.format(self.fmt).option("maxRecordsPerFile", str(file_rows)).save(f"{self.path}/{name}")
        merged = Folder(name, sum(f.rows for f in small), merged_batches(small))

        def switched(newer: Manifest) -> Manifest | None:
            if not old <= {f.name for f in newer.folders}:
                return None  # another compaction was faster
            return Manifest(newer.number + 1, [merged, *(f for f in newer.folders if f.name not in old)], newer.schema)

        if self._change(switched) is None:
            remove(self.spark, f"{self.path}/{name}")
            return 0
        return len(small)

    def clean(self, keep_seconds: float = 86_400.0, keep_manifests: int = 10) -> int:
        """Delete folders that the newest manifest doesn't list and that are older than ``keep_seconds``, and old manifests.

        Let ``keep_seconds`` be longer than any reader, batch or compaction takes. Returns how many folders went.
        """
        listed = {f.name for f in self.manifest().folders}
        place = self._place("data")
        files = place.getFileSystem(self.spark._jsc.hadoopConfiguration())
        before = (time.time() - keep_seconds) * 1000
        found = list(files.listStatus(place)) if files.exists(place) else []
        gone = [s.getPath() for s in found if f"data/{s.getPath().getName()}" not in listed and s.getModificationTime() <= before]
        for folder in gone:
            files.delete(folder, True)
        for number in sorted(self._numbers())[:-keep_manifests]:
            files.delete(self._place(MANIFESTS, f"{number:012d}.json"), False)
        return len(gone)
