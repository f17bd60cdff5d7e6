"""Tables of immutable folders partitioned by day, named by a versioned manifest.

A write adds one folder and changes nothing that exists. It counts from the moment a manifest
of the next version names it; manifests are written aside and renamed into place. Readers
resolve the newest manifest once, so they see all of a write or none of it, and a writer that
dies leaves the version before it in force. The manifest has a few entries for each folder
and day, never for a row, and holds the id of the last batch, by which a batch that is run
again is known.

Days held by one folder are read as they are. Only days with rows in several folders have to
be merged by the reader, until ``compact`` has rewritten them.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

DAY = "day"
_MANIFESTS = "_versions"


@dataclass(frozen=True)
class Part:
    """One folder, the days that count of it, and the batch that wrote it."""

    folder: str
    days: tuple[date, ...]
    batch: int | None = None


@dataclass(frozen=True)
class Version:
    number: int = 0
    batch: int | None = None
    schema: str | None = None
    parts: tuple[Part, ...] = field(default_factory=tuple)

    def applied(self, batch: int | None) -> bool:
        """Whether this version already holds the batch. Batches come in order."""
        return batch is not None and self.batch is not None and batch <= self.batch

    def shared_days(self) -> set[date]:
        """Days with rows in more than one folder."""
        times = Counter(day for part in self.parts for day in part.days)
        return {day for day, n in times.items() if n > 1}

    def before(self, batch: int | None) -> Version:
        """What earlier batches wrote."""
        if batch is None:
            return self
        kept = tuple(p for p in self.parts if p.batch is None or p.batch < batch)
        return Version(self.number, self.batch, self.schema, kept)

    def only(self, batch: int) -> Version:
        """What one batch wrote."""
        return Version(self.number, self.batch, self.schema, tuple(p for p in self.parts if p.batch == batch))


class DayTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    # --- manifests ---

    def _at(self, *names: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *names)))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _names(self, *names: str) -> list[str]:
        fs, path = self._at(*names)
        return [found.getPath().getName() for found in fs.listStatus(path)] if fs.exists(path) else []

    def head(self) -> Version:
        """The newest version; the empty version 0 where nothing was committed."""
        numbers = [n[:-5] for n in self._names(_MANIFESTS) if n.endswith(".json") and n[:-5].isdigit()]
        if not numbers:
            return Version()
        fs, path = self._at(_MANIFESTS, max(numbers) + ".json")
        source = fs.open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()
        stated = json.loads(text)
        parts = tuple(
            Part(p["folder"], tuple(map(date.fromisoformat, p["days"])), p["batch"]) for p in stated["parts"]
        )
        return Version(stated["version"], stated["batch"], stated["schema"], parts)

    def _publish(self, version: Version) -> Version:
        stated = {
            "version": version.number,
            "batch": version.batch,
            "schema": version.schema,
            "parts": [
                {"folder": p.folder, "days": [d.isoformat() for d in p.days], "batch": p.batch}
                for p in version.parts
            ],
        }
        fs, target = self._at(_MANIFESTS, f"{version.number:012d}.json")
        if fs.exists(target):
            raise RuntimeError(f"version {version.number} of {self.path} exists: there is another writer")
        _, aside = self._at(_MANIFESTS, f".{version.number}-{uuid.uuid4().hex}")
        sink = fs.create(aside, False)
        sink.write(bytearray(json.dumps(stated).encode()))
        sink.close()
        if not fs.rename(aside, target):
            raise RuntimeError(f"version {version.number} of {self.path} could not be put in place")
        return version

    # --- writes ---

    def store(self, rows: DataFrame, order_by: Sequence[str] = ()) -> tuple[str, tuple[date, ...]]:
        """Write rows with a ``day`` as a new folder that no version names yet."""
        folder = f"rows-{uuid.uuid4().hex}"
        rows = rows.hint("rebalance", DAY)
        if order_by:
            rows = rows.sortWithinPartitions(DAY, *order_by)
        rows.write.partitionBy(DAY).parquet(f"{self.path}/{folder}")
        found = [n.partition("=")[2] for n in self._names(folder) if n.startswith(f"{DAY}=")]
        return folder, tuple(sorted(map(date.fromisoformat, found)))

    def append(self, rows: DataFrame, batch: int | None = None, order_by: Sequence[str] = ()) -> Version:
        """Add a batch; one that was added before changes nothing."""
        head = self.head()
        if head.applied(batch):
            return head
        folder, days = self.store(rows, order_by)
        parts = (*head.parts, Part(folder, days, batch)) if days else head.parts
        last = head.batch if batch is None else batch
        return self._publish(Version(head.number + 1, last, rows.schema.json(), parts))

    def replace(
        self, rows: DataFrame, days: Iterable[date], batch: int | None = None, order_by: Sequence[str] = ()
    ) -> Version:
        """Put ``rows`` in the place of all rows of ``days``; other days are not touched."""
        head = self.head()
        if head.applied(batch):
            return head
        gone = set(days)
        kept = [Part(p.folder, tuple(d for d in p.days if d not in gone), p.batch) for p in head.parts]
        folder, found = self.store(rows, order_by)
        last = head.batch if batch is None else batch
        parts = [p for p in (*kept, Part(folder, found, last)) if p.days]
        return self._publish(Version(head.number + 1, last, rows.schema.json(), tuple(parts)))

    # --- reads ---

    def read(self, version: Version, days: Iterable[date] | None = None, only: Column | None = None) -> DataFrame:
        """All rows of a version, those of every folder; ``days`` becomes a partition filter."""
        wanted = None if days is None else set(days)
        frames = []
        for part in version.parts:
            own = [d for d in part.days if wanted is None or d in wanted]
            if own:
                schema = T.StructType.fromJson(json.loads(version.schema))
                found = self.spark.read.schema(schema).parquet(f"{self.path}/{part.folder}")
                # A text, since a list of thousands of days takes seconds to pass one by one.
                among = ", ".join(f"date'{d.isoformat()}'" for d in own)
                found = found.filter(f"{DAY} in ({among})").select(*schema.names)
                frames.append(found if only is None else found.filter(only))
        if not frames:
            if version.schema is None:
                raise ValueError(f"{self.path} has no version yet")
            return self.spark.createDataFrame([], T.StructType.fromJson(json.loads(version.schema)))
        rows = frames[0]
        for more in frames[1:]:
            rows = rows.union(more)
        return rows

    def merged(
        self, version: Version, merge: Callable[[DataFrame], DataFrame], days: Iterable[date] | None = None
    ) -> DataFrame:
        """Rows of a version, ``merge`` applied to the days that several folders share."""
        wanted = {d for p in version.parts for d in p.days}
        wanted = wanted if days is None else wanted & set(days)
        shared = version.shared_days() & wanted
        rows = self.read(version, wanted - shared)
        return rows.union(merge(self.read(version, shared)).select(*rows.columns)) if shared else rows

    def compact(self, merge: Callable[[DataFrame], DataFrame], order_by: Sequence[str] = ()) -> Version:
        """Rewrite the days that several folders share into one; readers see equal rows."""
        head = self.head()
        shared = head.shared_days()
        if not shared:
            return head
        return self.replace(merge(self.read(head, shared)), shared, order_by=order_by)
