"""A keyed table of results for readers: one row per key, replaced as newer results come in."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatpulse.session import pin_zone
from chatpulse.sources.files import child_names, delete, publish_text, read_text
from chatpulse.sources.writers import BatchSink

SEGMENT = "_segment"
NO_SEGMENT = "none"


@dataclass(frozen=True)
class Version:
    """What a reader has to read: for each segment its folder, and the deltas that came after."""

    number: int = 0
    #: Last micro-batch that is in, by writer.
    batches: dict[str, int] = field(default_factory=dict)
    #: Folder of the compacted rows, by segment.
    segments: dict[str, str] = field(default_factory=dict)
    #: ``(folder, segments it touches)``, oldest first.
    deltas: tuple[tuple[str, tuple[str, ...]], ...] = ()

    def text(self) -> str:
        return json.dumps({"batches": self.batches, "segments": self.segments, "deltas": self.deltas}, sort_keys=True)

    @staticmethod
    def of(number: int, text: str) -> Version:
        stored = json.loads(text)
        deltas = tuple((name, tuple(segments)) for name, segments in stored["deltas"])
        return Version(number, stored["batches"], stored["segments"], deltas)

    def folders(self) -> set[str]:
        return {f"base/{name}" for name in self.segments.values()} | {f"delta/{name}" for name, _ in self.deltas}


class Conflict(RuntimeError):
    """Another writer has published in between, again and again."""


class ServingTable:
    """Keyed results below ``path``: compacted segments plus the deltas of micro-batches, merged on read.

    Every change is published as a numbered manifest that names the folders of a version; a
    manifest appears whole or not at all, so readers see one version, before a compaction or
    after it. A micro-batch becomes a delta folder; after ``compact_after`` of them the
    segments they touch (days of ``segment_by``) are written anew and the deltas are dropped. Untouched
    segments are neither read for a compaction nor merged by readers. Folders that only
    versions older than the last ``keep`` name are deleted.

    A micro-batch that runs again is left out if its writer has published it already, and replaces
    its own unpublished folder if not. Several writers may feed one table under names of their own.
    Of a key's rows the one with the greatest ``order`` columns stays.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        order: Sequence[str] = ("seq",),
        segment_by: str = "win_start",
        compact_after: int = 16,
        keep: int = 8,
        shards: int = 1,
    ) -> None:
        missing = {*keys, *order, segment_by} - set(schema.names)
        if missing:
            raise ValueError(f"no such columns: {sorted(missing)}")
        if segment_by not in keys:
            raise ValueError("segments are cut by a key column, or a key's rows would lie in several")
        if compact_after < 1 or keep < 1 or shards < 1:
            raise ValueError("compact_after, keep and shards must be at least 1")
        self.spark, self.path, self.schema = pin_zone(spark), path.rstrip("/"), schema
        self.keys, self.order, self.segment_by = list(keys), list(order), segment_by
        self.compact_after, self.keep, self.shards = compact_after, keep, shards

    # --- versions ---

    def _numbers(self) -> list[int]:
        names = child_names(self.spark, f"{self.path}/manifest")
        return sorted(int(name[:-5]) for name in names if name.endswith(".json"))

    def _manifest(self, number: int) -> str:
        return f"{self.path}/manifest/{number:012d}.json"

    def _load(self, number: int) -> Version:
        return Version.of(number, read_text(self.spark, self._manifest(number)))

    def version(self) -> Version:
        numbers = self._numbers()
        return self._load(numbers[-1]) if numbers else Version()

    def _publish(self, change: Callable[[Version], Version | None], attempts: int = 20) -> Version | None:
        """Publish ``change`` of the newest version; tried again if another writer was faster."""
        for _ in range(attempts):
            before = self.version()
            after = change(before)
            if after is None:
                return None
            after = replace(after, number=before.number + 1)
            if publish_text(self.spark, self._manifest(after.number), after.text()):
                return after
        raise Conflict(self.path)

    # --- reading ---

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{name}" for name in folders])

    def _base(self, version: Version, segments: Sequence[str]) -> list[str]:
        return [f"base/{version.segments[s]}/{SEGMENT}={s}" for s in segments if s in version.segments]

    def latest(self, rows: DataFrame) -> DataFrame:
        """The row with the greatest order of each key; one grouping, combined before the shuffle."""
        others = [name for name in self.schema.names if name not in self.keys]
        newest = F.max_by(F.struct(*others), F.struct(*self.order)).alias("_newest")
        grouped = rows.groupBy(*self.keys).agg(newest)
        return grouped.select(*[name if name in self.keys else F.col("_newest")[name].alias(name) for name in self.schema.names])

    def read(self, version: Version | None = None) -> DataFrame:
        """One row per key, as of the newest version or the one given."""
        version = version or self.version()
        touched = {s for _, segments in version.deltas for s in segments}
        settled = self._read(self._base(version, sorted(set(version.segments) - touched)))
        if not touched:
            return settled
        open_rows = self._read(self._base(version, sorted(touched)) + [f"delta/{name}" for name, _ in version.deltas])
        return settled.unionByName(self.latest(open_rows))

    # --- writing ---

    def _segment(self):
        day = F.date_format(F.col(self.segment_by).cast("timestamp"), "yyyy-MM-dd")
        return F.coalesce(day, F.lit(NO_SEGMENT))

    def sink(self, writer: str = "main") -> BatchSink:
        """``(frame, batch_id) -> None`` for a stream; ``writer`` names it among the table's writers."""

        def write(frame: DataFrame, batch_id: int) -> None:
            if batch_id <= self.version().batches.get(writer, -1):
                return
            name = f"{writer}-{batch_id}"
            rows = self.latest(frame.select(*self.schema.names))
            # As many as there are days in one micro-batch, noted while it is written.
            touched = Observation()
            rows = rows.observe(touched, F.collect_set(self._segment()).alias("segments"))
            rows.write.mode("overwrite").parquet(f"{self.path}/delta/{name}")
            segments = tuple(sorted(touched.get["segments"]))

            def add(now: Version) -> Version | None:
                if batch_id <= now.batches.get(writer, -1):
                    return None
                deltas = (*now.deltas, (name, segments)) if segments else now.deltas
                return replace(now, batches=now.batches | {writer: batch_id}, deltas=deltas)

            published = self._publish(add)
            if published and len(published.deltas) >= self.compact_after:
                self.compact()

        return write

    def compact(self) -> None:
        """Fold the deltas of the newest version into the segments they touch, then delete what no kept version names."""
        start = self.version()
        touched = sorted({s for _, segments in start.deltas for s in segments})
        if touched:
            folder = f"{start.number + 1}-{uuid.uuid4().hex[:8]}"
            rows = self._read(self._base(start, touched) + [f"delta/{name}" for name, _ in start.deltas])
            placed = self.latest(rows).withColumn(SEGMENT, self._segment())
            spread = F.pmod(F.xxhash64(*self.keys), F.lit(self.shards))
            placed.repartition(SEGMENT, spread).write.partitionBy(SEGMENT).parquet(f"{self.path}/base/{folder}")

            def fold(now: Version) -> Version | None:
                if now.deltas[: len(start.deltas)] != start.deltas or any(
                    now.segments.get(s) != start.segments.get(s) for s in touched
                ):
                    return None
                return replace(now, segments=now.segments | dict.fromkeys(touched, folder), deltas=now.deltas[len(start.deltas) :])

            if self._publish(fold) is None:  # another compaction was faster
                delete(self.spark, f"{self.path}/base/{folder}")
        self._clean()

    def _clean(self) -> None:
        numbers = self._numbers()
        if len(numbers) <= self.keep:
            return
        needed = {name for n in numbers[-self.keep :] for name in self._load(n).folders()}
        old = numbers[: -self.keep]
        for name in {name for n in old for name in self._load(n).folders()} - needed:
            delete(self.spark, f"{self.path}/{name}")
        for n in old:
            delete(self.spark, self._manifest(n))
