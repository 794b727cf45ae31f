"""An append-only event table that can be compacted beside its writers.

Events are partitioned by a hash of their name and by segment.  An append writes its events to a folder of
its own and registers it as a segment with one catalog call, so writers never share a folder.  Compaction
reads the segments it listed, writes them as one larger segment, registers that and only then unregisters
the listed ones; a segment that was registered meanwhile is not in its list and stays.  Between the two
catalog calls (or for good, if the process is lost there) an event may be in two segments; every event has
an id, and readers that list or count events take each id once.

Compaction is tiered: many segments of one level become one of the next, so an event is rewritten a
logarithmic number of times.  Files of unregistered segments are kept for readers planned against them.
"""

from __future__ import annotations

import time
import uuid
import zlib
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from flowtable.operators.sinks import Warehouse, _q, _text, ddl_columns
from flowtable.sources.catalog import scan_table

NAME_BUCKET, SEGMENT, EVENT_ID = "_name_bucket", "_segment", "event_id"
NAME_BUCKETS_PROPERTY = "flowtable.name_buckets"
ROWS_A_FILE = 1_000_000  # of a compacted segment


class Journal:
    """Events of ``schema`` (first column: the name) in table ``table`` of a warehouse."""

    def __init__(self, warehouse: Warehouse, table: str, schema: StructType, name: str, buckets: int = 16) -> None:
        self.wh, self.spark, self.table, self.name = warehouse, warehouse.spark, table, name
        self.schema = StructType([*schema.fields, StructField(EVENT_ID, StringType())])
        if not warehouse.exists(table):
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self._id} ({ddl_columns(self.schema)}, {NAME_BUCKET} INT, {SEGMENT} STRING) "
                f"USING parquet PARTITIONED BY ({NAME_BUCKET}, {SEGMENT}) LOCATION {_text(f'{warehouse.root}/{table}/data')} "
                f"TBLPROPERTIES ({_text(NAME_BUCKETS_PROPERTY)} = '{buckets}')")
        found = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self._id}").collect()}
        if NAME_BUCKETS_PROPERTY not in found:
            raise ValueError(f"{table} is not a journal in segments; move it away first")
        self.buckets = int(found[NAME_BUCKETS_PROPERTY])

    @property
    def _id(self) -> str:
        return self.wh.qualified(self.table)

    def bucket_of(self, name: str) -> int:
        return zlib.crc32(name.encode("utf-8")) % self.buckets

    # -- writing
    def append(self, rows: Iterable[tuple]) -> set[int]:
        """Write events, one segment for each name bucket they fall into.  Returns these buckets."""
        at = self.schema.names.index(self.name)
        parts: dict[int, list[tuple]] = {}
        for row in rows:
            parts.setdefault(self.bucket_of(row[at]), []).append((*row, uuid.uuid4().hex))
        for bucket, part in parts.items():
            self._add(bucket, 0, self.spark.createDataFrame(part, self.schema).coalesce(1))  # a load's few events: one file
        return set(parts)

    def _add(self, bucket: int, level: int, events: DataFrame) -> None:
        segment = f"l{level}-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        path = f"{self.wh.root}/{self.table}/segments/{segment}"
        events.write.mode("errorifexists").parquet(path)
        self._register(bucket, segment, path)

    def _register(self, bucket: int, segment: str, path: str) -> None:
        self.spark.sql(f"ALTER TABLE {self._id} ADD IF NOT EXISTS {self._part(bucket, segment)} LOCATION {_text(path)}")

    @staticmethod
    def _part(bucket: int, segment: str | None = None) -> str:
        return f"PARTITION ({NAME_BUCKET} = {bucket}" + (f", {SEGMENT} = {_text(segment)})" if segment else ")")

    # -- reading
    def segments(self, bucket: int) -> list[str]:
        """Registered segments of a name bucket: a catalog listing, no files."""
        rows = self.spark.sql(f"SHOW PARTITIONS {self._id} {self._part(bucket)}").collect()
        return sorted(r[0].split("=")[-1] for r in rows)

    def is_empty(self, name: str) -> bool:
        return not self.spark.sql(f"SHOW PARTITIONS {self._id} {self._part(self.bucket_of(name))}").take(1)

    def scan(self, name: str | None = None) -> DataFrame:
        """Events, of one name if given (one name bucket is read).  An event may come twice; see ``read``."""
        df = scan_table(self.spark, self._id)
        if name is not None:
            df = df.where((F.col(NAME_BUCKET) == F.lit(self.bucket_of(name))) & (F.col(_q(self.name)) == F.lit(name)))
        return df.drop(NAME_BUCKET, SEGMENT)

    def once(self, events: DataFrame) -> DataFrame:
        """Each event once.  The name is part of the key, so that filters on it reach the scan."""
        return events.dropDuplicates([self.name, EVENT_ID])

    # -- maintenance
    def compact(self, bucket: int, segments: list[str] | None = None) -> None:
        """Make one segment of the listed ones (default: all of the bucket)."""
        listed = self.segments(bucket) if segments is None else segments
        if len(listed) < 2:
            return
        events = scan_table(self.spark, self._id).where((F.col(NAME_BUCKET) == F.lit(bucket)) & F.col(SEGMENT).isin(listed))
        files = 1 + events.count() // ROWS_A_FILE
        order = [_q(self.name), "kind", "at", "seq"]
        rows = self.once(events.drop(NAME_BUCKET, SEGMENT)).repartitionByRange(files, *order).sortWithinPartitions(*order)
        self._add(bucket, 1 + max(_level(s) for s in listed), rows)
        self._unregister(bucket, listed)

    def _unregister(self, bucket: int, segments: list[str]) -> None:
        self.spark.sql(f"ALTER TABLE {self._id} DROP IF EXISTS " + ", ".join(self._part(bucket, s) for s in segments))

    def compact_full_levels(self, bucket: int, at: int) -> None:
        """Compact each level of the bucket that holds ``at`` segments or more, from the lowest."""
        level = 0
        while True:
            here = [s for s in self.segments(bucket) if _level(s) == level]
            if len(here) < at:
                return
            self.compact(bucket, here)
            level += 1


def _level(segment: str) -> int:
    return int(segment[1:segment.index("-")])
