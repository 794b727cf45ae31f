"""The specification of one table load (a plain argument object; no file format attached)."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from flowtable.operators.quality import Check
from flowtable.operators.refresh import GroupTable, Measure, RowTable

LOAD_MODES = ("append", "overwrite")


@dataclass
class SourceSpec:
    type: str  # csv | json | parquet | api (landed JSON arrays)
    path: str | None = None
    endpoint: str | None = None
    incremental_key: str | None = None
    partition_column: str | None = None  # partition column holding CAST(incremental_key AS its type)
    # rows that come late: an interval ("36 hours") or a number below the mark that is looked at again, and the
    # columns that tell rows apart there (default: all)
    look_back: str | None = None
    unique_key: list[str] = field(default_factory=list)
    # a folder of landed files: keep the ends of each file's keys and open only files that reach above the mark
    zone_map: bool = False
    options: dict[str, str] = field(default_factory=dict)
    schema: Any = None  # StructType or DDL string; None infers
    pin_schema: bool = True  # CSV without a schema: later runs read with the stored types

    @property
    def identifier(self) -> str:
        return self.path or self.endpoint or "unknown"


@dataclass
class DestinationSpec:
    schema: str
    table: str
    # an append load is published as a partition of its own: written once, and once for each run id
    load_partitions: bool = True

    @property
    def physical(self) -> str:
        return f"{self.schema}_{self.table}"


@dataclass
class QualitySpec:
    enabled: bool = False
    checks: list[Check] = field(default_factory=list)


@dataclass
class TransformSpec:
    sql: str | None = None  # SQL text or a .sql path
    target: str | None = None  # table for a bare SELECT
    # tables that follow the destination load by load, instead of a rebuild after each
    derived: list[RowTable | GroupTable] = field(default_factory=list)


def _derived(d: dict[str, Any]) -> RowTable | GroupTable:
    """``columns`` make a row table; ``keys`` and ``measures`` (``kind`` and ``expr`` each) a group table."""
    if "columns" in d:
        return RowTable(d["target"], d["columns"], d.get("where"))
    measures = {n: Measure(m["kind"], m.get("expr")) for n, m in (d.get("measures") or {}).items()}
    return GroupTable(d["target"], d.get("keys") or {}, measures, d.get("where"))


@dataclass
class LoadSpec:
    name: str
    owner: str
    source: SourceSpec
    destination: DestinationSpec
    load_mode: str = "append"
    schedule: str | None = None
    quality: QualitySpec = field(default_factory=QualitySpec)
    transform: TransformSpec | None = None
    notify_on_failure: bool = True  # call run_load's on_failure callback for a failed load
    runtime_parameters: dict[str, Any] = field(default_factory=dict)  # kept, not interpreted

    def __post_init__(self) -> None:
        if self.load_mode not in LOAD_MODES:
            raise ValueError(f"load_mode must be one of {LOAD_MODES}, got {self.load_mode!r}")
        if self.source.look_back and (self.load_mode != "append" or not self.source.incremental_key or self.source.partition_column):
            raise ValueError("a look-back needs an append load with an incremental key and no partition column")
        if self.source.zone_map:
            if not self.source.incremental_key or not self.source.path or self.source.look_back or self.source.partition_column:
                raise ValueError("a zone map needs a path and an incremental key, and no look-back or partition column")
            if self.source.type not in ("csv", "json", "parquet") or (self.source.type != "parquet" and self.source.schema is None):
                raise ValueError("a zone map needs parquet files, or csv or json files with a schema: types can't hang on the files read")
        if self.transform and self.transform.derived and (self.load_mode != "append" or not self.destination.load_partitions):
            raise ValueError("derived tables follow the loads of a load-partitioned append destination")

    def tracked_fields(self) -> dict[str, Any]:
        """Fields whose change makes a new recorded version of the spec.

        Fixed values: the snapshot's key names, kept as the original tool names them.
        """
        return {
            "pipeline_name": self.name,
            "owner": self.owner,
            "source_type": self.source.type,
            "source_path": self.source.path,
            "source_endpoint": self.source.endpoint,
            "incremental_key": self.source.incremental_key,
            "destination_schema": self.destination.schema,
            "destination_table": self.destination.table,
            "schedule_cron": self.schedule,
            "load_mode": self.load_mode,
        }

    @classmethod
    def from_dict(cls, d: dict[str, Any]) -> "LoadSpec":
        """Build from an already-parsed mapping (e.g. a YAML document loaded by the caller).

        Fixed values: the document's key names, so that existing documents keep working.
        """
        src = d["source"]
        qc = d.get("quality_checks") or {}
        tr = d.get("transform") or {}
        return cls(
            name=d["pipeline_name"],
            owner=d.get("owner", ""),
            source=SourceSpec(
                type=src["type"],
                path=src.get("path"),
                endpoint=src.get("endpoint"),
                incremental_key=src.get("incremental_key"),
                partition_column=src.get("partition_column"),
                look_back=None if src.get("look_back") is None else str(src["look_back"]),
                unique_key=list(src.get("unique_key") or []),
                zone_map=bool(src.get("zone_map", False)),
                options=src.get("options") or {},
                schema=src.get("schema"),
            ),
            destination=DestinationSpec(
                d["destination"]["schema"], d["destination"]["table"], bool(d["destination"].get("load_partitions", True))
            ),
            load_mode=d.get("load_mode", "append"),
            schedule=(d.get("schedule") or {}).get("cron"),
            quality=QualitySpec(
                enabled=bool(qc.get("enabled", False)),
                checks=[
                    Check(c["name"], c.get("column"), c["rule"], c.get("value"), tuple(c.get("formats") or ()))
                    for c in qc.get("checks") or []
                ],
            ),
            transform=TransformSpec(sql=tr.get("sql"), target=tr.get("target"),
                                    derived=[_derived(x) for x in tr.get("derived") or []]) if tr else None,
            notify_on_failure=bool((d.get("notify") or {}).get("on_failure", False)),
            runtime_parameters=dict(d.get("runtime_parameters") or {}),
        )
