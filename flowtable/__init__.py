"""flowtable: declarative, incremental table loads as Spark DataFrame operators."""

from flowtable.errors import DataQualityError, SchemaDriftError, SourceError
from flowtable.operators.quality import Check, quality_report
from flowtable.operators.sinks import Warehouse
from flowtable.plans.runner import run_all, run_load
from flowtable.plans.spec import DestinationSpec, LoadSpec, QualitySpec, SourceSpec, TransformSpec
from flowtable.plans.state import RunState
from flowtable.streaming.available_now import stream_load

__all__ = [
    "Check",
    "DataQualityError",
    "DestinationSpec",
    "LoadSpec",
    "QualitySpec",
    "RunState",
    "SchemaDriftError",
    "SourceError",
    "SourceSpec",
    "TransformSpec",
    "Warehouse",
    "quality_report",
    "run_all",
    "run_load",
    "stream_load",
]
