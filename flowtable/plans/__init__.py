from flowtable.plans.runner import destination_conflicts, duplicate_names, run_all, run_load
from flowtable.plans.spec import DestinationSpec, LoadSpec, QualitySpec, SourceSpec, TransformSpec
from flowtable.plans.state import RunState

__all__ = [
    "DestinationSpec",
    "LoadSpec",
    "QualitySpec",
    "RunState",
    "SourceSpec",
    "TransformSpec",
    "destination_conflicts",
    "duplicate_names",
    "run_all",
    "run_load",
]
