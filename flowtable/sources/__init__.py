from flowtable.sources.catalog import as_relation, run_query, scan_table
from flowtable.sources.files import (
    read_csv,
    read_json,
    read_parquet,
    read_source,
    write_json_lines,
)

__all__ = [
    "as_relation",
    "read_csv",
    "read_json",
    "read_parquet",
    "read_source",
    "run_query",
    "scan_table",
    "write_json_lines",
]
