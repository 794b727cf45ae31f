"""Zone map of landed files: the least and greatest incremental key of each file, kept beside the marks.

An incremental load of a folder opens only files that can hold rows above the mark.  A file is known by its
path, size and modification time; one that is new or was rewritten has no zone yet and is read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from flowtable.errors import SourceError
from flowtable.functions.columns import col
from flowtable.operators.incremental import mark_text, require_key
from flowtable.operators.sinks import Warehouse
from flowtable.sources.files import missing_path, read_source

ZONES_TABLE = "meta_zones"
_FILE = ["file", "size", "modified"]
ZONES = StructType([
    StructField("pipeline_name", StringType()), StructField("incremental_key", StringType()), StructField("key_type", StringType()),
    StructField("file", StringType()), StructField("size", LongType()), StructField("modified", TimestampType()),
    StructField("low", StringType()), StructField("high", StringType()),
])
_PARTITION = re.compile(r"/[^/=]+=[^/]*/")
_LISTING = ("recursiveFileLookup", "pathGlobFilter", "modifiedBefore", "modifiedAfter")


@dataclass
class LandedFiles:
    """What a load reads of a folder: ``rows`` of ``opened`` files; ``unmeasured`` of them have no zone yet."""

    rows: DataFrame
    opened: list[str]
    skipped: int
    unmeasured: DataFrame
    unmeasured_paths: list[str]


def _listing(warehouse: Warehouse, source) -> DataFrame:
    """``path, file, size, modified`` of the files in the source's folder; their content is not read."""
    options = {k: v for k, v in source.options.items() if k in _LISTING}
    found = missing_path(lambda: warehouse.spark.read.format("binaryFile").options(**options).load(source.path), source.path, source.type)
    return found.select("path", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
                        F.col("_metadata.file_modification_time").alias("modified"))


def _zones(warehouse: Warehouse, name: str, key: str) -> DataFrame:
    warehouse.ensure_table(ZONES_TABLE, ZONES)
    return warehouse.read(ZONES_TABLE).where((F.col("pipeline_name") == F.lit(name)) & (F.col("incremental_key") == F.lit(key)))


def landed_files(warehouse: Warehouse, name: str, source, mark: str | None) -> LandedFiles:
    """The source without the files that hold no key above ``mark``.

    Rows with a NULL key are never loaded, so a file without any key is not opened again.  A zone counts
    only for the type that the key has now.  The names of the files left to open reach the driver, as they do
    with any file scan; names must not hold glob characters.
    """
    spark, key = warehouse.spark, source.incremental_key
    listing, zones = _listing(warehouse, source), _zones(warehouse, name, key)
    below = F.lit(False)
    if mark is not None:
        none = spark.createDataFrame([], source.schema) if source.schema is not None else read_source(spark, source)
        require_key(none, key)
        dtype = none.schema[key].dataType
        below = (F.col("key_type") == dtype.simpleString()) & (F.col("high").isNull() | (F.col("high").cast(dtype) <= F.lit(mark).cast(dtype)))
    state = zones.groupBy(*_FILE).agg(F.bool_or(below).alias("below"), F.lit(True).alias("known"))
    files = listing.join(state, _FILE, "left").select(
        "path", *_FILE, F.coalesce("below", F.lit(False)).alias("below"), F.coalesce("known", F.lit(False)).alias("known"))
    wanted = files.where(~F.col("below")).select("path", "known").orderBy("path").collect()
    skipped = files.where("below").count()
    paths = [r["path"] for r in wanted]
    folders = next((p for p in paths if _PARTITION.search(p.rpartition(source.path.rstrip("/"))[2])), None)
    if folders:
        raise SourceError(f"a zone map needs a folder of files without partition folders, found {folders}")
    if paths:
        rows = read_source(spark, replace(source, path=paths))
    elif source.schema is not None:
        rows = spark.createDataFrame([], source.schema)
    else:
        rows = read_source(spark, source).where(F.lit(False))
    return LandedFiles(rows, paths, skipped, files.where(~F.col("known")).select(*_FILE), [r["path"] for r in wanted if not r["known"]])


def record_zones(warehouse: Warehouse, name: str, source, landed: LandedFiles) -> None:
    """Store the zones of the files that had none: one pass over these files, of the key alone where the format allows."""
    if not landed.unmeasured_paths:
        return
    key = source.incremental_key
    rows = read_source(warehouse.spark, replace(source, path=landed.unmeasured_paths))
    dtype = rows.schema[key].dataType
    ends = rows.groupBy(F.input_file_name().alias("file")).agg(
        mark_text(F.min(col(key)), dtype).alias("low"), mark_text(F.max(col(key)), dtype).alias("high"))
    zones = landed.unmeasured.join(ends, "file", "left").select(
        F.lit(name).alias("pipeline_name"), F.lit(key).alias("incremental_key"), F.lit(dtype.simpleString()).alias("key_type"),
        *_FILE, "low", "high")
    warehouse.append(ZONES_TABLE, zones)
