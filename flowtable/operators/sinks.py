"""Sinks and DML on catalog tables stored as parquet snapshots.

A table is an external parquet table whose location is one snapshot directory.  Appends add
files to the current snapshot.  Everything that replaces rows (overwrite, upsert, update,
CTAS-replace) writes a *new* snapshot directory and then re-points the table with
``ALTER TABLE ... SET LOCATION`` -- one catalog call, so readers see the old or the new
snapshot, never an empty or half-written table, and a job that reads the table while
rewriting it is fine.

The frame-level operators (``align_by_name``, ``upsert_rows``, ``rows_absent_from``,
``update_rows``) are pure DataFrame -> DataFrame functions; ``Warehouse`` publishes them.
"""

from __future__ import annotations

import json
import re
import threading
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, IntegerType, MapType, StructField, StructType

from flowtable.functions.columns import col
from flowtable.operators.changes import first_by_key, latest_by_key
from flowtable.session import shared_root
from flowtable.sources.catalog import scan_table


# ----------------------------------------------------------------------------- frame operators


def align_by_name(df: DataFrame, schema: StructType) -> DataFrame:
    """Reorder/cast ``df`` to ``schema`` by column name; absent columns become NULL.

    A column of ``df`` that the target does not have is an error, as with
    ``INSERT INTO t (cols) SELECT cols``.
    """
    target = {f.name for f in schema.fields}
    extra = [c for c in df.columns if c not in target]
    if extra:
        raise ValueError(f"columns not in target table: {extra}; target has {[f.name for f in schema.fields]}")
    present = set(df.columns)
    return df.select(
        *[
            (col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def upsert_rows(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Insert new keys, update ``update_cols`` of existing keys, keep every other value.

    ``updates`` may carry a subset of the target's columns; columns it lacks stay as they
    were (or NULL for a new key).  With ``order_by``, repeated keys in ``updates`` are first
    reduced to their latest row (a map-side partial aggregate); otherwise keys must be unique.
    """
    keys = list(keys)
    unknown = [c for c in updates.columns if c not in target.columns]
    if unknown:
        raise ValueError(f"columns not in target table: {unknown}; target has {target.columns}")
    if order_by:
        updates = latest_by_key(updates, keys, order_by)
    upd_cols = [c for c in updates.columns if c not in keys]
    settable = set(upd_cols if update_cols is None else update_cols)
    t = target.select(*[col(k) for k in keys], *[col(c).alias(f"_t_{c}") for c in target.columns if c not in keys],
                      F.lit(True).alias("_t_hit"))
    u = updates.select(*[col(k) for k in keys], *[col(c).alias(f"_u_{c}") for c in upd_cols], F.lit(True).alias("_u_hit"))
    joined = t.join(u, keys, "full_outer")
    out = []
    for field in target.schema.fields:
        c = field.name
        if c in keys:
            out.append(col(c).cast(field.dataType).alias(c))
        elif c in upd_cols:
            take_new = F.col("_u_hit") & (F.col("_t_hit").isNull() | F.lit(c in settable))
            out.append(F.when(take_new, col(f"_u_{c}")).otherwise(col(f"_t_{c}")).cast(field.dataType).alias(c))
        else:
            out.append(col(f"_t_{c}").cast(field.dataType).alias(c))
    return joined.select(*out)


def rows_absent_from(
    target: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
) -> DataFrame:
    """Incoming rows whose key is not yet in ``target``: first row per key, then an anti join."""
    first = first_by_key(incoming, keys, order_by)
    return first.join(target.select(*[col(k) for k in keys]), list(keys), "left_anti")


def update_rows(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    set_cols: Mapping[str, str],
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """For keys present in ``updates``, set ``target[col] = updates[src]``.

    ``updates`` must hold one row per key, or ``order_by`` picks the latest row of each key
    (a map-side partial aggregate) so no target row is ever duplicated by the join.
    """
    keys = list(keys)
    if order_by:
        updates = latest_by_key(updates, keys, order_by)
    u = updates.select(*[col(k) for k in keys], *[col(src).alias(f"_u_{dst}") for dst, src in set_cols.items()],
                       F.lit(True).alias("_u_hit"))
    joined = target.join(u, keys, "left")
    out = []
    for field in target.schema.fields:
        c = field.name
        if c in set_cols:
            out.append(F.when(F.col("_u_hit"), col(f"_u_{c}")).otherwise(col(c)).cast(field.dataType).alias(c))
        else:
            out.append(col(c))
    return joined.select(*out)


def require_keys(df: DataFrame, keys: Sequence[str], unique: bool) -> None:
    """Raise when a key is NULL or, with ``unique``, occurs twice (one aggregate of the keys)."""
    null = F.lit(False)
    for k in keys:
        null = null | col(k).isNull()
    if not unique:
        bad = df.where(null).select(*[col(k) for k in keys])
    else:
        bad = df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("_n")).where(null | (F.col("_n") > 1))
    found = bad.take(1)
    if found:
        raise ValueError(f"keys {list(keys)} must not be NULL{' or repeated' if unique else ''}: found {found[0].asDict()}")


def nullable(schema: StructType) -> StructType:
    """The schema as stored in parquet files: every top-level column nullable."""
    return StructType([StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields])


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Attach a row counter that is filled in by whatever action runs next (no extra pass)."""
    obs = Observation(f"rows_{uuid.uuid4().hex}")
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


METRICS_WAIT_S = 20  # metrics are there as soon as the action ends, or never


def observed(obs: Observation) -> dict | None:
    """The metrics of an observation after its action ran; None when they do not arrive.

    Spark may replace a subtree it proves empty, observation node included, and a listener can lose
    an event; then asking fails or waits for ever.  A missing metric says nothing about the rows: the
    caller counts what was written.
    """
    found: list[dict] = []

    def ask() -> None:
        try:
            found.append(dict(obs.get))
        except Exception:  # noqa: BLE001 - any failure to deliver metrics means the same: not delivered
            pass

    asking = threading.Thread(target=ask, daemon=True)
    asking.start()
    asking.join(METRICS_WAIT_S)
    return found[0] if found else None


def observed_rows(obs: Observation, written: Callable[[], DataFrame]) -> int:
    """Rows that passed an observation, counted in ``written()`` when the metric is missing."""
    metrics = observed(obs)
    return int(metrics["rows"]) if metrics and metrics.get("rows") is not None else written().count()


# ----------------------------------------------------------------------------- warehouse


LOAD_ID = "_load_id"  # partition column of load-partitioned tables
BUCKET = "_bucket"  # partition column of keyed tables
KEYS_PROPERTY, BUCKETS_PROPERTY = "flowtable.keys", "flowtable.buckets"
_SAFE_ID = re.compile(r"^[A-Za-z0-9_.:-]+$")


@dataclass(frozen=True)
class Bucketing:
    """A keyed table's partitions: rows by the hash of their key columns."""

    columns: tuple[str, ...]
    buckets: int


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    """A string literal: a quote or backslash in a location or id can't end it."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ddl_type(dtype: DataType) -> str:
    """A type as DDL text, with every nested field name quoted."""
    if isinstance(dtype, StructType):
        return "struct<" + ",".join(f"{_q(f.name)}:{ddl_type(f.dataType)}" for f in dtype.fields) + ">"
    if isinstance(dtype, ArrayType):
        return f"array<{ddl_type(dtype.elementType)}>"
    if isinstance(dtype, MapType):
        return f"map<{ddl_type(dtype.keyType)},{ddl_type(dtype.valueType)}>"
    return dtype.simpleString()


def ddl_columns(schema: StructType, skip: tuple[str, ...] = ()) -> str:
    return ", ".join(f"{_q(f.name)} {ddl_type(f.dataType)}" for f in schema.fields if f.name not in skip)


class Warehouse:
    """A catalog database whose tables live as parquet snapshots under a shared root.

    Keyed tables (the targets of upsert, insert-if-absent and update) are partitioned by the hash
    of their key: a write reads and rewrites only the buckets that its keys fall into, and points
    the table at each new bucket.  Readers may see some buckets before others; a bucket is always
    whole.
    """

    def __init__(self, spark: SparkSession, database: str = "flowtable", root: str | None = None) -> None:
        """Open (or create) ``database``.  Table snapshots live under ``root``; by default under
        the database's existing location, or ``spark.sql.warehouse.dir`` for a new database."""
        self.spark = spark
        self.database = database
        if root is None:
            if spark.catalog.databaseExists(database):
                root = spark.catalog.getDatabase(database).locationUri
            else:
                root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{database}.db"
        self.root = root.rstrip("/")
        self._bucketing: dict[str, Bucketing | None] = {}
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_q(database)} LOCATION {_text(self.root)}")

    @classmethod
    def scratch(cls, spark: SparkSession, tag: str = "tmp") -> "Warehouse":
        """A fresh database in the shared scratch folder (tests and verification queries)."""
        database = f"ft_{tag}_{uuid.uuid4().hex[:10]}"
        return cls(spark, database, root=f"{shared_root(spark)}/flowtable-warehouse/{database}")

    # -- naming and lookup
    def qualified(self, table: str) -> str:
        return f"{_q(self.database)}.{_q(table)}"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.qualified(table))

    def read(self, table: str, load_id: bool = False) -> DataFrame:
        """Whole-table scan of the current snapshot (lazy); the load id only when asked for."""
        df = scan_table(self.spark, self.qualified(table))
        return df.drop(BUCKET) if load_id else df.drop(LOAD_ID, BUCKET)

    def schema(self, table: str) -> StructType:
        return self.read(table).schema

    def is_load_table(self, table: str) -> bool:
        """True for a table whose partitions are its loads."""
        return LOAD_ID in scan_table(self.spark, self.qualified(table)).columns

    def _describe(self, table: str) -> dict[str, str]:
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.qualified(table)}").collect()
        return {r["col_name"]: r["data_type"] for r in rows}

    def location(self, table: str) -> str:
        return self._describe(table)["Location"]

    def bucketing(self, table: str) -> Bucketing | None:
        if table not in self._bucketing:
            found = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.qualified(table)}").collect()}
            self._bucketing[table] = (Bucketing(tuple(json.loads(found[KEYS_PROPERTY])), int(found[BUCKETS_PROPERTY]))
                                      if KEYS_PROPERTY in found else None)
        return self._bucketing[table]

    def default_buckets(self) -> int:
        return int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def snapshot_path(self, table: str) -> str:
        return f"{self.root}/{table}/snap-{time.strftime('%Y%m%d%H%M%S')}-{uuid.uuid4().hex[:8]}"

    def stage_path(self, table: str, run_id: str) -> str:
        return f"{self.root}/{table}/stage-{run_id}-{uuid.uuid4().hex[:8]}"

    # -- DDL
    def _create(self, table: str, schema: StructType, path: str, bucketing: Bucketing | None) -> None:
        schema = nullable(schema)
        if bucketing is None:
            self.spark.catalog.createTable(self.qualified(table), path=path, source="parquet", schema=schema)
        else:
            self.spark.sql(
                f"CREATE TABLE {self.qualified(table)} ({ddl_columns(schema)}, {_q(BUCKET)} INT) USING parquet "
                f"PARTITIONED BY ({_q(BUCKET)}) LOCATION {_text(f'{self.root}/{table}/keyed')} TBLPROPERTIES "
                f"({_text(KEYS_PROPERTY)} = {_text(json.dumps(bucketing.columns))}, {_text(BUCKETS_PROPERTY)} = '{bucketing.buckets}')"
            )
        self._bucketing[table] = bucketing

    @staticmethod
    def _bucketed(df: DataFrame, bucketing: Bucketing) -> DataFrame:
        """``df`` with the bucket of each row as its last column."""
        keys = F.xxhash64(*[col(c) for c in bucketing.columns])
        return df.withColumn(BUCKET, F.pmod(keys, F.lit(bucketing.buckets)).cast("int"))

    def write_snapshot(self, df: DataFrame, path: str, bucketing: Bucketing | None) -> None:
        """Write files for a snapshot, for a keyed table one folder for each bucket.  The rebalance
        gives a bucket few files and splits one that a repeated key makes too large for a task."""
        if bucketing is None:
            df.write.mode("errorifexists").parquet(path)
        else:
            rows = self._bucketed(df, bucketing).hint("rebalance", BUCKET)
            rows.write.mode("errorifexists").partitionBy(BUCKET).parquet(path)

    def _point_buckets(self, table: str, path: str, whole: bool) -> None:
        """Point the table at the buckets written below ``path``; with ``whole`` drop all others."""
        schema = StructType([StructField(BUCKET, IntegerType())])
        written = {r[0] for r in self.spark.read.schema(schema).parquet(path).distinct().collect()}  # at most one for each bucket
        there = {int(r[0].split("=")[1]) for r in self.spark.sql(f"SHOW PARTITIONS {self.qualified(table)}").collect()}
        part = lambda b: f"PARTITION ({_q(BUCKET)} = {b})"
        to = lambda b: f"LOCATION {_text(f'{path}/{BUCKET}={b}')}"
        alter = f"ALTER TABLE {self.qualified(table)}"
        if written - there:
            self.spark.sql(f"{alter} ADD " + " ".join(f"{part(b)} {to(b)}" for b in sorted(written - there)))
        for b in sorted(written & there):
            self.spark.sql(f"{alter} {part(b)} SET {to(b)}")
        if whole and there - written:
            self.spark.sql(f"{alter} DROP " + ", ".join(part(b) for b in sorted(there - written)))
        self.spark.catalog.refreshTable(self.qualified(table))

    def _touched(self, table: str, rows: DataFrame) -> tuple[DataFrame, list[int]]:
        """The rows of the buckets that the keys of ``rows`` fall into, and those buckets."""
        bucketing, types = self.bucketing(table), self.schema(table)
        keys = rows.select(*[col(c).cast(types[c].dataType).alias(c) for c in bucketing.columns])
        buckets = sorted(r[0] for r in self._bucketed(keys, bucketing).select(BUCKET).distinct().collect())
        full = scan_table(self.spark, self.qualified(table))
        return full.where(F.col(BUCKET).isin(buckets)).drop(BUCKET), buckets

    def _replace_buckets(self, table: str, rows: DataFrame) -> int:
        """Publish the new content of whole buckets.  Returns rows written."""
        aligned, obs = counted(align_by_name(rows, self.schema(table)))
        path = self.snapshot_path(table)
        self.write_snapshot(aligned, path, self.bucketing(table))
        self._point_buckets(table, path, whole=False)
        return observed_rows(obs, lambda: self.spark.read.parquet(path))

    def ensure_table(
        self, table: str, schema: StructType, bucket_by: Sequence[str] | None = None, buckets: int | None = None
    ) -> bool:
        """Create the table with ``schema`` if absent (zero rows).  True if it was created."""
        if self.exists(table):
            return False
        bucketing = Bucketing(tuple(bucket_by), buckets or self.default_buckets()) if bucket_by else None
        # no data is written: the snapshot folder appears with the first append
        self._create(table, schema, self.snapshot_path(table), bucketing)
        return True

    def drop(self, table: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.qualified(table)}")
        self._bucketing.pop(table, None)

    def adopt(self, table: str, path: str, schema: StructType, bucketing: Bucketing | None = None) -> None:
        """Publish an already written snapshot directory as the table's content.

        One catalog call (one for each bucket of a keyed table), unless the schema changes: then the
        entry is dropped and created.

        The files at ``path`` must be laid out with ``bucketing`` (the table's, if it exists).
        """
        schema = nullable(schema)
        if not self.exists(table):
            self._create(table, schema, path, bucketing)
            if bucketing:
                self._point_buckets(table, path, whole=True)
            return
        self._refuse_rewrite(table)
        if self.schema(table) != schema:
            # a replace that changes the schema must recreate the catalog entry: two catalog calls,
            # between which a reader finds no table
            self.drop(table)
            self.adopt(table, path, schema, bucketing)
            return
        if bucketing:
            self._point_buckets(table, path, whole=True)
            return
        self.spark.sql(f"ALTER TABLE {self.qualified(table)} SET LOCATION {_text(path)}")
        self.spark.sql(f"REFRESH TABLE {self.qualified(table)}")

    def _refuse_rewrite(self, table: str) -> None:
        if self.is_load_table(table):
            raise ValueError(f"{table} is load-partitioned: it takes appends only (each load is a partition)")

    # -- loads
    def append(self, table: str, df: DataFrame) -> int:
        """Append by column name (absent target columns NULL).  Returns rows written.
        """
        self.ensure_table(table, df.schema)
        schema = self.schema(table)
        if self.is_load_table(table):  # the rows become one new load
            out, obs = counted(align_by_name(df, schema))
            load_id = f"append-{uuid.uuid4().hex}"
            path = self.load_path(table, load_id)
            out.write.mode("errorifexists").parquet(path)
            self.publish_load(table, load_id, path, schema)
            return observed_rows(obs, lambda: self.spark.read.parquet(path))
        aligned, obs = counted(align_by_name(df, schema))
        b = self.bucketing(table)
        if b is None:
            # add files to the current snapshot folder, then drop cached listings of the table
            aligned.write.mode("append").parquet(self.location(table))
            self.spark.catalog.refreshTable(self.qualified(table))
        else:
            self._bucketed(aligned, b).hint("rebalance", BUCKET).write.mode("append").insertInto(self.qualified(table))
        return observed_rows(obs, lambda: df)

    def overwrite(
        self,
        table: str,
        df: DataFrame,
        bucket_by: Sequence[str] | None = None,
        buckets: int | None = None,
    ) -> int:
        """Replace all rows atomically (new snapshot + location swap).  Returns rows written.

        An existing table keeps its schema (rows are aligned by name) and bucketing; a new one
        is bucketed by ``bucket_by`` when given.
        """
        if self.exists(table):
            self._refuse_rewrite(table)
            schema, bucketing = self.schema(table), self.bucketing(table)
        else:
            schema = df.schema
            bucketing = Bucketing(tuple(bucket_by), buckets or self.default_buckets()) if bucket_by else None
        aligned, obs = counted(align_by_name(df, schema))
        path = self.snapshot_path(table)
        self.write_snapshot(aligned, path, bucketing)
        self.adopt(table, path, schema, bucketing)
        return observed_rows(obs, lambda: self.spark.read.parquet(path))

    def compact(self, table: str, files: int | None = None) -> int:
        """Rewrite the table into fewer, larger files (after many small appends).

        A keyed table gets few files for each bucket; otherwise ``files`` files, or whatever the
        read splits (``spark.sql.files.maxPartitionBytes``) give when ``files`` is None.
        """
        df = self.read(table)
        if files is not None and self.bucketing(table) is None:
            df = df.repartition(files)
        return self.overwrite(table, df)

    def replace(self, table: str, df: DataFrame) -> int:
        """CREATE OR REPLACE TABLE ... AS: publish ``df`` with its own schema."""
        if self.exists(table):
            self._refuse_rewrite(table)
        bucketing = self.bucketing(table) if self.exists(table) else None
        if bucketing is not None and not set(bucketing.columns) <= set(df.columns):
            bucketing = None
        path = self.snapshot_path(table)
        out, obs = counted(df)
        self.write_snapshot(out, path, bucketing)
        self.adopt(table, path, nullable(df.schema), bucketing)
        return observed_rows(obs, lambda: self.spark.read.parquet(path))

    def upsert(
        self,
        table: str,
        updates: DataFrame,
        keys: Sequence[str],
        update_cols: Sequence[str] | None = None,
        order_by: Sequence[str] | None = None,
        buckets: int | None = None,
    ) -> int:
        """Key upsert.  Returns rows written.

        A table created here is keyed by ``keys``, and only the buckets of the updates' keys are read
        and rewritten; a table that is not keyed by them is rewritten as a whole.  Keys must not be
        NULL; without ``order_by``, which picks the latest row of a repeated key, they must be unique.
        """
        require_keys(updates, keys, unique=not order_by)
        self.ensure_table(table, updates.schema, bucket_by=keys, buckets=buckets)
        if not self._keyed_by(table, keys):
            return self.overwrite(table, upsert_rows(self.read(table), updates, keys, update_cols, order_by))
        current, _ = self._touched(table, updates)
        return self._replace_buckets(table, upsert_rows(current, updates, keys, update_cols, order_by))

    def insert_if_absent(
        self, table: str, incoming: DataFrame, keys: Sequence[str], order_by: Sequence[str], buckets: int | None = None
    ) -> int:
        """Append the first incoming row of each key not yet in the table (keys must not be NULL).
        Returns rows added."""
        require_keys(incoming, keys, unique=False)
        self.ensure_table(table, incoming.schema, bucket_by=keys, buckets=buckets)
        current = self._touched(table, incoming)[0] if self._keyed_by(table, keys) else self.read(table)
        return self.append(table, rows_absent_from(current, incoming, keys, order_by))

    def update_by_key(
        self,
        table: str,
        updates: DataFrame,
        keys: Sequence[str],
        set_cols: Mapping[str, str],
        order_by: Sequence[str] | None = None,
    ) -> int:
        """Set columns of existing keys.  Returns rows written: those of the buckets that the updates'
        keys fall into, or of a table that is not keyed by them.

        Keys must not be NULL; without ``order_by`` they must be unique in ``updates``."""
        require_keys(updates, keys, unique=not order_by)
        if not self._keyed_by(table, keys):
            return self.overwrite(table, update_rows(self.read(table), updates, keys, set_cols, order_by))
        current, _ = self._touched(table, updates)
        return self._replace_buckets(table, update_rows(current, updates, keys, set_cols, order_by))

    def _keyed_by(self, table: str, keys: Sequence[str]) -> bool:
        b = self.bucketing(table)
        return b is not None and tuple(b.columns) == tuple(keys)

    # -- load-partitioned tables: every load is one partition, published without a copy
    def load_path(self, table: str, load_id: str) -> str:
        """Where an attempt of a load writes its rows: a fresh folder for every attempt, outside the
        table folder, so an unpublished attempt is invisible to any listing of the table."""
        return f"{self.root}/{table}/loads/{load_id}-{uuid.uuid4().hex[:8]}"

    def has_load(self, table: str, load_id: str) -> bool:
        """Whether a load with this id is published."""
        if not self.exists(table) or not self.is_load_table(table):
            return False
        wanted = f"SHOW PARTITIONS {self.qualified(table)} PARTITION ({_q(LOAD_ID)} = {_text(load_id)})"
        return bool(self.spark.sql(wanted).take(1))

    def loads(self, table: str, prefix: str = "") -> list[str]:
        """Ids of the published loads that begin with ``prefix`` (catalog entries), sorted."""
        if not self.exists(table) or not self.is_load_table(table):
            return []
        rows = self.spark.sql(f"SHOW PARTITIONS {self.qualified(table)}").collect()
        ids = (unquote(r[0].split("=", 1)[1]) for r in rows)
        return sorted(i for i in ids if i.startswith(prefix))

    def read_load(self, table: str, load_id: str) -> DataFrame:
        """The rows of one published load."""
        return self.read(table, load_id=True).where(F.col(LOAD_ID) == F.lit(load_id)).drop(LOAD_ID)

    def ensure_load_table(self, table: str, schema: StructType) -> bool:
        """Create a table partitioned by ``_load_id`` (columns of ``schema`` + the load id)."""
        if self.exists(table):
            return False
        cols = ddl_columns(schema, skip=(LOAD_ID,))
        self.spark.sql(
            f"CREATE TABLE {self.qualified(table)} ({cols}, {_q(LOAD_ID)} STRING) USING parquet "
            f"PARTITIONED BY ({_q(LOAD_ID)}) LOCATION {_text(f'{self.root}/{table}/data')}"
        )
        self._bucketing[table] = None
        return True

    def publish_load(self, table: str, load_id: str, path: str, schema: StructType) -> None:
        """Register the files at ``path`` as the table's partition ``load_id`` (atomic, zero copy).

        An id is published once: a second attempt leaves the first one's rows in place.  As with a by-name insert, columns the table does not have are an error; columns the
        load lacks read as NULL.
        """
        if not _SAFE_ID.match(load_id):
            raise ValueError(f"unsafe load id: {load_id!r}")
        self.ensure_load_table(table, schema)
        known = set(self.read(table, load_id=True).columns)
        extra = [f.name for f in schema.fields if f.name not in known]
        if extra:
            raise ValueError(f"columns not in target table: {extra}; target has {sorted(known)}")
        self.spark.sql(f"ALTER TABLE {self.qualified(table)} ADD IF NOT EXISTS PARTITION ({_q(LOAD_ID)} = {_text(load_id)}) "
                       f"LOCATION {_text(path)}")
        self.spark.catalog.refreshTable(self.qualified(table))

    def execute(self, sql: str, params=None) -> DataFrame:
        """Run one statement with bound parameters in this database (values never enter the text)."""
        previous = self.spark.catalog.currentDatabase()
        self.spark.catalog.setCurrentDatabase(self.database)
        try:
            return self.spark.sql(sql, args=params) if params else self.spark.sql(sql)
        finally:
            self.spark.catalog.setCurrentDatabase(previous)

    def replace_from_sql(self, table: str, select_sql: str, params=None) -> int:
        """Rebuild a derived table from a SELECT (CTAS replace)."""
        df = self.spark.sql(select_sql, args=params) if params else self.spark.sql(select_sql)
        return self.replace(table, df)
