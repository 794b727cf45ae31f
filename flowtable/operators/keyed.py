"""Keyed tables whose small updates write in proportion to the update.

The rows lie in a base, partitioned by the hash of the key, and in deltas, one folder for each write.  Readers see
a view: a row counts unless a later delta has its key (an anti join against the deltas' keys, which Spark
broadcasts while they are small, so that the base is read without a shuffle).  An upsert of whole rows reads
nothing; one of some columns, an update and an insert of absent keys read the deltas and those buckets of the
base that may hold one of their keys.  Which may is asked of a Bloom filter of each bucket's keys.

A write is one catalog call.  ``merge_deltas`` makes one delta of many and ``compact`` folds them into the base;
both publish what they made before they drop what it replaces, and a row that is there twice meanwhile is the same
row, so a reader or a crash between the two calls changes nothing.  One writer a table, as with all tables.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from flowtable.functions.columns import col
from flowtable.operators.changes import first_by_key, latest_by_key
from flowtable.operators.sinks import (
    BUCKET,
    Warehouse,
    _q,
    _text,
    align_by_name,
    counted,
    ddl_columns,
    nullable,
    observed_rows,
    require_keys,
    update_rows,
    upsert_rows,
)
from flowtable.sources.catalog import scan_table

VERSION = "_version"  # 0: the base; otherwise the time of a delta
DELTA_BUCKET = -1
PAGE_BITS = 32768  # of a filter page, the size of Spark's bitmaps
KEY_BITS, KEY_PROBES = 10, 7  # about 1 % of absent keys pass


class KeyedTable:
    """One row for each key.  ``table`` is the view to read; its parts lie beside it."""

    def __init__(self, warehouse: Warehouse, table: str, keys: Sequence[str], schema: StructType | None = None,
                 buckets: int | None = None, merge_at: int = 16) -> None:
        """Open the table, or create it with ``schema``.  ``merge_at``: make one delta of that many (0: never)."""
        self.wh, self.spark, self.table, self.keys, self.merge_at = warehouse, warehouse.spark, table, list(keys), merge_at
        self.rows_table, self.filters_table = f"{table}__rows", f"{table}__filters"
        if not warehouse.exists(self.rows_table):
            if schema is None:
                raise ValueError(f"no keyed table {table}: give its schema to create it")
            lacking = [k for k in self.keys if k not in schema.names]
            if lacking or not self.keys:
                raise ValueError(f"keys {lacking or self.keys} not in columns {schema.names}")
            self._create(nullable(schema), buckets or warehouse.default_buckets())
        found = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self._rows_id}").collect()}
        if found["flowtable.keys"] != ",".join(map(_q, self.keys)):
            raise ValueError(f"{table} is keyed by {found['flowtable.keys']}")
        self.buckets = int(found["flowtable.buckets"])
        self.schema = StructType([f for f in scan_table(self.spark, self._rows_id).schema.fields if f.name not in (BUCKET, VERSION)])

    @property
    def _rows_id(self) -> str:
        return self.wh.qualified(self.rows_table)

    def _create(self, schema: StructType, buckets: int) -> None:
        key_list = ",".join(map(_q, self.keys))
        self.spark.sql(f"CREATE TABLE {self._rows_id} ({ddl_columns(schema)}, {BUCKET} INT, {VERSION} BIGINT) USING parquet "
                       f"PARTITIONED BY ({BUCKET}, {VERSION}) LOCATION {_text(f'{self.wh.root}/{self.rows_table}/data')} "
                       f"TBLPROPERTIES ('flowtable.keys' = {_text(key_list)}, 'flowtable.buckets' = '{buckets}')")
        self.spark.sql(f"CREATE TABLE {self.wh.qualified(self.filters_table)} (bits BIGINT, page BIGINT, bitmap BINARY, {BUCKET} INT) "
                       f"USING parquet PARTITIONED BY ({BUCKET}) LOCATION {_text(f'{self.wh.root}/{self.filters_table}/data')}")
        same = " AND ".join(f"r.{_q(k)} = d.{_q(k)}" for k in self.keys)
        self.spark.sql(
            f"CREATE VIEW {self.wh.qualified(self.table)} AS SELECT {', '.join(f'r.{_q(c)}' for c in schema.names)} FROM {self._rows_id} r "
            f"LEFT ANTI JOIN (SELECT {key_list}, max({VERSION}) AS {VERSION} FROM {self._rows_id} WHERE {VERSION} > 0 GROUP BY {key_list}) d "
            f"ON {same} AND r.{VERSION} < d.{VERSION}")

    # -- reading
    def read(self) -> DataFrame:
        return self.wh.read(self.table)

    def deltas(self) -> list[int]:
        rows = self.spark.sql(f"SHOW PARTITIONS {self._rows_id} PARTITION ({BUCKET} = {DELTA_BUCKET})").collect()
        return sorted(int(r[0].rsplit("=", 1)[1]) for r in rows)

    def _base_buckets(self) -> set[int]:
        rows = self.spark.sql(f"SHOW PARTITIONS {self._rows_id} PARTITION ({VERSION} = 0)").collect()
        return {int(r[0].split("/")[0].split("=")[1]) for r in rows}

    def _latest(self, parts: DataFrame) -> DataFrame:
        """The rows of ``parts`` (with their versions) that no delta replaces."""
        deltas = scan_table(self.spark, self._rows_id).where(F.col(VERSION) > 0)
        newer = deltas.groupBy(*[col(k).alias(f"_k{i}") for i, k in enumerate(self.keys)]).agg(F.max(VERSION).alias("_newest"))
        same = F.col(VERSION) < F.col("_newest")
        for i, k in enumerate(self.keys):
            same = same & (col(k) == F.col(f"_k{i}"))
        return parts.join(newer, same, "left_anti").select(*[col(c) for c in self.schema.names])

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The rows whose key is in ``keys``: of the base, only buckets that may hold one are read."""
        keys = self._typed_keys(keys)
        parts = scan_table(self.spark, self._rows_id).where((F.col(VERSION) > 0) | F.col(BUCKET).isin(self.buckets_asked(keys)))
        return self._latest(parts.join(keys.distinct(), self.keys, "left_semi"))

    def buckets_asked(self, keys: DataFrame) -> list[int]:
        """Buckets of the base whose filter says that they may hold one of the keys."""
        keys = self._typed_keys(keys)
        pages = scan_table(self.spark, self.wh.qualified(self.filters_table))
        sizes = pages.select(F.col(BUCKET).alias("_b"), F.col("bits").alias("_bits")).distinct()  # one row for each bucket
        asked = (keys.distinct().withColumn(BUCKET, self._bucket()).join(F.broadcast(sizes), F.col(BUCKET) == F.col("_b"))
                 .select("_b", self._hash(0).alias("_key"), self._positions(F.col("_bits")))
                 .select("_b", "_key", "probe", (F.col("at") / PAGE_BITS).cast("long").alias("_page"), (F.col("at") % PAGE_BITS).cast("int").alias("bit")))
        found = asked.join(pages, (F.col("_b") == F.col(BUCKET)) & (F.col("_page") == F.col("page")))
        byte = F.conv(F.hex(F.substring("bitmap", F.expr("bit div 8 + 1"), F.lit(1))), 16, 10).cast("int")
        hits = found.where(F.expr("bit % 8") >= 0).withColumn("_byte", byte).where(F.expr("(shiftright(_byte, bit % 8) & 1) = 1"))
        maybe = hits.groupBy("_b", "_key").agg(F.count_distinct("probe").alias("n")).where(F.col("n") == KEY_PROBES)
        return sorted(r[0] for r in maybe.select("_b").distinct().collect())  # at most one for each bucket

    def _typed_keys(self, df: DataFrame) -> DataFrame:
        return df.select(*[col(k).cast(self.schema[k].dataType).alias(k) for k in self.keys])

    def _hash(self, seed: int) -> Column:
        return F.xxhash64(*[col(k) for k in self.keys], F.lit(seed))

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[col(k) for k in self.keys]), F.lit(self.buckets)).cast("int")

    def _positions(self, bits: Column) -> Column:
        """``probe`` and ``at``: the bits of a key, by double hashing."""
        a, b = (F.pmod(self._hash(seed), F.lit(1 << 31)) for seed in (1, 2))
        return F.posexplode(F.array(*[F.pmod(a + i * (b + 1), bits) for i in range(KEY_PROBES)])).alias("probe", "at")

    # -- writing
    def _publish_delta(self, rows: DataFrame) -> int:
        """Rows, one for each key, as the next delta.  Returns rows written."""
        out, obs = counted(align_by_name(rows, self.schema))
        version = max([time.time_ns(), *(v + 1 for v in self.deltas())])
        path = f"{self.wh.root}/{self.rows_table}/deltas/{version}-{uuid.uuid4().hex[:8]}"
        out.write.mode("errorifexists").parquet(path)
        n = observed_rows(obs, lambda: self.spark.read.schema(self.schema).parquet(path))
        if n:
            self._add([(DELTA_BUCKET, version, path)])
            if self.merge_at and len(self.deltas()) >= self.merge_at:
                self.merge_deltas()
        return n

    def _add(self, parts: list[tuple[int, int, str]]) -> None:
        self.spark.sql(f"ALTER TABLE {self._rows_id} ADD " + " ".join(
            f"PARTITION ({BUCKET} = {b}, {VERSION} = {v}) LOCATION {_text(path)}" for b, v, path in parts))
        self.spark.catalog.refreshTable(self._rows_id)

    def _drop(self, versions: list[int]) -> None:
        if versions:
            self.spark.sql(f"ALTER TABLE {self._rows_id} DROP IF EXISTS " + ", ".join(
                f"PARTITION ({BUCKET} = {DELTA_BUCKET}, {VERSION} = {v})" for v in versions))
            self.spark.catalog.refreshTable(self._rows_id)

    def upsert(self, updates: DataFrame, update_cols: Sequence[str] | None = None, order_by: Sequence[str] | None = None) -> int:
        """Insert new keys and replace the given columns of known ones.  Returns rows written.

        Keys must not be NULL; without ``order_by``, which picks the latest row of a repeated key, they must be
        unique.  Whole rows are written without reading the table; an empty table is written as its base."""
        require_keys(updates, self.keys, unique=not order_by)
        if order_by:
            updates = latest_by_key(updates, self.keys, order_by)
        rest = set(self.schema.names) - set(self.keys)
        if not self._base_buckets() and not self.deltas():
            return self._write_base(align_by_name(updates, self.schema))
        if rest <= set(updates.columns) and (update_cols is None or rest <= set(update_cols)):
            return self._publish_delta(updates)
        return self._publish_delta(upsert_rows(self.lookup(updates), updates, self.keys, update_cols))

    def insert_if_absent(self, incoming: DataFrame, order_by: Sequence[str]) -> int:
        """Insert the first row of each key that the table does not have.  Returns rows written."""
        require_keys(incoming, self.keys, unique=False)
        first = first_by_key(incoming, self.keys, order_by)
        if not self._base_buckets() and not self.deltas():
            return self._write_base(align_by_name(first, self.schema))
        known = self.lookup(incoming).select(*[col(k) for k in self.keys])
        return self._publish_delta(first.join(known, self.keys, "left_anti"))

    def update_by_key(self, updates: DataFrame, set_cols: Mapping[str, str], order_by: Sequence[str] | None = None) -> int:
        """Set columns of known keys.  Returns rows written: those of the known keys."""
        require_keys(updates, self.keys, unique=not order_by)
        return self._publish_delta(update_rows(self.lookup(updates), updates, self.keys, set_cols, order_by))

    # -- maintenance
    def merge_deltas(self) -> None:
        """Make one delta of all, with each key's latest row."""
        old = self.deltas()
        if len(old) < 2:
            return
        latest = self._latest(scan_table(self.spark, self._rows_id).where((F.col(BUCKET) == DELTA_BUCKET) & F.col(VERSION).isin(old)))
        path = f"{self.wh.root}/{self.rows_table}/deltas/{old[-1] + 1}-{uuid.uuid4().hex[:8]}"
        latest.hint("rebalance").write.mode("errorifexists").parquet(path)
        self._add([(DELTA_BUCKET, old[-1] + 1, path)])
        self._drop(old)

    def compact(self) -> None:
        """Fold the deltas into the base (a rewrite of the table; worth it once they are a good part of it)."""
        old = self.deltas()
        if old:
            self._write_base(self.read())
            self._drop(old)

    def _write_base(self, rows: DataFrame) -> int:
        """Write the base and its filters.  The filters come first: they cover the old base as well, since no key goes."""
        out, obs = counted(rows)
        path = f"{self.wh.root}/{self.rows_table}/base/{uuid.uuid4().hex}"
        out.withColumn(BUCKET, self._bucket()).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(path)
        schema = StructType([*self.schema.fields, StructField(BUCKET, IntegerType())])
        written = self.spark.read.schema(schema).parquet(path)
        n = observed_rows(obs, lambda: written)
        sizes = written.groupBy(F.col(BUCKET).alias("_b")).agg(
            (F.ceil(F.count(F.lit(1)) * KEY_BITS / PAGE_BITS) * PAGE_BITS).cast("long").alias("bits"))
        pages = (written.join(F.broadcast(sizes), F.col(BUCKET) == F.col("_b"))
                 .select("_b", "bits", self._positions(F.col("bits")))
                 .groupBy("_b", "bits", (F.col("at") / PAGE_BITS).cast("long").alias("page"))
                 .agg(F.bitmap_construct_agg((F.col("at") % PAGE_BITS).cast("long")).alias("bitmap")))
        filters = f"{self.wh.root}/{self.filters_table}/filters/{uuid.uuid4().hex}"
        pages.withColumnRenamed("_b", BUCKET).write.partitionBy(BUCKET).parquet(filters)
        there, buckets = self._base_buckets(), sorted(r[0] for r in sizes.select("_b").collect())
        filters_id = self.wh.qualified(self.filters_table)
        for table, folder, version in ((filters_id, filters, ""), (self._rows_id, path, f", {VERSION} = 0")):
            parts = {b: f"PARTITION ({BUCKET} = {b}{version})" for b in buckets}
            place = {b: f"LOCATION {_text(f'{folder}/{BUCKET}={b}')}" for b in buckets}
            new = [b for b in buckets if b not in there]
            if new:
                self.spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(f"{parts[b]} {place[b]}" for b in new))
            for b in set(buckets) & there:
                self.spark.sql(f"ALTER TABLE {table} {parts[b]} SET {place[b]}")
            self.spark.catalog.refreshTable(table)
        return n
