"""Keyed change operators: latest/first row per key, change detection, versions, duplicates.

All per-key reductions are aggregations (``max_by`` / ``min_by`` over a struct), so Spark
runs a partial aggregate before the shuffle: a key holding a third of all rows is reduced
on the map side to one row per task instead of being sent whole to one reducer.  Change
detection needs the rows of a key in order; keys too big for one task are cut into range
slices (see ``changed_rows``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType

from flowtable.functions.columns import col, fingerprint
from flowtable.session import checkpoint


def _order_struct(order_by: Sequence[str]):
    return F.struct(*[col(c) for c in order_by])


def _unpack(grouped: DataFrame, df: DataFrame, keys: list[str], payload: list[str]) -> DataFrame:
    fields = {c: F.col("_row").getField(c).alias(c) for c in payload}
    return grouped.select(*[col(c) if c in keys else fields[c] for c in df.columns])


def latest_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order_by`` tuple per key (ties broken by the later columns)."""
    keys, order_by = list(keys), list(order_by)
    payload = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*[col(c) for c in payload]), _order_struct(order_by)).alias("_row")
    return _unpack(df.groupBy(*[col(k) for k in keys]).agg(best), df, keys, payload)


def first_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row with the smallest ``order_by`` tuple per key."""
    keys, order_by = list(keys), list(order_by)
    payload = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*[col(c) for c in payload]), _order_struct(order_by)).alias("_row")
    return _unpack(df.groupBy(*[col(k) for k in keys]).agg(best), df, keys, payload)


HOT_KEY_MIN_ROWS = 100_000  # below this a key fits comfortably in one task, whatever the total


def _changed(rows: DataFrame, value: str, prev: str, first: str) -> DataFrame:
    return rows.where(col(first) | ~col(value).eqNullSafe(col(prev)))


def _lag_plain(df: DataFrame, keys: list[str], order_by: list[str], value: str, prev: str) -> DataFrame:
    """``lag`` over (key ordered by order_by): one shuffle by key."""
    w = Window.partitionBy(*[col(k) for k in keys]).orderBy(*[col(c) for c in order_by])
    out = df.withColumn(prev, F.lag(col(value)).over(w)).withColumn("_first", F.row_number().over(w) == 1)
    return _changed(out, value, prev, "_first").drop("_first")


def _lag_sliced(df: DataFrame, keys: list[str], order_by: list[str], value: str, prev: str, n: int) -> DataFrame:
    """``lag`` for keys too big for one task: range slices over (key, order) + boundary patch.

    The rows are range-partitioned on ``keys + order_by`` (a big key is cut into consecutive
    slices over several tasks), the slice id is pinned with a reliable checkpoint, and
    ``lag`` runs per (key, slice).  Only a slice's first row can have its predecessor in an
    earlier partition; those at most ``n - 1`` rows are patched from a table holding each
    partition's last row (one row per partition: a size-proven broadcast).
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(n, *[col(c) for c in keys + order_by]).withColumn("_slice", F.spark_partition_id())
    tagged = checkpoint(ranged)

    tails = (
        tagged.groupBy(col("_slice"))
        .agg(F.max_by(F.struct(*[col(c) for c in keys + [value]]), F.struct(*[col(c) for c in keys + order_by])).alias("_t"))
        .select("_slice", *[F.col("_t").getField(c).alias(f"_pk_{c}") for c in keys], F.col("_t").getField(value).alias("_pv"))
        .collect()  # one row per non-empty partition
    )
    bounds, last = [], None
    for row in sorted(tails, key=lambda r: r["_slice"]):
        if last is not None:  # predecessor = last row of the nearest earlier non-empty partition
            bounds.append((row["_slice"], True, *[last[f"_pk_{c}"] for c in keys], last["_pv"]))
        last = row
    fields = [StructField("_slice", IntegerType(), False), StructField("_has_pred", BooleanType(), False)]
    fields += [StructField(f"_pk_{c}", df.schema[c].dataType, True) for c in keys]
    fields += [StructField("_pv", df.schema[value].dataType, True)]
    boundary = spark.createDataFrame(bounds, StructType(fields))

    w = Window.partitionBy(*[col(k) for k in keys], col("_slice")).orderBy(*[col(c) for c in order_by])
    local = tagged.withColumn("_prev", F.lag(col(value)).over(w)).withColumn("_slice_first", F.row_number().over(w) == 1)
    joined = local.join(F.broadcast(boundary), "_slice", "left")
    # a slice's first row continues its key when the previous partition ended with that key
    continues = col("_slice_first") & F.coalesce(col("_has_pred"), F.lit(False))
    for c in keys:
        continues = continues & col(c).eqNullSafe(col(f"_pk_{c}"))
    out = joined.withColumn(prev, F.when(continues, col("_pv")).otherwise(col("_prev")))
    out = out.withColumn("_first", col("_slice_first") & ~continues)
    return _changed(out, value, prev, "_first").select(*df.columns, prev)


def changed_rows(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    value: str,
    previous_alias: str = "previous_value",
    parts: int | None = None,
    hot_threshold: int | None = None,
) -> DataFrame:
    """Rows whose ``value`` differs from the previous row of the same key, plus each key's first row.

    ``order_by`` must make the order within a key total (add a unique tie-break column).

    A ``lag`` window sends every row of a key to one task, so a key holding a third of the
    data would be one straggler task.  One keys-only aggregate (partial, map-side) counts
    rows per key; keys above ``hot_threshold`` rows (default: one task's fair share,
    total / parts, and at least 100k) -- at most ``parts`` of them, so their list is a
    size-bounded broadcast -- go through range slicing (``_lag_sliced``); all other keys take
    the plain one-shuffle window.  The result is the same either way.
    """
    spark = df.sparkSession
    keys, order_by = list(keys), list(order_by)
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
    stats = counts.agg(F.sum("_n").alias("total"), F.max("_n").alias("biggest")).first()
    total, biggest = int(stats["total"] or 0), int(stats["biggest"] or 0)
    limit = hot_threshold if hot_threshold is not None else max(total // n, HOT_KEY_MIN_ROWS)
    if biggest <= limit:
        return _lag_plain(df, keys, order_by, value, previous_alias)

    hot = counts.where(col("_n") > limit).select(*[col(c).alias(f"_h_{c}") for c in keys])
    if hot_threshold is None:
        hot = F.broadcast(hot)  # at most ``n`` keys hold more than a task's share; a caller's threshold has no such bound
    match = None
    for c in keys:
        cond = col(c).eqNullSafe(col(f"_h_{c}"))
        match = cond if match is None else match & cond
    hot_rows = df.join(hot, match, "left_semi")
    cold_rows = df.join(hot, match, "left_anti")
    cold = _lag_plain(cold_rows, keys, order_by, value, previous_alias)
    sliced = _lag_sliced(hot_rows, keys, order_by, value, previous_alias, n)
    return cold.unionByName(sliced)


def version_changes(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    tracked: Sequence[str],
    hash_col: str = "version_hash",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Fingerprint the tracked columns of each row and keep the rows where it changed per key.

    ``keep`` lists extra columns to carry into the result (default: all); only keys, order
    columns, ``keep`` and the fingerprint flow through the shuffles.
    """
    carry = [c for c in (df.columns if keep is None else keep) if c not in (*keys, *order_by)]
    hashed = df.select(*[col(c) for c in (*keys, *order_by, *carry)], fingerprint(*tracked).alias(hash_col))
    return changed_rows(hashed, keys, order_by, hash_col, previous_alias="previous_hash")


def track_versions(
    history: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    order_by: Sequence[str] = ("recorded_at",),
    hash_col: str = "version_hash",
) -> DataFrame:
    """New history rows: incoming entities whose fingerprint differs from their latest version.

    ``history`` holds ``keys + [hash_col] + order_by``; every change is appended (a revert
    to an older fingerprint counts as a change), so the result is safe to append.
    """
    keys = list(keys)
    latest = latest_by_key(history.select(*keys, hash_col, *order_by), keys, list(order_by))
    candidates = incoming.withColumn(hash_col, fingerprint(*tracked))
    joined = candidates.join(
        latest.select(*keys, col(hash_col).alias("_last_hash")), keys, "left"
    )
    return joined.where(~col(hash_col).eqNullSafe(col("_last_hash"))).drop("_last_hash")


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_col: str = "n_rows") -> DataFrame:
    """Keys that occur more than once, with their row counts."""
    return df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias(count_col)).where(col(count_col) > 1)


def key_conflicts(
    df: DataFrame,
    key: str,
    owner: str,
    count_col: str = "n_owners",
    first_col: str = "first_owner",
) -> DataFrame:
    """Keys claimed by more than one distinct owner, with the smallest owner as first claimant."""
    return (
        df.where(col(key).isNotNull() & col(owner).isNotNull())
        .groupBy(col(key))
        .agg(F.count_distinct(col(owner)).alias(count_col), F.min(col(owner)).alias(first_col))
        .where(col(count_col) > 1)
    )
