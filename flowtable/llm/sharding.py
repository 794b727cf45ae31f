"""Consistent-hash ring with virtual nodes and bounded loads.

Every row has a point on a ring of ``cells`` equal cells.  Every shard owns ``vnodes`` random
cells; a row's home is the first owned cell clockwise.  A shard takes rows up to its capacity;
rows that find it full go on clockwise to the next shard with room.

Only the number of rows of each cell (at most ``cells`` numbers, whatever the input) reaches the
driver, which walks the ring and cuts each cell's rows, in a fixed order, into runs of
``(shard, first slot)``.  Spark then numbers the rows inside their cells and looks the runs up,
so a row's place follows from counts alone: no row is moved twice and no second ranking is needed.
"""

from __future__ import annotations

import bisect

import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flowtable.llm.common import materialize, table

CELL_BITS = 14  # 16,384 cells: the bound on what reaches the driver and is broadcast
VNODES = 64  # virtual nodes of a shard


def ring_nodes(shards: int, vnodes: int, cells: int, seed: int = 0) -> list[tuple[int, int]]:
    """(cell, shard) of all virtual nodes in clockwise order; a shard keeps its cells when others join."""
    return sorted((xxhash.xxh64_intdigest(f"{shard}/{i}", seed=seed) % cells, shard)
                  for shard in range(shards) for i in range(vnodes))


def place_cells(counts: dict[int, int], nodes: list[tuple[int, int]], capacity: list[int]) -> list[tuple]:
    """Runs ``(cell, first rank, end rank, shard, first slot)`` that put every row of every cell.

    First every shard fills with the rows at home on it, in ring order; then what is left over moves
    clockwise to the next shard with room, again in ring order.  ``sum(capacity)`` must hold all rows.
    """
    free, used, runs, left = list(capacity), [0] * len(capacity), [], []

    def put(cell: int, lo: int, n: int, shard: int) -> int:
        take = min(n, free[shard])
        if take:
            runs.append((cell, lo, lo + take, shard, used[shard]))
            free[shard] -= take
            used[shard] += take
        return take

    starts = [cell for cell, _ in nodes]
    for cell in sorted(counts):
        home = bisect.bisect_left(starts, cell) % len(nodes)
        took = put(cell, 0, counts[cell], nodes[home][1])
        if took < counts[cell]:
            left.append((cell, took, counts[cell] - took, home + 1))
    for cell, lo, n, at in left:
        while n:
            took = put(cell, lo, n, nodes[at % len(nodes)][1])
            lo, n, at = lo + took, n - took, at + 1
    return runs


def even_capacity(rows: int, shards: int) -> list[int]:
    """Capacities that add up to ``rows`` and differ by at most one."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def slack_capacity(rows: int, shards: int, load: float) -> list[int]:
    """The usual bound of a bounded-load ring: ``load`` times the mean, rounded up."""
    return [-int(-load * rows // shards)] * shards if load > 1 else even_capacity(rows, shards)


def shard_rows(df: DataFrame, cols: list[str], shards: int = 16, vnodes: int = VNODES, load: float = 1.0,
               seed: int = 0) -> DataFrame:
    """Columns ``cols`` of every row with ``shard`` and ``slot`` (gapless from 0 in its shard).

    The point on the ring is a hash of ``cols`` (a key, or a key and a digest so that one key with
    many different rows spreads).  Rows equal in all of ``cols`` are counted before the shuffle and
    dealt out like others, so a row repeated a billion times loads no task.  With ``load`` 1 the
    capacities add up to the rows and shards differ by at most one row; above 1 a shard takes up to
    ``load`` times the mean and fewer rows move when a shard joins.  Nulls hash like values; no rows
    give no rows.
    """
    spark = df.sparkSession
    cell = F.shiftrightunsigned(F.xxhash64(*cols, F.lit(seed)), 64 - CELL_BITS)
    keyed = materialize(df.groupBy(*cols).agg(F.count("*").alias("_n")).withColumn("_cell", cell), "ring")
    counts = {r[0]: r[1] for r in keyed.groupBy("_cell").agg(F.sum("_n")).collect()}
    rows = sum(counts.values())
    runs = place_cells(counts, ring_nodes(shards, vnodes, 1 << CELL_BITS, seed), slack_capacity(rows, shards, load))
    plan = spark.createDataFrame(runs or [(0, 0, 0, 0, 0)], "_cell long, _lo long, _hi long, shard int, _slot long")
    inside = Window.partitionBy("_cell").orderBy("_point", *cols).rowsBetween(Window.unboundedPreceding, 0)
    ranked = (keyed.withColumn("_point", F.xxhash64(*cols, F.lit(seed)))
              .withColumn("_end", F.sum("_n").over(inside)))
    each = ranked.select(*cols, F.col("_cell").cast("long").alias("_cell"),
                         F.explode(F.sequence(F.col("_end") - F.col("_n"), F.col("_end") - 1)).alias("_rank"))
    # at most a run for each cell and one more for each shard: bounded by the two parameters
    placed = each.join(F.broadcast(plan), "_cell").where("_rank >= _lo AND _rank < _hi")
    return placed.select(*cols, "shard", (F.col("_slot") + F.col("_rank") - F.col("_lo")).alias("slot"))


def op6_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into shards 0 to 15, row counts at most one apart (law ``rows``).

    Null text has size 1 and the checksum of an empty text; repeated rows are rows of their own.
    """
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"))
    out = shard_rows(docs, ["doc_id", "size", "text_crc32"], shards=16)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
