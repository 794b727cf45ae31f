"""Centroid clustering (Lloyd rounds) with Orchard's search for the nearest centroid.

Each centroid has a list of the others sorted by distance.  The search walks the list of the best centroid so
far; a closer one found is jumped to and its list walked from the start; centroids seen are skipped; the walk
stops at the first one strictly more than twice the current distance away, since by the triangle inequality
nothing from there on is as close.  All numbers are integers, so distances, sums and means are exact.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtable.llm.common import materialize, table
from flowtable.llm.vectors import float_vector, matrix, scaled_floor, whole_vectors

LIMIT = 1 << 62  # scaled entries beyond are cut
LONG = np.iinfo(np.int64).max
LOW_BITS = 31  # sums are kept as two longs, so that neither overflows
CHUNK = 8192  # vectors searched at once in a task


class Orchard:
    """Nearest of some centroids for blocks of integer vectors; ties go to the smaller number."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids.astype(np.int64)
        self.top = int(np.abs(centroids).max(initial=0))
        wide = centroids.astype(object)
        gaps = np.array([[int(((a - b) ** 2).sum()) for b in wide] for a in wide], dtype=object)
        k = len(centroids)
        lists = [sorted((c for c in range(k) if c != j), key=lambda c, j=j: (gaps[j][c], c)) for j in range(k)]
        self.lists = np.array(lists, dtype=np.int64).reshape(k, k - 1)
        self.gaps = np.array([[gaps[j][c] for c in order] for j, order in enumerate(lists)],
                             dtype=object).reshape(k, k - 1)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid and squared distance (integers of any size if longs could overflow)."""
        n, k = len(points), len(self.centroids)
        reach = self.top + int(max(points.max(initial=0), -int(points.min(initial=0))))
        exact = np.int64 if 4 * points.shape[1] * reach * reach < LONG else object
        points, centroids, gaps = points.astype(exact), self.centroids.astype(exact), self.gaps.astype(exact)
        best_of = np.zeros(n, dtype=np.int64)
        best = ((points - centroids[0]) ** 2).sum(axis=1)
        seen = np.zeros((n, k), dtype=bool)
        seen[:, 0] = True
        place = np.zeros(n, dtype=np.int64)  # next entry in the list of the best centroid
        live = np.arange(n if k > 1 else 0)
        while len(live):
            at = (best_of[live], place[live])
            near = (gaps[at] <= 4 * best[live]).astype(bool)
            live, candidate = live[near], self.lists[at][near]
            place[live] += 1
            fresh = ~seen[live, candidate]
            look, candidate = live[fresh], candidate[fresh]
            seen[look, candidate] = True
            distance = ((points[look] - centroids[candidate]) ** 2).sum(axis=1)
            closer = ((distance < best[look]) | ((distance == best[look]) & (candidate < best_of[look]))).astype(bool)
            jump = look[closer]
            best_of[jump], best[jump], place[jump] = candidate[closer], distance[closer], 0
            live = live[place[live] < k - 1]
        return best_of, best


def _chunks(batch: pa.RecordBatch, width: int):
    """``(first row, integer vectors)`` of at most ``CHUNK`` rows of the table of integer vectors."""
    flat = batch.column("x").flatten().to_numpy().reshape(-1, width)
    for at in range(0, len(flat), CHUNK):
        yield at, flat[at:at + CHUNK]


def _round(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round; sums are added up in each task, then in Spark."""
    k, width = centroids.shape

    def partial(batches):
        orchard = Orchard(centroids)
        counts, sums = np.zeros(k, dtype=np.int64), np.zeros((2, k, width), dtype=np.int64)
        for batch in batches:
            for _, x in _chunks(batch, width):
                cluster, _ = orchard.nearest(x)
                order = np.argsort(cluster, kind="stable")
                used, first, many = np.unique(cluster[order], return_index=True, return_counts=True)
                counts[used] += many
                sums[0, used] += np.add.reduceat(x[order] >> LOW_BITS, first, axis=0)
                sums[1, used] += np.add.reduceat(x[order] & ((1 << LOW_BITS) - 1), first, axis=0)
        yield pa.RecordBatch.from_pydict({
            "cluster": pa.array(np.repeat(np.arange(k, dtype=np.int32), width)),
            "dim": pa.array(np.tile(np.arange(width, dtype=np.int32), k)), "n": pa.array(np.repeat(counts, width)),
            "hi": pa.array(sums[0].reshape(-1)), "lo": pa.array(sums[1].reshape(-1))})

    out = centroids.copy()
    for r in (vectors.select("x").mapInArrow(partial, "cluster int, dim int, n long, hi long, lo long")
              .groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum("hi").alias("hi"), F.sum("lo").alias("lo"))
              .collect()):
        if r["n"]:
            out[r["cluster"], r["dim"]] = ((r["hi"] << LOW_BITS) + r["lo"]) // r["n"]
    return out


def cluster(df: DataFrame, id_col: str, vector_col: str, width: int, k: int = 8, rounds: int = 10, seed: str = "3",
            scale: int = 1024) -> DataFrame:
    """``id_col, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector of ``width`` entries.

    Entries x become ``floor(scale * x)`` (cut to 2**62).  Vectors that are null, of another width or that hold
    null or non-finite entries take no part and have no rows.  The first centroids are the ``k`` vectors with the
    smallest SHA-256 of ``seed:id``, ties by vector; rows without an id are assigned but never start a centroid, so
    that no ids, like no vectors, give no rows.  Fewer vectors than ``k`` make fewer centroids.  Repeated rows
    count each.  Equal distances go to the smaller number; empty centroids stay.  Distances and sums beyond a long
    are cut to its largest value.  Other columns are not read.
    """
    spark = df.sparkSession
    kind = df.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, kind)] + T._parse_datatype_string(
        "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string").fields)

    def integers(batches):
        for batch in batches:
            rows, starts, lengths, values = whole_vectors(batch.column("v"))
            fits = lengths == width
            x = scaled_floor(matrix(starts[fits], lengths[fits], values, width), scale, LIMIT)
            yield pa.RecordBatch.from_arrays([
                batch.column("id").take(pa.array(rows[fits])),
                pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * width),
                                         pa.array(x.reshape(-1)))], names=["id", "x"])

    vectors = materialize(
        df.select(F.col(f"`{id_col}`").alias("id"), float_vector(df, vector_col).alias("v")).mapInArrow(
            integers, T.StructType([T.StructField("id", kind), T.StructField("x", T.ArrayType(T.LongType()))])),
        "vectors")
    point = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = vectors.where("id IS NOT NULL").orderBy(point, "x").limit(k).select("x").collect()
    if not first:
        return spark.createDataFrame([], schema)
    centroids = np.array([r["x"] for r in first], dtype=np.int64).reshape(len(first), width)
    for _ in range(rounds):
        moved = _round(vectors, centroids)
        if (moved == centroids).all():
            break  # nothing moves from here on
        centroids = moved

    def assign(batches):
        orchard = Orchard(centroids)
        for batch in batches:
            for at, x in _chunks(batch, width):
                of, distance = orchard.nearest(x)
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").slice(at, len(x)), pa.array(of.astype(np.int32)),
                    pa.array(np.minimum(distance, LONG).astype(np.int64))], names=["id", "cluster", "distance"])

    assigned = materialize(vectors.mapInArrow(assign, T.StructType(
        [T.StructField("id", kind), *T._parse_datatype_string("cluster int, distance long").fields])), "assigned")
    inertia = {r[0]: int(r[1]) for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)"))).collect()}
    total = min(sum(inertia.values()), int(LONG))
    facts = spark.createDataFrame(
        [(j, min(inertia.get(j, 0), int(LONG)), total,
          hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for j, c in enumerate(centroids)],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")  # k rows
    return assigned.join(F.broadcast(facts), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_orchard_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight clusters of the ``embeddings`` vectors of 64 components after ten rounds."""
    return cluster(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", width=64, k=8, rounds=10)


def _round_sql(i: int) -> str:
    return f"""
a{i} AS MATERIALIZED (
  SELECT p.row, arg_min(p.id, [p.d, p.id]) AS cluster, min(p.d) AS d FROM (
    SELECT v.row, c.id, CAST(list_sum(list_transform(list_zip(v.q, c.q), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
    FROM v, c{i} c) p GROUP BY p.row),
s{i} AS (
  SELECT a.cluster, t.pos, CAST(sum(t.x) AS BIGINT) AS s, count(*) AS n
  FROM a{i} a JOIN (SELECT row, unnest(q) AS x, generate_subscripts(q, 1) AS pos FROM v) t USING (row) GROUP BY ALL),
c{i + 1} AS MATERIALIZED (
  SELECT c.id, coalesce(m.q, c.q) AS q FROM c{i} c LEFT JOIN (
    SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY pos) AS q FROM s{i} GROUP BY cluster) m ON c.id = m.cluster),"""


#: DuckDB SQL for the rows of ``op12_orchard_clusters``.
OP12_SQL = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id,
         list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY h, q) - 1 AS INTEGER) AS id, q FROM (
    SELECT sha256('3:' || vec_id) AS h, q FROM v WHERE vec_id IS NOT NULL ORDER BY h, q LIMIT 8)),
""" + "".join(_round_sql(i) for i in range(10)) + """
f AS (
  SELECT p.row, arg_min(p.id, [p.d, p.id]) AS cluster, min(p.d) AS d FROM (
    SELECT v.row, c.id, CAST(list_sum(list_transform(list_zip(v.q, c.q), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
    FROM v, c10 c) p GROUP BY p.row)
SELECT v.vec_id, f.cluster, f.d AS distance, CAST(sum(f.d) OVER (PARTITION BY f.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(f.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM v JOIN f USING (row) JOIN c10 c ON c.id = f.cluster
"""
