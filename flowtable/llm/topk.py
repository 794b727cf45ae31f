"""Exact top-k inner products with a vector-approximation file.

Vectors are integers.  The approximation of a component is its cell ``v >> CELL_BITS``; what the
cell leaves open is between 0 and ``2**CELL_BITS - 1``.  For a query q the score of a vector is
therefore at most ``(cells . q << CELL_BITS) + (2**CELL_BITS - 1) * sum(max(q, 0))``.

Rows are dealt by hash into blocks of vectors and blocks of queries of bounded size, and each pair of
blocks is one group.  In it, the cells of all vectors are scanned for bounds; exact vectors are read
in the order of their bounds until no unread bound reaches the k-th exact score.  The k best of every
pair of blocks are merged by a window.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flowtable.llm.common import materialize, table

CELL_BITS = 5
BLOCK_VECTORS = 32_768  # expected vectors in a block
BLOCK_QUERIES = 1_024  # expected queries in a block
LONG = np.iinfo(np.int64)


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    """Rows padded with zeros to ``width``."""
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def search_block(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
    """Yield (query id, ids, scores) of the k best of a block for each query, own id excluded."""
    top = [int(np.abs(m.astype(np.float64)).max(initial=0)) for m in (vectors, queries)]
    if max(1, vectors.shape[1]) * (top[0] + 1) * (top[1] + 1) >= 1 << 52:
        # components too large for exact float bounds: Python integers, cut to a long's range
        wide = vectors.astype(object)
        for qid, q in zip(query_ids, queries.astype(object)):
            score = np.array([min(max(int(x), LONG.min), LONG.max) for x in wide @ q], dtype=np.int64)
            pick = sorted(np.flatnonzero(ids != qid), key=lambda i: (-int(score[i]), ids[i]))[:k]
            yield qid, ids[pick], score[pick]
        return
    cells = (vectors >> CELL_BITS).astype(np.float64)  # the approximation file of this block
    open_part = (1 << CELL_BITS) - 1
    for at in range(0, len(queries), 64):
        part = queries[at:at + 64]
        bounds = (cells @ part.T.astype(np.float64)) * (1 << CELL_BITS) + open_part * np.maximum(part, 0).sum(axis=1)
        for j, q in enumerate(part):
            bound, qid = bounds[:, j].astype(np.int64), query_ids[at + j]
            bound[ids == qid] = LONG.min
            step = min(len(ids), 8 * k)
            first = np.argpartition(-bound, step - 1)[:step]
            first = first[bound[first] > LONG.min]
            score = vectors[first] @ q
            kth = np.partition(score, -k)[-k] if len(score) >= k else LONG.min
            seen = np.zeros(len(ids), dtype=bool)
            seen[first] = True
            rest = np.flatnonzero(~seen & (bound >= kth) & (bound > LONG.min))
            rest = rest[np.argsort(-bound[rest], kind="stable")]
            while len(rest):  # exact vectors in the order of their bounds, until the k-th is certain
                read, rest = rest[:256], rest[256:]
                first, score = np.concatenate([first, read]), np.concatenate([score, vectors[read] @ q])
                if len(score) >= k:
                    kth = np.partition(score, -k)[-k]
                    rest = rest[: np.searchsorted(-bound[rest], -kth, side="right")]
            best = np.lexsort((ids[first], -score))[:k]
            yield qid, ids[first[best]], score[best]


def top_k(df: DataFrame, id_col: str, vector: Column, is_query: Column, k: int = 10,
          block_vectors: int = BLOCK_VECTORS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k largest inner products of every query with the other rows.

    ``vector`` is an array of longs.  Rows with a null id or vector take no part; equal rows count
    once; where one id has several vectors each is a candidate and the smallest is the query.  Vectors
    of different lengths meet as if padded with zeros.  Ties go to the smaller id.  Scores beyond a
    long are cut to its range.  An empty table or one vector gives no rows.
    """
    spark = df.sparkSession
    rows = materialize(
        df.select(F.col(id_col).cast("long").alias("id"), vector.alias("v"), is_query.alias("is_query"))
        .where("id IS NOT NULL AND v IS NOT NULL").groupBy("id", "v").agg(F.max("is_query").alias("is_query")),
        "vectors")
    n, asked = rows.agg(F.count("*"), F.count_if("is_query")).first()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    vector_blocks = max(1, -(-n // block_vectors), min(tasks, n // 64))
    query_blocks = max(1, -(-asked // block_queries))
    blocks = rows.select("id", "v", F.pmod(F.xxhash64("id", "v"), F.lit(vector_blocks)).cast("int").alias("vb"),
                         F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb"))
    queries = (rows.where("is_query").groupBy("id").agg(F.min("v").alias("v"))
               .select("id", "v", F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int").alias("qb"),
                       F.explode(F.sequence(F.lit(0), F.lit(vector_blocks - 1))).alias("vb")))

    def search(vectors: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(vectors) and len(asked):
            width = max(max(map(len, vectors["v"])), max(map(len, asked["v"])))
            found = [pd.DataFrame({"query_id": qid, "vec_id": ids, "score": scores}) for qid, ids, scores in search_block(
                vectors["id"].to_numpy(), _matrix(vectors["v"], width), asked["id"].to_numpy(), _matrix(asked["v"], width), k)]
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")

    best = blocks.groupBy("vb", "qb").cogroup(queries.groupBy("vb", "qb")).applyInPandas(
        search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op2_va_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten best inner products of ``floor(1024 * x)`` vectors for every id divisible by 100.

    Vectors that are null or hold a null or non-finite component take no part.
    """
    x = F.col("embedding")
    finite = F.forall(x, lambda e: F.coalesce(F.abs(e.cast("double")) < float("inf"), F.lit(False)) & ~F.isnan(e))
    ints = F.when(finite, F.transform(x, lambda e: F.floor(e.cast("double") * 1024)))
    return top_k(table(spark, sf_dir, "embeddings"), "vec_id", ints, F.col("vec_id") % 100 == 0, k=10)


#: DuckDB SQL for the rows of ``op2_va_topk``.
OP2_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
             vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
