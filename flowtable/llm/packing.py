"""Lexical retrieval packing into fixed windows.

1. Every document becomes token ids.  Its whole windows are sequences of their own; the rest (its
   tail, under one window) is what has to be packed.
2. Document frequencies of token ids over all tails are counted in the same pass and added up; there
   are at most as many as the vocabulary has ids.
3. A tail's key is its rarest id by the vocabulary's own order (pieces merged later have larger ids), and
   tails are range-partitioned by (key, checksum, id) into shards of about ``SHARD_TOKENS`` tokens:
   likely neighbours meet, and a key that a third of the tails share is cut into many shards.
4. In a shard an inverted index with BM25 weights returns unused neighbours of the seed, which fill its
   window greedily; the last one is cut to fit and its rest seeds the next window.  Every window but
   the shard's last is full, and the last is cut at powers of two, so that no padding is left.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtable.llm.common import gives_back, materialize, table
from flowtable.llm.wordcodes import word_codes

WINDOW = 4096
END_ID = 2
SHARD_TOKENS = 1 << 21  # expected tokens of a shard: 4 MB of ids in one task
QUERY_TERMS = 24  # terms of a seed that ask the index: the most telling ones
K1, B = 1.2, 0.75

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _tokenize(path: str, window: int):
    """Whole windows of each document as finished pieces (``ids`` null), its tail with ids and key, and
    at the end of a task the number of its tails that hold each id (``term``, ``df``)."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                        ("doc_tokens", pa.int64()), ("ids", pa.binary()), ("key", pa.int32()), ("term", pa.int32()), ("df", pa.int64())])
    end = np.array([END_ID], dtype="<u2")

    # what these tasks leave is returned by _pack's, which follow in the same workers
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = word_codes(path)
        seen, place, order = np.zeros(1 << 16, dtype=np.int64), np.zeros(1 << 16, dtype=np.int64), np.arange(window)
        for batch in batches:
            rows = []
            for doc_id, found in zip(batch.column("doc_id").to_pylist(), codes.encode(batch.column("text"))):
                ids = np.concatenate([found, end])
                n = len(ids)
                whole = n // window * window
                for start in range(0, whole, window):
                    rows.append((doc_id, start, window, _crc(ids[start:start + window]), n, None, None))
                if whole < n:
                    tail = ids[whole:]
                    at = order[:len(tail)]
                    place[tail] = at
                    seen[tail[place[tail] == at]] += 1  # each id once: where it was put last
                    rows.append((doc_id, whole, n - whole, _crc(tail), n, tail.tobytes(), int(tail.max())))
            cols = list(zip(*rows)) or [()] * 7
            none = [None] * len(rows)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip([*cols, none, none], schema)], schema=schema)
        found = np.flatnonzero(seen)
        none = [None] * len(found)
        yield pa.RecordBatch.from_arrays([*(pa.array(none, f.type) for f in list(schema)[:7]), pa.array(found, pa.int32()),
                                          pa.array(seen[found], pa.int64())], schema=schema)
    return run


class Bm25Index:
    """Inverted index of a shard's tails: postings by term, weights computed once."""

    def __init__(self, tails: list[np.ndarray], idf: np.ndarray, mean_length: float):
        found = [np.unique(t, return_counts=True) for t in tails]
        docs = np.repeat(np.arange(len(tails), dtype=np.int32), [len(f[0]) for f in found])
        terms = np.concatenate([f[0] for f in found]) if found else np.zeros(0, dtype=np.uint16)
        tf = np.concatenate([f[1] for f in found]).astype(np.float32) if found else np.zeros(0, dtype=np.float32)
        length = np.array([len(t) for t in tails], dtype=np.float32)
        norm = K1 * (1 - B + B * length / max(mean_length, 1.0))
        order = np.argsort(terms, kind="stable")
        self.docs = docs[order]
        self.weight = (idf[terms] * tf * (K1 + 1) / (tf + norm[docs])).astype(np.float32)[order]
        self.start = np.searchsorted(terms[order], np.arange((1 << 16) + 1))
        self.size = len(tails)
        self.query = [ids[np.argsort(-idf[ids] * np.log1p(n), kind="stable")[:QUERY_TERMS]] for ids, n in found]

    def neighbours(self, doc: int) -> np.ndarray:
        """Tails that share a query term with ``doc``, best first, ties to the earlier one."""
        spans = [slice(self.start[t], self.start[t + 1]) for t in self.query[doc].tolist()]
        score = np.bincount(np.concatenate([self.docs[s] for s in spans]),
                            np.concatenate([self.weight[s] for s in spans]), self.size)
        hits = np.flatnonzero(score)
        return hits[np.argsort(-score[hits], kind="stable")]


def pack_shard(tails: list[np.ndarray], idf: np.ndarray, mean_length: float, window: int):
    """Yield the windows of a shard, each a list of ``(tail, first id, end id)``."""
    index = Bm25Index(tails, idf, mean_length)
    unused = np.ones(len(tails), dtype=bool)
    upto = [0] * len(tails)
    seed, following = None, 0
    while True:
        if seed is None:
            while following < len(tails) and not unused[following]:
                following += 1
            if following == len(tails):
                return
            seed = following
        unused[seed] = False
        out, room = [(seed, upto[seed], len(tails[seed]))], window - (len(tails[seed]) - upto[seed])
        cut = None
        near = index.neighbours(seed) if room else np.zeros(0, dtype=np.int64)
        near = near[unused[near]]
        at = 0
        while room:
            if at < len(near):
                doc = int(near[at])
                at += 1
                if not unused[doc]:
                    continue
            else:
                while following < len(tails) and not unused[following]:
                    following += 1
                if following == len(tails):
                    break
                doc = following
            unused[doc] = False
            take = min(room, len(tails[doc]))
            out.append((doc, 0, take))
            room -= take
            if take < len(tails[doc]):
                upto[doc], cut = take, doc
        yield out
        seed = cut


def power_cuts(pieces: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """A window's pieces cut into sequences whose lengths are powers of two, largest first."""
    left = sum(hi - lo for _, lo, hi in pieces)
    queue = list(pieces)
    while left:
        size = 1 << (left.bit_length() - 1)
        out, room = [], size
        while room:
            doc, lo, hi = queue.pop(0)
            take = min(room, hi - lo)
            out.append((doc, lo, lo + take))
            if lo + take < hi:
                queue.insert(0, (doc, lo + take, hi))
            room -= take
        left -= size
        yield out


def _pack(idf, mean_length: float, window: int):
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    schema = pa.schema([(n, pa.int64()) for n in names])

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = list(batches)  # one shard
        if not found:
            return
        rows = pa.Table.from_batches(found)
        ids = [np.frombuffer(x, "<u2") for x in rows["ids"].to_pylist()]
        docs, starts, totals = (rows[c].to_pylist() for c in ("doc_id", "start", "doc_tokens"))
        sequence, cols = TaskContext.get().partitionId() << 32, [[] for _ in names]
        for pieces in pack_shard(ids, idf.value, mean_length, window):
            full = sum(hi - lo for _, lo, hi in pieces) == window
            for part in [pieces] if full else power_cuts(pieces):
                offset = 0
                for doc, lo, hi in part:
                    row = (docs[doc], starts[doc] + lo, hi - lo, _crc(ids[doc][lo:hi]), totals[doc], 2 * sequence + 1, offset)
                    for c, x in zip(cols, row):
                        c.append(x)
                    offset += hi - lo
                sequence += 1
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], schema=schema)
    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Pieces ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` of all documents.

    Each id of a document (its text's ids, then the end id) lies in exactly one piece.  A sequence is
    ``window`` ids long or, at the end of a shard, a power of two; nothing is padded.  Null and empty
    texts are one end id.  Rows with equal or null ids are packed each for itself.  No rows, no pieces.
    """
    spark = docs.sparkSession
    pieces = materialize(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
            _tokenize(tokenizer_path, window), PIECE + ", ids binary, key int, term int, df long"), "pieces")
    tails = pieces.where("ids IS NOT NULL").drop("term", "df")
    # at most one row for each id of the vocabulary
    df = {r[0]: r[1] for r in pieces.where("term IS NOT NULL").groupBy("term").agg(F.sum("df")).collect()}
    n, tokens = tails.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    count = np.zeros(1 << 16)
    count[list(df)] = list(df.values())
    idf = spark.sparkContext.broadcast(np.log1p((n - count + 0.5) / (count + 0.5)).astype(np.float32))
    shards = max(1, -(-tokens // shard_tokens))
    order = ["key", "ids_crc32", "doc_id", "start"]
    packed = (tails.repartitionByRange(shards, *order).sortWithinPartitions(*order).drop("key")
              .mapInArrow(_pack(idf, tokens / max(n, 1), window), PIECE + ", sequence_id long, offset long"))
    whole = pieces.where("ids IS NULL AND term IS NULL").drop("ids", "key", "term", "df").select(
        "*", (F.monotonically_increasing_id() * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return whole.unionByName(packed)


def op3_lexical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 ids of the public word tokenizer."""
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
