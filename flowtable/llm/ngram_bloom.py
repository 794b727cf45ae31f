"""Language-model scoring with a log-frequency Bloom filter.

The filter holds, for every n-gram of 2 to ``ORDER`` words of the training texts, its count quantised to
``q = 1 + floor(log_BASE(count))`` as the members (n-gram, 1) ... (n-gram, q).  A count is read back by
probing 1, 2, ... until a probe fails, so it is never underestimated, and overestimated with the filter's error
rate; an n-gram is also never taken for more frequent than its parts, which rules out many errors.
The filter is made of groups of ``GROUP_SEGMENTS`` segments of ``SEGMENT_BITS`` bits; an n-gram's hash names
its segment.  No machine holds the filter: the n-grams of all texts are routed to the part of it they belong
to, which is filled with those of the training texts, probed for all and dropped; what was read of it goes
back to the blocks of text.  A large filter is done in up to ``PASSES`` passes over the blocks, so that the disk
holds the n-grams of one pass at a time.

Exact word counts come without a dictionary of the corpus on any machine: texts are coded in blocks, each
with its own dictionary of word hashes, sorted.  Slices of these dictionaries, cut at the same hashes for all
blocks, meet to be added up, and the sums go back to their blocks.  A row that is shuffled holds a slice,
compressed, and not a word; words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtable.llm.common import materialize, table, utf8_list
from flowtable.llm.wordhash import hash_words, mix

ORDER = 3  # longest n-gram; the n-grams of each order are routed to the filter
BASE = 1.3  # of the logarithm that counts are rounded down to
BITS_A_TOKEN = 12  # filter bits for each training token
HASHES = 3  # bits of a member
SEGMENT_BITS = 1 << 18
GROUP_SEGMENTS = 32  # the filter is made of whole groups: 1 MB
PART_SEGMENTS = 64  # segments filled and probed by one task: 2 MB
PASS_BYTES = 1 << 30  # of the filter filled and probed in one pass over the blocks, unless that takes more than
PASSES = 4  # passes
BLOCK_TOKENS = 250_000  # of texts coded together
SPLIT_BYTES = 1 << 20  # expected bytes of texts that are split into words together
SPLIT_WORDS = 1 << 17  # words hashed together
LONG_WORD = 64  # bytes; longer words are hashed one by one
PART_WORDS = 1 << 20  # expected dictionary entries that are added up together
PRIORS = (1000.0, 16.0)  # weight of the shorter context against the counts of one and of two or more words
MAX_LEVEL = 120  # levels cover counts up to BASE**119
END = b""  # no word is empty

_END = hash_words([END])
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
_START = np.uint64(0x5EED5EED5EED5EED)
_NGRAM_BITS = np.uint64(0xFFFFFFFFFFFF0000)  # n-grams are told apart by 48 bits


def squeeze(x: np.ndarray) -> bytes:
    """Unsigned integers as compressed planes of bytes: small numbers take little room."""
    raw = np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(len(x), 8).T).tobytes()
    return len(x).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unsqueeze(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    raw = pa.decompress(data[8:], 8 * n, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, n).T).view("<u8").reshape(n)


def squeeze_sorted(x: np.ndarray) -> bytes:
    return squeeze(np.diff(x, prepend=np.uint64(0)))


def unsqueeze_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unsqueeze(data), dtype=np.uint64)


def _levels(count: np.ndarray) -> np.ndarray:
    """Quantised counts: 1 + floor(log_BASE(count)); 0 for 0."""
    level = np.minimum(1 + np.floor(np.log(np.maximum(count, 1)) / np.log(BASE) + 1e-9).astype(np.int64), MAX_LEVEL)
    return np.where(count > 0, level, 0)


def low_count(level: np.ndarray) -> np.ndarray:
    """The least count of a level; 0 for level 0."""
    return np.where(level > 0, np.ceil(BASE ** (level - 1.0) - 1e-9), 0.0)


def high_count(level: np.ndarray) -> np.ndarray:
    """The largest count of a level; 0 for level 0."""
    return np.where(level > 0, np.maximum(np.ceil(BASE ** level.astype(float) - 1e-9) - 1, 1), 0.0)


def ngram_hashes(words: np.ndarray, starts: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 2 ... order the hash of the n-gram that ends at each token; texts begin with start marks."""
    out, last, previous = [], words, words
    for n in range(2, order + 1):
        # the word n - 1 places back, or the start mark
        previous = np.concatenate([[_START], previous[:-1]])
        previous[starts] = _START
        last = mix(last + np.uint64(n)) + previous
        out.append(mix(last + np.uint64(n)) & _NGRAM_BITS)
    return out


def _share(h: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` equal ranges of hashes each hash lies in; grows with the hash."""
    return ((h >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)


def _bits(h: np.ndarray, level: int) -> list[np.ndarray]:
    """The ``HASHES`` bits of each (n-gram, level) inside its segment: fields of one mixed hash."""
    mixed = mix(h + np.uint64(level * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    return [((mixed >> np.uint64(k * SEGMENT_BITS.bit_length())) & np.uint64(SEGMENT_BITS - 1)).astype(np.int64) for k in range(HASHES)]


def fill_segment(h: np.ndarray, count: np.ndarray) -> bytes:
    """A segment that holds all levels of its n-grams."""
    bits = np.zeros(SEGMENT_BITS, dtype=np.uint8)
    level = _levels(count)
    for at in range(1, int(level.max(initial=0)) + 1):
        for place in _bits(h[level >= at], at):
            bits[place] = 1
    return np.packbits(bits).tobytes()


def probe(filter_bytes: np.ndarray, first: int, segments: int, h: np.ndarray) -> np.ndarray:
    """Levels of n-grams whose segments lie in this part of the filter (from segment ``first``), else 0."""
    level = np.zeros(len(h), dtype=np.uint8)
    segment = _share(h, segments).astype(np.int64) - first
    left = np.flatnonzero((segment >= 0) & (segment < len(filter_bytes) * 8 // SEGMENT_BITS))
    h, start = h[left], segment[left] * SEGMENT_BITS
    at = 1
    while len(left) and at <= MAX_LEVEL:
        hit = np.ones(len(left), dtype=bool)
        for bit in _bits(h, at):
            place = start + bit
            hit &= (filter_bytes[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1
        left, h, start = left[hit], h[hit], start[hit]
        level[left] = at
        at += 1
    return level


_BLOCK = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("training", pa.list_(pa.bool_())),
                    ("lengths", pa.list_(pa.int32())), ("entries", pa.int64()), ("learned", pa.int64()),
                    ("hashes", pa.binary()), ("uses", pa.binary()), ("seen", pa.binary()), ("codes", pa.binary())])
_BLOCK_SQL = ("block long, doc_ids array<bigint>, training array<boolean>, lengths array<int>, entries long, learned long, "
              "hashes binary, uses binary, seen binary, codes binary")


def _word_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hashes of words in ``data``, which ends with 8 spare bytes: 8 bytes of all words are mixed in at a time."""
    eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))  # the 8 bytes from each place on
    h = mix(lengths.astype(np.uint64))
    for at in range(0, min(int(lengths.max(initial=0)), LONG_WORD), 8):
        some = np.flatnonzero(lengths > at)
        part = eight[starts[some] + at] & _FIRST_BYTES[np.minimum(lengths[some] - at, 8)]
        h[some] = mix(h[some] ^ part)
    for i in np.flatnonzero(lengths > LONG_WORD):
        h[i] = xxhash.xxh64_intdigest(data[starts[i]:starts[i] + lengths[i]].tobytes())
    return h


def text_tokens(column: pa.Array) -> Iterator[np.ndarray]:
    """Hashes of each text's lower-cased words and of its end; a null text is empty."""
    texts = utf8_list(column)
    at = 0
    while at < len(texts):
        upto, size = at, 0
        while upto < len(texts) and (upto == at or size + len(texts[upto]) < SPLIT_BYTES):
            size += len(texts[upto]) + 1
            upto += 1
        data = _LOWER[np.frombuffer(b" ".join([*texts[at:upto], bytes(8)]), np.uint8)]
        inside = np.concatenate([[False], ~_SPACE[data[:-8]], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, lengths = edges[::2], edges[1::2] - edges[::2]
        hashes = np.concatenate([_word_hashes(data, starts[lo:lo + SPLIT_WORDS], lengths[lo:lo + SPLIT_WORDS])
                                 for lo in range(0, max(len(starts), 1), SPLIT_WORDS)])
        text_ends = np.cumsum([len(t) + 1 for t in texts[at:upto]])
        for words in np.split(hashes, np.searchsorted(starts, text_ends))[:-1]:
            yield np.concatenate([words, _END])
        at = upto


def _code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of texts: the words' hashes in order, how often the block and its training texts use them,
    and the texts as codes - the place of each word in the dictionary by descending use."""
    number = TaskContext.get().partitionId() << 32

    def block(docs: list) -> pa.RecordBatch:
        lengths = np.array([len(d[2]) for d in docs])
        learn = np.repeat(np.array([d[1] for d in docs], dtype=bool), lengths)
        hashes, at = np.unique(np.concatenate([d[2] for d in docs]), return_inverse=True)
        uses = np.bincount(at, minlength=len(hashes))
        seen = np.bincount(at[learn], minlength=len(hashes))
        rank = np.empty(len(hashes), dtype=np.int64)
        rank[np.argsort(-uses, kind="stable")] = np.arange(len(hashes))
        row = [number, [d[0] for d in docs], [d[1] for d in docs], lengths.tolist(), len(hashes), int(learn.sum()),
               squeeze_sorted(hashes), squeeze(uses), squeeze(seen), squeeze(rank[at])]
        return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, _BLOCK)], schema=_BLOCK)

    docs, tokens = [], 0
    for batch in batches:
        for doc_id, training, hashes in zip(batch.column("doc_id").to_pylist(), batch.column("training").to_pylist(),
                                            text_tokens(batch.column("text"))):
            docs.append((doc_id, training, hashes))
            tokens += len(hashes)
            if tokens >= BLOCK_TOKENS:
                yield block(docs)
                docs, tokens, number = [], 0, number + 1
    if docs:
        yield block(docs)


class _Block:
    """A block's tokens as places in its sorted dictionary, with the texts' starts."""

    def __init__(self, row: dict):
        self.hashes = unsqueeze_sorted(row["hashes"])
        order = np.argsort(-unsqueeze(row["uses"]).astype(np.int64), kind="stable")
        self.at = order[unsqueeze(row["codes"]).astype(np.int64)]
        self.training = np.array(row["training"], dtype=bool)
        self.lengths = np.array(row["lengths"], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]]).astype(np.int64)

    def ngrams(self, order: int) -> list[np.ndarray]:
        return ngram_hashes(self.hashes[self.at], self.starts, order)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one at a time: a block's row is megabytes."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield {n: batch.column(n)[i].as_py() for n in batch.schema.names}


def _slices(h: np.ndarray, n: int, together: int = 1) -> Iterator[tuple[int, slice]]:
    """The filled ranges of sorted hashes, of ``n`` equal ones of which so many are taken together."""
    share = _share(h, n).astype(np.int64) // together
    bounds = [0, *(np.flatnonzero(np.diff(share)) + 1).tolist(), len(h)]
    for lo, hi in zip(bounds, bounds[1:]):
        if lo < hi:
            yield int(share[lo]), slice(lo, hi)


def _split_words(parts: int):
    """(part, block, hashes, seen): a block's dictionary cut at the same hashes as all others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            hashes, seen = unsqueeze_sorted(row["hashes"]), unsqueeze(row["seen"])
            cut = [(part, squeeze_sorted(hashes[s]), squeeze(seen[s])) for part, s in _slices(hashes, parts)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([c[0] for c in cut], pa.int32()), pa.array([row["block"]] * len(cut), pa.int64()),
                 pa.array([c[1] for c in cut], pa.binary()), pa.array([c[2] for c in cut], pa.binary())],
                ["part", "block", "hashes", "seen"])
    return run


def _groups_of(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, list[dict]]]:
    """Rows that come sorted by ``key``, key by key."""
    number, rows = None, []
    for row in _rows(batches):
        if rows and row[key] != number:
            yield number, rows
            rows = []
        number = row[key]
        rows.append(row)
    if rows:
        yield number, rows


def _total_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block its words' corpus counts, and a row without a block with the part's sums."""
    for part, rows in _groups_of(batches, "part"):
        slices = [unsqueeze_sorted(r["hashes"]) for r in rows]
        hashes, at = np.unique(np.concatenate(slices), return_inverse=True)
        total = np.bincount(at, np.concatenate([unsqueeze(r["seen"]) for r in rows])).astype(np.uint64)
        back = np.split(total[at], np.cumsum([len(x) for x in slices])[:-1])
        texts = int(total[hashes == _END[0]].sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array([*(r["block"] for r in rows), None], pa.int64()), pa.array([part] * (len(rows) + 1), pa.int32()),
             pa.array([*(squeeze(x) for x in back), None], pa.binary()),
             *(pa.array([None] * len(rows) + [x], pa.int64()) for x in (int(total.sum()), int((total > 0).sum()), texts))],
            ["block", "part", "totals", "tokens", "words", "texts"])


def _route_ngrams(segments: int, first: int, last: int, order: int):
    """(part, size, block, hashes, counts): a block's distinct n-grams of ``size`` words that belong to the filter's parts
    from ``first`` to before ``last``, and how often its training texts use them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            b = _Block(row)
            learn = np.repeat(b.training, b.lengths)
            for size, grams in enumerate(b.ngrams(order), 2):
                h, at = np.unique(grams, return_inverse=True)
                count = np.bincount(at[learn], minlength=len(h))
                cut = [(part, squeeze_sorted(h[s]), squeeze(count[s]))
                       for part, s in _slices(h, segments, PART_SEGMENTS) if first <= part < last]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c[0] for c in cut], pa.int32()), pa.array([size] * len(cut), pa.int32()),
                     pa.array([row["block"]] * len(cut), pa.int64()), pa.array([c[1] for c in cut], pa.binary()),
                     pa.array([c[2] for c in cut], pa.binary())], ["part", "size", "block", "h", "n"])
    return run


def _fill_and_probe(segments: int):
    """(block, size, part, found): the levels that the filter holds for the n-grams routed to each part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _groups_of(batches, "part"):
            first, members, asked = part * PART_SEGMENTS, [], []
            for size in sorted({r["size"] for r in rows}):
                own = [r for r in rows if r["size"] == size]
                slices = [unsqueeze_sorted(r.pop("h")) for r in own]
                h, at = np.unique(np.concatenate(slices), return_inverse=True)
                count = np.bincount(at, np.concatenate([unsqueeze(r.pop("n")) for r in own]))
                learned = count > 0
                members.append((h[learned], count[learned]))
                asked.append((own, h, at, np.cumsum([len(x) for x in slices])[:-1]))
                del slices
            cuts = [np.searchsorted(_share(h, segments).astype(np.int64) - first, np.arange(PART_SEGMENTS + 1))
                    for h, _ in members]
            bits = np.frombuffer(b"".join(
                fill_segment(*(np.concatenate([x[k][c[i]:c[i + 1]] for x, c in zip(members, cuts)]) for k in (0, 1)))
                for i in range(PART_SEGMENTS)), np.uint8)
            for own, h, at, ends in asked:
                found = np.split(probe(bits, first, segments, h)[at], ends)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["block"] for r in own], pa.int64()), pa.array([r["size"] for r in own], pa.int32()),
                     pa.array([part] * len(own), pa.int32()), pa.array([squeeze(x) for x in found], pa.binary())],
                    ["block", "size", "part", "found"])
    return run


def smoothed(count: np.ndarray, levels: np.ndarray, starts: np.ndarray, texts: int, tokens: int, distinct: int) -> np.ndarray:
    """log10 probability of each token.

    The counts of single words are smoothed with one for each word; each longer context adds its own
    evidence to that of the shorter one, which weighs as much as ``PRIORS`` tokens.  Counts of n-grams
    are taken at the low end of their level and counts of contexts at the high end, so that without
    filter errors the probabilities of a context add up to at most one.
    """
    def before(x: np.ndarray, at_start) -> np.ndarray:
        out = np.concatenate([x[:1], x[:-1]])
        out[starts] = at_start
        return out

    p = (count + 1) / (tokens + distinct + 1)
    context = before(count, texts)
    part, context_level = _levels(count), before(_levels(count), _levels(np.array([texts]))[0])
    for n, level in enumerate(levels):
        part = np.minimum(np.minimum(level, part), context_level)  # no more frequent than its parts
        evidence, prior = low_count(part), PRIORS[min(n, len(PRIORS) - 1)]
        p = (evidence + prior * p) / (np.maximum(context, evidence) + prior)
        context_level = before(part, context_level[starts])
        context = high_count(context_level)
    return np.log10(p)


def _score(texts: int, tokens: int, distinct: int, order: int):
    """Scores of all texts, from the words' counts (size 1) and the levels of longer n-grams in ``parts``."""
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            b = _Block(row)
            found = [np.concatenate([unsqueeze(t["found"]) for t in row["parts"] if t["size"] == size]) for size in range(1, order + 1)]
            count = found[0].astype(np.int64)[b.at]
            level = np.stack([x.astype(np.uint8)[np.unique(h, return_inverse=True)[1]] for x, h in zip(found[1:], b.ngrams(order))])
            base = np.log10((count + 1) / (tokens + distinct + 1))
            score = smoothed(count, level, b.starts, texts, tokens, distinct)
            # no text is empty: each has its end
            known, base, score = (np.add.reduceat(x, b.starts) for x in ((count > 0).astype(np.int64), base, score))
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array(~b.training), pa.array(b.lengths), pa.array(known),
                 pa.array(np.full(len(known), tokens)), pa.array(base), pa.array(score)], schema=schema)
    return run


def _release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing refers to any more.

    The scheduler holds on to its last job, so a job without a shuffle comes first.
    """
    spark.range(0, 1, 1, 1).collect()
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def score_documents(docs: DataFrame, training: Column, order: int = 2, bits_a_token: int = BITS_A_TOKEN,
                    round_bytes: int | None = None) -> DataFrame:
    """Scores of all texts by a model of those where ``training`` is true, with n-grams of 2 to ``order`` words.

    Null and empty texts are one end token.  Rows with equal or null ids are scored each for itself.
    With nothing to learn from every token has a count of 0.  No rows give no rows.  About ``round_bytes`` of
    the filter are filled and probed in one pass over the blocks; without it ``PASS_BYTES``, or more in ``PASSES`` passes.
    """
    spark = docs.sparkSession
    blocks = materialize(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(training, F.lit(False)).alias("training"), "text")
        .mapInArrow(_code, _BLOCK_SQL), "blocks")
    entries, learned = (int(x or 0) for x in blocks.agg(F.sum("entries"), F.sum("learned")).first())

    parts = max(1, -(-entries // PART_WORDS))
    totals = materialize(
        blocks.select("block", "hashes", "seen").mapInArrow(_split_words(parts), "part int, block long, hashes binary, seen binary")
        .repartition("part").sortWithinPartitions("part", "block")
        .mapInArrow(_total_words, "block long, part int, totals binary, tokens long, words long, texts long"), "totals")
    tokens, distinct, texts = (int(x or 0) for x in totals.agg(F.sum("tokens"), F.sum("words"), F.sum("texts")).first())
    found = totals.where("block IS NOT NULL").select("block", F.lit(1).alias("size"), "part", F.col("totals").alias("found"))

    segments = max(1, -(-learned * bits_a_token // (SEGMENT_BITS * GROUP_SEGMENTS))) * GROUP_SEGMENTS
    filter_parts = -(-segments // PART_SEGMENTS)
    part_bytes = PART_SEGMENTS * SEGMENT_BITS // 8
    step = max(1, round_bytes // part_bytes) if round_bytes else max(PASS_BYTES // part_bytes, -(-filter_parts // PASSES))
    for first in range(0, filter_parts, step):
        _release_shuffles(spark)  # the disk holds the n-grams of one pass at a time
        found = found.unionByName(materialize(
            blocks.mapInArrow(_route_ngrams(segments, first, first + step, order), "part int, size int, block long, h binary, n binary")
            .repartition(min(step, filter_parts - first), "part").sortWithinPartitions("part")
            .mapInArrow(_fill_and_probe(segments), "block long, size int, part int, found binary"), "levels"))
    _release_shuffles(spark)

    parts = found.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("size", "part", "found"))).alias("parts"))
    return blocks.drop("entries", "learned", "seen").join(parts, "block").mapInArrow(
        _score(texts, tokens, distinct, order),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op4_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by n-grams of up to ``ORDER`` words; those whose crc32 of the id as text mod 7 is 2 are held out."""
    remainder = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7
    return score_documents(table(spark, sf_dir, "documents"), remainder != 2, ORDER)
