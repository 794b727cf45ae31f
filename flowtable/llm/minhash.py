"""Near duplicates by a signature-coordinate inverted join.

A signature has ``COORDINATES`` coordinates; each is a hash of ``ROWS`` min-hash values, so two sets of
similarity s agree in a coordinate with probability ``s ** ROWS``.  A pair is retained when it agrees in
at least ``MATCHES`` coordinates; such a pair agrees in one of the first ``COORDINATES - MATCHES + 1``
(the prefix), and only those are posted.

Texts with the same words are one class, posted once.  Posting lists are merged by hub, the member of a
list whose lists are longest: a group is a hub with all members of its lists, so two texts that share a
list meet in a group, and a group of near copies, whose lists have the same hub, is formed once and
not once for each coordinate.  Inside a group

* the text that shares most coordinates is compared with all others first, then those that are not in
  the largest component are; pairs of one component are skipped;
* pairs with too few matching coordinates are skipped, in groups of every size, the others are confirmed on the full sets;
* only links that join two components leave the task.

A group is worked off as pairs of blocks of bounded size.  At similarity 0.75 a pair misses the match
threshold with a probability of 5e-6; below the threshold no link is made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtable.llm.common import gives_back, materialize, table, utf8_list
from flowtable.llm.components import components
from flowtable.llm.wordhash import hash_words, mix, shingles, words_of

WORDS = 5
PERCENT = 75  # least similarity
COORDINATES = 40
ROWS = 4
MATCHES = 2
BLOCK = 1024  # expected members of a block of a large group
BLOCK_SHINGLES = 1 << 21  # expected shingles of a block

_RANDOM = np.random.default_rng(20240229)
_FACTORS = (_RANDOM.integers(0, 1 << 32, COORDINATES * ROWS, dtype=np.uint32) | np.uint32(1))[:, None]
_TERMS = _RANDOM.integers(0, 1 << 32, COORDINATES * ROWS, dtype=np.uint32)[:, None]
_PLACES = _RANDOM.integers(1, 1 << 63, (COORDINATES, ROWS), dtype=np.uint64) | np.uint64(1)


def signature(found: np.ndarray) -> np.ndarray:
    """Coordinates of a set of 64-bit hashes; each also tells its own number."""
    low = np.full(COORDINATES * ROWS, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(found), 4096):
        part = (found[at:at + 4096] >> np.uint64(32)).astype(np.uint32)[None, :]
        np.minimum(low, (part * _FACTORS + _TERMS).min(axis=1), out=low)
    mixed = mix(low.reshape(COORDINATES, ROWS).astype(np.uint64) * _PLACES).sum(axis=1, dtype=np.uint64)
    return mix(mixed + np.arange(COORDINATES, dtype=np.uint64))


def _sign(words: int):
    schema = pa.schema([("doc_id", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("n_shingles", pa.int64()),
                        ("signature", pa.list_(pa.int64()))])

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, marks = [], [], []
            for text in utf8_list(batch.column("text")):
                w = words_of(text)
                found = shingles(hash_words(w), words)
                digest = xxhash.xxh128_digest(b" ".join(w))
                keys.append(digest)
                sizes.append(len(found))
                marks.append(signature(found).astype(np.int64) if len(found) else None)
            k = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(k[:, 0]), pa.array(k[:, 1]),
                 pa.array(sizes, pa.int64()), pa.array(marks, pa.list_(pa.int64()))], schema=schema)
    return run


class _Forest:
    """Components of a group's members."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: int, b: int) -> bool:
        x, y = self.label[a], self.label[b]
        if x == y:
            return False
        self.label[self.label == max(x, y)] = min(x, y)
        return True

    def outside(self) -> np.ndarray:
        """Members that are not in the largest component."""
        return self.label != np.bincount(self.label).argmax()


def link_group(sets: list[np.ndarray], block: np.ndarray, percent: int, matches: int = MATCHES) -> list[tuple[int, int]]:
    """Links that join the components of a group, as positions in ``sets``.

    ``block`` tells the members of the two blocks apart; members of one block meet in another call, but
    for the first comparison.  Every pair that is similar enough and has enough matching coordinates
    ends in one component, over this and the other calls of the group.
    """
    n = len(sets)
    sizes = np.array([len(x) for x in sets])
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(n), sizes)
    marks = np.stack([signature(x) for x in sets])
    center = None
    if n > 2:
        shared = np.zeros(n)
        for column in marks.T:
            _, at, count = np.unique(column, return_inverse=True, return_counts=True)
            shared += count[at]
        center = int(shared.argmax())
    forest, links, two = _Forest(n), [], block.max() > block.min()

    def compare(x: int, others: np.ndarray) -> None:
        if not sizes[x]:
            return
        others = others & (forest.label != forest.label[x])
        others &= 100 * np.minimum(sizes, sizes[x]) >= percent * np.maximum(sizes, sizes[x])
        if others.any():
            others &= (marks == marks[x]).sum(axis=1) >= matches
        pick = np.flatnonzero(others)
        if not len(pick):
            return
        if 4 * len(pick) < n:
            part, who = np.concatenate([sets[i] for i in pick]), np.repeat(pick, sizes[pick])
        else:
            part, who = every, owner
        place = np.minimum(np.searchsorted(sets[x], part), sizes[x] - 1)
        both = np.bincount(who[sets[x][place] == part], minlength=n)
        for y in pick[100 * both[pick] >= percent * (sizes[x] + sizes[pick] - both[pick])]:
            if forest.join(x, int(y)):
                links.append((x, int(y)))

    if center is not None:
        compare(center, np.ones(n, dtype=bool))
    done = np.zeros(n, dtype=bool)
    for x in range(n):
        if n > 2 and not forest.outside()[x]:
            continue
        done[x] = True
        compare(x, (block != block[x]) if two else ~done)
    # of two members in different components one is outside the largest; it has asked, or does now
    for x in np.flatnonzero(~done & forest.outside()):
        compare(int(x), (block != block[x]) if two else np.ones(n, dtype=bool))
    return links


def _link_groups(words: int, percent: int):
    """Links of groups whose rows come sorted by ``hub, i, j``."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    names = ("hub", "i", "j", "block", "rep")

    def link(rows: list[np.ndarray], texts: list[bytes]) -> pa.RecordBatch:
        block, rep = rows[3], rows[4]
        sets = [shingles(hash_words(words_of(t)), words) for t in texts]
        found = link_group(sets, block, percent) if len(sets) > 1 else []
        return pa.RecordBatch.from_arrays([pa.array([rep[x] for x, _ in found], pa.int64()),
                                           pa.array([rep[y] for _, y in found], pa.int64())], schema=schema)

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, texts = None, []  # the rows of the last group, which may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(n).to_numpy() for n in names]
            if kept is not None:
                rows = [np.concatenate(x) for x in zip(kept, rows)]
            texts += utf8_list(batch.column("text"))
            edge = np.flatnonzero((np.diff(rows[0]) != 0) | (np.diff(rows[1]) != 0) | (np.diff(rows[2]) != 0)) + 1
            bounds = [0, *edge.tolist()]
            for lo, hi in zip(bounds, bounds[1:]):
                yield link([x[lo:hi] for x in rows], texts[lo:hi])
            kept, texts = [x[bounds[-1]:] for x in rows], texts[bounds[-1]:]
        if kept is not None:
            yield link(kept, texts)
    return run


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (``doc_id``, ``text``).

    Null, empty and blank texts have no shingles and are linked with nothing.  Rows that share an id
    are one node.  A row without an id joins its class's component if a copy has an id; else its
    component is null and it is kept.  No rows give no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = materialize(docs.mapInArrow(
        _sign(words), "doc_id long, k1 long, k2 long, n_shingles long, signature array<bigint>"), "signatures")
    classes = materialize(signed.where("n_shingles > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"))
                          .where("rep IS NOT NULL"), "classes")
    posted = materialize(
        signed.where("n_shingles > 0")
        .join(classes.withColumnRenamed("rep", "doc_id"), ["doc_id", "k1", "k2"], "left_semi")
        .select(F.col("doc_id").alias("rep"), "n_shingles", "signature"), "posted")
    postings = posted.select("rep", F.explode(F.slice("signature", 1, COORDINATES - MATCHES + 1)).alias("c"))
    lists = postings.groupBy("c").agg(F.count("*").alias("members")).where("members > 1")
    live = materialize(postings.join(lists, "c"), "live")

    reach = live.groupBy("rep").agg(F.sum("members").alias("reach"))
    hubs = (live.join(reach, "rep").groupBy("c").agg(F.max(F.struct("reach", (-F.col("rep")).alias("low"))).alias("top"))
            .select("c", (-F.col("top.low")).alias("hub")))
    groups = materialize(live.join(hubs, "c").select("hub", "rep").distinct()
                         .join(posted.groupBy("rep").agg(F.max("n_shingles").alias("n")), "rep"), "groups")
    blocks = (groups.groupBy("hub").agg(F.count("*").alias("members"), F.sum("n").alias("shingles"))
              .select("hub", F.greatest(F.ceil(F.col("members") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).alias("blocks")))
    dealt = (groups.join(blocks, "hub").withColumn("block", F.pmod(F.xxhash64("rep"), "blocks"))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .select("hub", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block",
                     F.col("rep").alias("doc_id")))
    # the hint keeps one plan at every size
    with_text = docs.join(dealt.hint("merge"), "doc_id").withColumnRenamed("doc_id", "rep")
    links = (with_text.repartition("hub", "i", "j").sortWithinPartitions("hub", "i", "j")
             .mapInArrow(_link_groups(words, percent), "a long, b long"))

    label = components(links)
    named = (classes.join(label.withColumnRenamed("node", "rep"), "rep", "left")
             .select("k1", "k2", F.coalesce("component", "rep").alias("_component")))
    component = F.when(F.col("n_shingles") > 0, F.col("_component")).otherwise(F.col("doc_id"))
    return (signed.select("doc_id", "k1", "k2", "n_shingles").join(named, ["k1", "k2"], "left")
            .select("doc_id", "n_shingles", component.alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())))


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: five-word shingles, similarity 0.75 or more."""
    return near_duplicates(table(spark, sf_dir, "documents"))
