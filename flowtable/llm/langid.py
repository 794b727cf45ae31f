"""Hierarchical language identification with linear support vector machines.

A text is the mean over its character 1- to 3-grams (letters, one mark for everything else) hashed to
``FEATURES`` weights.  First one machine for each family against the rest decides the family; then one
machine for each pair of languages of that family decides the language by their summed margins.

The machines learn from at most ``SAMPLE_ROWS`` different labelled texts of each language, chosen by
hash; every language is learned and every text is predicted as a whole.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from flowtable.llm.common import gives_back, table, text_list

FEATURES = 1 << 13
SAMPLE_ROWS = 300  # different labelled texts of a language that the machines learn from
CHUNK = 1 << 20  # characters worked on at a time
UNKNOWN = "und"

# fixed values: families of languages by ISO 639-1 code; a code not listed is a family of its own
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "an ast ca es fr gl it la oc pt rm ro sc",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "uralic": "et fi hu se",
    "turkic": "az ba kk ky tr tt ug uz",
    "indic": "as bn gu hi mr ne pa sa si ur",
    "semitic": "am ar he mt",
    "celtic": "br cy ga gd",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def family(lang: str) -> str:
    return _FAMILY.get(lang.lower().split("-")[0].split("_")[0], lang)


_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For each code point its lower-case code point if it is a letter, else 0; made once in a worker."""
    if not _LETTERS:
        points = range(0x110000)
        _LETTERS.append(np.fromiter(((ord(low) if len(low := chr(p).lower()) == 1 else p) if chr(p).isalpha() else 0
                                     for p in points), np.uint32, len(points)))
    return _LETTERS[0]


def _grams(codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(feature, counted or not) of the 1-, 2- and 3-grams that start at each character.

    ``codes`` ends with two marks; a gram without a letter at its start and end side isn't counted.
    """
    n = len(codes) - 2
    shift = np.uint32(32 - FEATURES.bit_length() + 1)
    h = codes[:n] * np.uint32(0x9E3779B1)
    yield (h >> shift), codes[:n] > 0
    two = (h ^ (codes[1:n + 1] * np.uint32(0x85EBCA77) + np.uint32(1))) * np.uint32(0xC2B2AE3D)
    some = (codes[:n] > 0) | (codes[1:n + 1] > 0)
    yield (two >> shift), some
    three = (two ^ (codes[2:] * np.uint32(0x27D4EB2F) + np.uint32(2))) * np.uint32(0x165667B1)
    yield (three >> shift), codes[1:n + 1] > 0


def _codes(text: str) -> np.ndarray:
    return _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")]


def features(text: str) -> tuple[np.ndarray, np.ndarray] | None:
    """(features, shares) of a whole text; None without a letter."""
    total = np.zeros(FEATURES)
    codes = np.concatenate([_codes(text), np.zeros(2, dtype=np.uint32)])
    for at in range(0, len(codes) - 2, CHUNK):
        for gram, counted in _grams(codes[at:at + CHUNK + 2]):
            total += np.bincount(gram[counted], minlength=FEATURES)
    n = total.sum()
    found = np.flatnonzero(total)
    return (found, total[found] / n) if n else None


def train_svm(x: np.ndarray, y: np.ndarray, cost: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights of a linear machine (hinge loss squared) by dual coordinate descent; y is +1 or -1."""
    rng = np.random.default_rng(0)
    w, alpha = np.zeros(x.shape[1]), np.zeros(len(y))
    size = (x * x).sum(axis=1) + 1 / (2 * cost)
    for _ in range(rounds):
        for i in rng.permutation(len(y)):
            g = y[i] * (w @ x[i]) - 1 + alpha[i] / (2 * cost)
            new = max(alpha[i] - g / size[i], 0.0)
            w += (new - alpha[i]) * y[i] * x[i]
            alpha[i] = new
    return w


@dataclass
class LanguageModel:
    """Machines as columns of ``weights``; ``families`` maps a family to its column and languages."""

    weights: np.ndarray
    families: list[tuple[int, list[str]]]  # (column, languages)
    pairs: list[list[tuple[int, int, int]]]  # for each family (column, first language, second language)

    def decide(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Languages and scores of rows of margins."""
        n = len(margins)
        first = np.stack([margins[:, c] for c, _ in self.families], axis=1)
        which, sure = first.argmax(axis=1), _softmax(first)
        lang, score = np.empty(n, dtype=object), np.zeros(n)
        for f, (_, langs) in enumerate(self.families):
            rows = np.flatnonzero(which == f)
            votes = np.zeros((len(rows), len(langs)))
            for c, a, b in self.pairs[f]:
                votes[:, a] += margins[rows, c]
                votes[:, b] -= margins[rows, c]
            best = votes.argmax(axis=1) if len(rows) else np.zeros(0, dtype=int)
            lang[rows] = np.array(langs, dtype=object)[best]
            score[rows] = sure[rows, f] * _softmax(votes)[np.arange(len(rows)), best]
        return lang, score


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(2 * (x - x.max(axis=1, keepdims=True))) if x.size else x
    return e / e.sum(axis=1, keepdims=True) if x.size else x


def fit(rows: list[tuple[str, np.ndarray, np.ndarray]]) -> LanguageModel | None:
    """Machines from (language, features, shares); None without rows."""
    if not rows:
        return None
    x = np.zeros((len(rows), FEATURES), dtype=np.float32)
    for i, (_, at, share) in enumerate(rows):
        x[i, at] = np.sqrt(share)
    # the mean of weights over grams is linear in the shares, so the machines are trained on these, scaled
    scale = 1.0 / np.maximum(np.sqrt((x ** 2).mean(axis=0)), 1e-3)
    x = (x ** 2) * scale
    lang = np.array([r[0] for r in rows])
    names = sorted(set(lang))
    group = {f: [n for n in names if family(n) == f] for f in sorted({family(n) for n in names})}
    norm = np.sqrt((x ** 2).sum(axis=1).mean())
    x /= norm
    columns, families, pairs = [], [], []
    owner = np.array([family(n) for n in lang])
    for f, langs in group.items():
        columns.append(train_svm(x, np.where(owner == f, 1.0, -1.0)) if len(group) > 1 else np.zeros(FEATURES))
        families.append((len(columns) - 1, langs))
        own = []
        for a, b in itertools.combinations(range(len(langs)), 2):
            pick = (lang == langs[a]) | (lang == langs[b])
            columns.append(train_svm(x[pick], np.where(lang[pick] == langs[a], 1.0, -1.0)))
            own.append((len(columns) - 1, a, b))
        pairs.append(own)
    weights = np.stack(columns, axis=1) * (scale / norm)[:, None]
    return LanguageModel(weights.astype(np.float32), families, pairs)


@gives_back
def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [features(t) for t in text_list(batch.column("text"))]
        keep = [f is not None for f in found]
        found = [f for f in found if f is not None]
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang").filter(pa.array(keep, pa.bool_())).cast(pa.string()),
             pa.array([f[0].tolist() for f in found], pa.list_(pa.int32())),
             pa.array([f[1].tolist() for f in found], pa.list_(pa.float64()))], ["lang", "at", "share"])


def margins_of(texts: list[str], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Margins of whole texts and whether each has a letter."""
    total = np.zeros((len(texts), weights.shape[1]))
    count = np.zeros(len(texts))
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) < CHUNK):
            size += len(texts[end]) + 2
            end += 1
        # two marks between texts keep grams inside them; a longer text is worked off in parts
        joined = _codes("\0\0".join([*texts[at:end], ""]))
        owner = np.repeat(np.arange(at, end), [len(t) + 2 for t in texts[at:end]])
        own = np.repeat([True, False] * (end - at), [n for t in texts[at:end] for n in (len(t), 2)])
        for lo in range(0, max(len(joined) - 2, 0), CHUNK):
            part = joined[lo:lo + CHUNK + 2]
            who = owner[lo:lo + len(part) - 2]
            starts = np.flatnonzero(np.r_[True, np.diff(who) != 0]) if len(who) else np.zeros(0, dtype=int)
            for gram, counted in _grams(part):
                if len(who):
                    counted = counted & own[lo:lo + len(who)]  # none begins at the marks between texts
                    got = weights[gram]
                    got[~counted] = 0
                    total[who[starts]] += np.add.reduceat(got, starts, axis=0)
                    count[who[starts]] += np.add.reduceat(counted.astype(np.int64), starts)
        at = end
    return total / np.maximum(count, 1)[:, None], count > 0


def _predict(model):
    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: LanguageModel | None = model.value
        for batch in batches:
            texts = text_list(batch.column("row").field("text"))
            if m is None:
                lang, score = np.full(len(texts), UNKNOWN, dtype=object), np.zeros(len(texts))
            else:
                margins, some = margins_of(texts, m.weights)
                lang, score = m.decide(margins)
                lang[~some], score[~some] = UNKNOWN, 0.0
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                             ["row", "lang_pred", "score"])
    return run


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> LanguageModel | None:
    """Machines from ``docs`` (``lang``, ``text``); null languages and texts without letters teach nothing.

    What reaches the driver is one count and at most ``sample_rows`` texts' features for each language: it
    grows with the number of languages, not with the rows.  Copies of a text are one text of the sample.
    """
    spark = docs.sparkSession
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text", F.xxhash64("text").alias("_order"))
    counts = known.groupBy("lang").agg(F.approx_count_distinct("_order").alias("n")).collect()
    if not counts:
        return None
    # about four times the sample by hash, its copies folded before the shuffle, then exactly the sample: no
    # language is sorted as a whole
    shares = spark.createDataFrame([(r[0], min(1.0, 4 * sample_rows / max(r[1], 1))) for r in counts], "lang string, _share double")
    drawn = (known.join(F.broadcast(shares), "lang")  # one short row a language, which the driver holds already
             .where(F.pmod("_order", F.lit(1 << 20)) < F.col("_share") * (1 << 20))
             .groupBy("lang", "text").agg(F.first("_order").alias("_order")))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("_order", "text"))
    ranked = drawn.withColumn("_n", place).where(F.col("_n") <= sample_rows)
    rows = ranked.select("lang", "text").mapInArrow(_describe, "lang string, at array<int>, share array<double>").collect()
    rows = [(r[0], np.array(r[1], dtype=int), np.array(r[2])) for r in rows]
    rows.sort(key=lambda r: (r[0], len(r[1]), r[1].tolist(), r[2].tolist()))
    return fit(rows)


def identify(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``row`` (a struct of all columns of ``docs``), ``lang_pred`` and ``score`` from the whole ``text``.

    A null text or one without letters is ``und`` with score 0, as is every text without a model.
    Nothing clashes with columns of ``docs``, whatever their names.
    """
    value = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES rows, one column for each machine
    asked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    schema = T.StructType([asked.schema["row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return asked.mapInArrow(_predict(value), schema)


def held_out_rows(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text mod 3 is 1; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 3 == 1


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(~held_out_rows()))
    return identify(docs.select("doc_id", "text"), model).select(
        F.col("row.doc_id").cast("long").alias("doc_id"), held_out_rows("row.doc_id").alias("held_out"), "lang_pred", "score")
