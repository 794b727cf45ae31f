"""Quality rules: decision lists learned by sequential covering, applied as ordered Spark conditions.

The statistics of a text are DataFrame functions alone.  A decision list is learned from a bounded sample
of labelled statistics: a rule is a conjunction of thresholds grown on two thirds of the sample, pruned
on the rest and kept while it is precise; what it covers is removed and the next rule is learned.  The
list becomes one ``CASE WHEN`` whose first true condition decides.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtable.llm.common import table

SAMPLE_ROWS = 20_000  # labelled rows that a list is learned from, chosen by the hash of their id
MAX_RULES = 24
MAX_CONDITIONS = 4
MIN_PRECISION = 0.9  # of a rule on the pruning part
CANDIDATES = 64  # thresholds tried for each statistic and step
WINDOW = 8

# fixed values: the characters of the query's contract
WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once for each row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words that lie in a run of ``window`` words found at least twice in the list."""
    def runs(codes: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(codes) - (window - 1)),
                           lambda i: F.xxhash64(F.slice(codes, i, window)))

    def covered(hashes: Column) -> Column:
        # (hash, place) in order, so that equal runs are neighbours
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(ordered: Column) -> Column:
            last = F.size(ordered) - 1
            again = F.filter(ordered, lambda e, i: (
                ((i > 0) & (F.get(ordered, i - 1)["h"] == e["h"]))
                | ((i < last) & (F.get(ordered, i + 1)["h"] == e["h"]))))
            return F.array_sort(F.transform(again, lambda e: e["i"]))
        return _let(_let(pairs, places), lambda at: F.coalesce(F.aggregate(
            at, F.struct(F.lit(-window).alias("p"), F.lit(0).cast("long").alias("n")),
            lambda acc, p: F.struct(p.alias("p"), (acc["n"] + F.least(p - acc["p"], F.lit(window))).alias("n")),
            lambda acc: acc["n"]), F.lit(0).cast("long")))

    none = F.lit(0).cast("long")
    return F.when(F.size(words) <= window, none).otherwise(_let(F.transform(words, lambda w: F.xxhash64(w)), lambda codes: _let(
        runs(codes), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(covered(h)))))


def text_statistics(text: Column) -> dict[str, Column]:
    """Statistics of a text by name; null counts as empty.  Words and lines are split once for each row."""
    t = F.coalesce(text, F.lit(""))
    length = F.length(t)
    words = _let(F.filter(F.split(t, r"[\x20\x09-\x0D]+", -1), lambda w: w != ""), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words"),
        F.size(F.array_distinct(w)).cast("long").alias("n_distinct_words")))
    lines = _let(F.filter(F.split(t, "\n", -1), lambda x: F.length(F.translate(x, WHITE, "")) > 0), lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    return {
        "by_word": words,
        "by_line": lines,
        "word_chars": F.length(F.translate(t, WHITE, "")).cast("long"),
        "n_symbols": (length - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
        "n_upper": (length - F.length(F.translate(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).cast("long"),
        "n_exclamations": (length - F.length(F.translate(t, "!?", ""))).cast("long"),
        "n_digits": (length - F.length(F.translate(t, "0123456789", ""))).cast("long"),
    }


def with_statistics(docs: DataFrame, *keep: Column) -> DataFrame:
    """Columns ``keep`` and the statistics of ``text``."""
    plain = docs.select(*keep, *[c.alias(n) for n, c in text_statistics(F.col("text")).items()])
    return plain.select("*", "by_word.*", "by_line.*").drop("by_word", "by_line")


#: What rules put thresholds on, as expressions over the statistics.
MEASURES = {
    "words": "CAST(n_words AS DOUBLE)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbols": "n_symbols / greatest(word_chars, 1)",
    "symbols_a_word": "n_symbols / greatest(n_words, 1)",
    "repeated": "n_repeat_words / greatest(n_words, 1)",
    "distinct": "n_distinct_words / greatest(n_words, 1)",
    "upper": "n_upper / greatest(word_chars, 1)",
    "exclamations": "n_exclamations / greatest(n_words, 1)",
    "digits": "n_digits / greatest(word_chars, 1)",
    "same_lines": "n_dup_lines / greatest(n_lines, 1)",
    "words_a_line": "n_words / greatest(n_lines, 1)",
}


@dataclass(frozen=True)
class Condition:
    measure: str
    above: bool  # measure > threshold, else measure <= threshold
    threshold: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        return x > self.threshold if self.above else x <= self.threshold

    def column(self) -> Column:
        value = F.expr(MEASURES[self.measure])
        return value > self.threshold if self.above else value <= self.threshold


Rule = tuple[Condition, ...]


def _cover(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    hit = np.ones(n, dtype=bool)
    for c in rule:
        hit &= c.holds(x[c.measure])
    return hit


def _grow(x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Add the threshold with the largest information gain until no good row is left."""
    rule: list[Condition] = []
    inside = np.ones(len(bad), dtype=bool)
    while len(rule) < MAX_CONDITIONS and (inside & ~bad).any():
        p0, n0 = (inside & bad).sum(), (inside & ~bad).sum()
        before, best = np.log2(p0 / (p0 + n0)), (1e-9, None)
        for name in x:
            values = x[name][inside]
            marks = bad[inside]
            order = np.argsort(values, kind="stable")
            v, hits = values[order], np.cumsum(marks[order])
            ends = np.flatnonzero(v[1:] > v[:-1])  # a threshold lies between two values
            if not len(ends):
                continue
            ends = ends[np.unique(np.linspace(0, len(ends) - 1, CANDIDATES * 4).astype(int))]
            for above in (False, True):
                p = hits[-1] - hits[ends] if above else hits[ends]
                n = (len(v) - 1 - ends if above else ends + 1) - p
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(p > 0, p * (np.log2(p / (p + n)) - before), 0)
                i = int(gain.argmax())
                if gain[i] > best[0]:
                    best = (gain[i], Condition(name, above, float((v[ends[i]] + v[ends[i] + 1]) / 2)))
        if best[1] is None:
            break
        rule.append(best[1])
        inside &= best[1].holds(x[best[1].measure])
    return tuple(rule)


def learn_decision_list(x: dict[str, np.ndarray], bad: np.ndarray, part: np.ndarray) -> list[Rule]:
    """Rules that reject, in order.  ``part`` is true for rows to grow on and false for rows to prune on."""
    rules: list[Rule] = []
    left = np.ones(len(bad), dtype=bool)
    while len(rules) < MAX_RULES:
        grow, prune = left & part, left & ~part
        if not (bad & grow).any():
            break
        rule = _grow({k: v[grow] for k, v in x.items()}, bad[grow])
        if not rule:
            break

        def worth(r: Rule) -> tuple[float, float]:
            hit = _cover(r, x, len(bad)) & prune
            p, n = (hit & bad).sum(), (hit & ~bad).sum()
            return ((p - n) / max(p + n, 1), p / max(p + n, 1))

        rule = max((rule[:k] for k in range(len(rule), 0, -1)), key=lambda r: worth(r)[0])
        if worth(rule)[1] < MIN_PRECISION:
            break
        rules.append(rule)
        left &= ~_cover(rule, x, len(bad))
    return rules


def rejects(rules: list[Rule]) -> Column:
    """The list as an ordered condition: the first rule that holds rejects, none keeps."""
    verdict = None
    for rule in rules:
        condition = rule[0].column()
        for c in rule[1:]:
            condition = condition & c.column()
        verdict = F.when(condition, True) if verdict is None else verdict.when(condition, True)
    return F.lit(False) if verdict is None else verdict.otherwise(False)


def learn_rules(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """A decision list from ``docs`` (``doc_id``, ``text``) and ``labels`` (``doc_id``, ``quality`` 0 or 1).

    It is learned from the documents of at most ``sample_rows`` labels and at most as many rows.  Labels
    without a document, null labels and null ids teach nothing.  Without a rejected and an accepted
    row the list is empty and keeps everything.
    """
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    known = (labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy(doc_id).agg(F.min("quality").alias("quality"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    measured = docs.select(doc_id, "text").join(F.broadcast(known), "doc_id")  # at most sample_rows rows
    rows = (with_statistics(measured, F.col("doc_id"), F.col("quality"))
            .select("doc_id", "quality", *[F.expr(e).alias(m) for m, e in MEASURES.items()])
            .orderBy(F.xxhash64("doc_id"), "doc_id", *MEASURES).limit(sample_rows).collect())
    bad = np.array([r["quality"] == 0 for r in rows], dtype=bool)
    if not bad.any() or bad.all():
        return []
    x = {m: np.array([r[m] for r in rows], dtype=float) for m in MEASURES}
    return learn_decision_list(x, bad, np.arange(len(rows)) % 3 != 2)


def quality_verdicts(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``row`` (a struct of all columns of ``docs``), the statistics, ``base_failed`` and ``kept``.

    Null and empty texts have zero words and fail the base rule.  Rows with equal or null ids are judged
    each by its own text.  No labels: only the base rule decides.  Nothing clashes with columns of ``docs``.
    """
    rules = learn_rules(docs, labels, sample_rows)
    measured = with_statistics(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return measured.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & ~rejects(rules))


def op9_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality verdict of every document by a decision list learned from ``labels``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = quality_verdicts(docs, table(spark, sf_dir, "labels"))
    return out.select(F.col("row.doc_id").cast("long").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
