"""Token counts by a count-only Viterbi search.

An Aho-Corasick automaton enumerates every vocabulary piece in a word, by end and then by length; the
search keeps, for every position, the best score and the number of pieces that reached it - no way back
and no ids.  Equal words have equal counts, so each task counts its distinct words once.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from flowtable.llm.common import mapped, table, text_list
from flowtable.llm.unigram import MARK, UnigramVocabulary, vocabulary

TABLE_WORDS = 400_000  # words kept by a worker; beyond it the table starts anew, the counts stay the same


class TokenCounter(dict):
    """Number of tokens of each marked word without its mark, counted when first asked for."""

    def __init__(self, vocab: UnigramVocabulary):
        super().__init__()
        self.vocab = vocab
        self.pieces = ahocorasick.Automaton()
        for piece, score in vocab.score.items():
            self.pieces.add_word(piece, (len(piece), score))
        self.pieces.make_automaton()

    def count(self, word: str) -> int:
        """Tokens of a marked word."""
        single, unknown = self.vocab.score, self.vocab.unknown
        best, tokens = [0.0] * (len(word) + 1), [0] * (len(word) + 1)

        def finish(end: int) -> None:
            """The last candidate for an end: one character that is no piece, as bytes."""
            if end and word[end - 1] not in single:
                value = best[end - 1] + unknown
                if not tokens[end] or value > best[end]:
                    best[end], tokens[end] = value, tokens[end - 1] + len(word[end - 1].encode())

        at = 0
        for last, (size, score) in self.pieces.iter(word):
            while at <= last:
                finish(at)
                at += 1
            value = best[at - size] + score
            if not tokens[at] or value > best[at]:
                best[at], tokens[at] = value, tokens[at - size] + 1
        while at < len(word):
            finish(at)
            at += 1
        finish(at)
        return tokens[at]

    def __missing__(self, word: str) -> int:
        if len(self) >= TABLE_WORDS:
            self.clear()
        self[word] = n = self.count(MARK + word)
        return n

    def total(self, text: str) -> int:
        return sum(map(self.__getitem__, text.replace(MARK, " ").split(" "))) if text else 0


_COUNTERS: dict[str, TokenCounter] = {}


def token_counter(path: str) -> TokenCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = TokenCounter(vocabulary(path))
    return _COUNTERS[path]


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = token_counter(path)
        for batch in batches:
            n = [counter.total(t) for t in text_list(batch.column("text"))]
            names = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(n, pa.int64())], [*names, "n_tokens"])
    return run


def count_tokens(docs: DataFrame, model_path: str) -> DataFrame:
    """All columns of ``docs`` but ``text``, with ``n_tokens``; a column of that name is replaced.

    Null and empty texts have none; equal rows are counted each; no rows give no rows.
    """
    return mapped(docs, "text", StructField("n_tokens", LongType()), _count(model_path))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Characters and tokens of every document under the public model's vocabulary."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return count_tokens(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                    F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("text_chars"), "text"),
                        public_tokenizers.path("piece_bpe_32k.model"))
