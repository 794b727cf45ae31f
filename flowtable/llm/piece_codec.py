"""SentencePiece encoding and decoding by a Viterbi search that shares prefixes.

The distinct marked words of a batch are sorted, which lists a trie of them depth-first: a word begins with
the prefix that it shares with the one before it.  The forward scores of a position depend on the prefix
alone, so only the positions behind the shared prefix are worked out anew.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField

from flowtable.llm.common import mapped, table, text_list
from flowtable.llm.unigram import MARK, UnigramVocabulary, vocabulary

TABLE_WORDS = 200_000  # words kept by a worker; beyond it the table starts anew, the ids stay the same


class PieceCodec:
    """Ids of texts and texts of ids."""

    def __init__(self, vocab: UnigramVocabulary):
        self.vocab = vocab
        self.words: dict[str, bytes] = {}
        # pieces backwards as a trie: None holds (score, id)
        self.ends: dict = {}
        for piece, score in vocab.score.items():
            node = self.ends
            for c in reversed(piece):
                node = node.setdefault(c, {})
            node[None] = (score, vocab.id[piece])

    def segment(self, words: Iterable[str]) -> Iterator[tuple[str, list[int]]]:
        """(word, ids) of sorted marked words."""
        vocab, ends = self.vocab, self.ends
        best, back, piece = [0.0], [0], [-1]  # score, start and id of the last piece for every position
        before = ""
        for word in words:
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del best[shared + 1:], back[shared + 1:], piece[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                # one character as bytes, if it is no piece, loses every tie
                found = word[end - 1] not in vocab.score
                top, start, number = best[end - 1] + vocab.unknown, end - 1, -1
                node, at = ends, end
                while at and (node := node.get(word[at - 1])) is not None:
                    at -= 1
                    if None in node:
                        score, number_at = node[None]
                        value = best[at] + score
                        # starts come from right to left and the leftmost wins a tie
                        if value >= top or not found:
                            top, start, number, found = value, at, number_at, True
                best.append(top)
                back.append(start)
                piece.append(number)
            ids, at = [], len(word)
            while at:
                if piece[at] >= 0:
                    ids.append(piece[at])
                else:
                    ids.extend(vocab.byte_id[b] for b in reversed(word[at - 1].encode()))
                at = back[at]
            ids.reverse()
            yield word, ids
            before = word

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        split = [t.replace(MARK, " ").split(" ") if t else [] for t in texts]
        out: list[bytes] = []
        at = 0
        while at < len(split):  # in steps whose words fit the table
            words, end = set(split[at]), at + 1
            while end < len(split) and len(words) < TABLE_WORDS // 4:
                words.update(split[end])
                end += 1
            new = words.difference(self.words)
            if len(self.words) + len(new) > TABLE_WORDS:
                self.words.clear()
                new = words
            for word, ids in self.segment(sorted(MARK + w for w in new)):
                self.words[word[1:]] = np.array(ids, dtype="<i4").tobytes()
            out += [b"".join(map(self.words.__getitem__, w)) for w in split[at:end]]
            at = end
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that form no character become U+FFFD."""
        surface = b"".join(map(self.vocab.surface.__getitem__, ids))
        return surface.removeprefix(b" ").decode("utf-8", "replace")


_CODECS: dict[str, PieceCodec] = {}


def piece_codec(path: str) -> PieceCodec:
    if path not in _CODECS:
        _CODECS[path] = PieceCodec(vocabulary(path))
    return _CODECS[path]


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = piece_codec(path)
        for batch in batches:
            ids = codec.encode(text_list(batch.column("text")))
            ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<i4")))
            names = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), lists], [*names, "ids"])
    return run


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = piece_codec(path)
        for batch in batches:
            texts = [codec.decode(x or []) for x in batch.column("ids").to_pylist()]
            names = [c for c in batch.schema.names if c != "ids"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(texts, pa.string())], [*names, "text"])
    return run


def encode_texts(docs: DataFrame, model_path: str) -> DataFrame:
    """All columns of ``docs`` but ``text``, with ``ids`` (replaced if there); null and empty texts have none."""
    return mapped(docs, "text", StructField("ids", ArrayType(IntegerType())), _encode(model_path))


def decode_ids(docs: DataFrame, model_path: str) -> DataFrame:
    """All columns of ``docs`` but ``ids``, with ``text`` (replaced if there); null and no ids are an empty text.

    A text comes back as it was, but for marks in it, which the file format can't tell from spaces.
    """
    return mapped(docs, "ids", StructField("text", StringType()), _decode(model_path))


ROWS = 2_000  # documents encoded and decoded at a time


def _round_trip(path: str):
    """Ids, their digests and whether they decode to the text, in one pass: one worker for a task."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_ids", pa.int64()), ("ids_crc32", pa.int64()), ("text_crc32", pa.int64()),
                        ("round_trip", pa.bool_()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = piece_codec(path)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                texts = [t.replace(MARK, " ") for t in text_list(part.column("text"))]
                ids = codec.encode(texts)
                same = [codec.decode(np.frombuffer(x, "<i4").tolist()) == t for x, t in zip(ids, texts)]
                ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                     pa.array([zlib.crc32(t.encode()) for t in texts], pa.int64()), pa.array(same, pa.bool_()),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<i4")))], schema=schema)
    return run


def op5_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and whether decoding them gives the text back (marks taken for spaces)."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(_round_trip(public_tokenizers.path("piece_bpe_32k.model")),
                           "doc_id long, n_ids long, ids_crc32 long, text_crc32 long, round_trip boolean, ids array<int>")
