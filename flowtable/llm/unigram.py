"""A unigram vocabulary read from a public SentencePiece model file, and its segmentation rule.

The pieces and scores of the file are used as a unigram model: the segmentation of a text is the one with the
highest sum of scores.  Scores are added in double precision from left to right.  At an end that several
best segmentations reach, a later candidate replaces an earlier one only if its sum is larger, and
candidates come by their start, so the longest last piece wins a tie.  A character that is no piece
costs the lowest score less 10 and is written as its UTF-8 bytes.

White space is escaped as the file's normaliser does: a space in front, then every space becomes a mark.
No piece that could win holds a mark behind another character, so every marked word - a mark and what
follows it up to the next - is segmented for itself.
"""

from __future__ import annotations

import sentencepiece

MARK = "▁"  # fixed value of the file format
UNKNOWN_PENALTY = 10.0


class UnigramVocabulary:
    """Scores and ids of the pieces that can be matched, ids of bytes, and bytes of every id."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte_id: list[int] = [model.unk_id()] * 256
        self.surface: list[bytes] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.surface.append(bytes([int(piece[3:5], 16)]))
                continue
            plain = not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
            # runs of marks are pieces too, but a run's words are segmented one by one and always score higher
            if plain and MARK not in piece[1:]:
                self.score[piece], self.id[piece] = model.get_score(i), i
            self.surface.append(piece.replace(MARK, " ").encode() if plain else b"")
        scores = [model.get_score(i) for i in range(model.get_piece_size())]
        self.unknown = min(scores, default=0.0) - UNKNOWN_PENALTY
        self.longest = max(map(len, self.score), default=1)


def marked_words(text: str) -> list[str]:
    """Marked words of a text in order; an empty text has none."""
    return [MARK + w for w in text.replace(MARK, " ").split(" ")] if text else []


_VOCABULARIES: dict[str, UnigramVocabulary] = {}


def vocabulary(path: str) -> UnigramVocabulary:
    """The vocabulary of a model file, read once in a worker."""
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = UnigramVocabulary(path)
    return _VOCABULARIES[path]
