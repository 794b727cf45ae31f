"""Token ids of a word-level tokenizer, one encoding per distinct word.

The tokenizer's pre-tokenizer never joins characters across white space, so the ids of a text are the
ids of its white-space separated words in order.  Words are looked up in a table that lives as long as
the Python worker; only unseen ones reach the tokenizer.
"""

from __future__ import annotations

import gc
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from flowtable.llm.common import utf8_list

TABLE_WORDS = 250_000  # words of a generation of the table; a worker keeps the last two, the ids stay the same
SPECIAL = "<|"  # special tokens begin so and are matched before lower-casing
CHUNK_WORDS = 1 << 20  # words whose ids are laid out at once
LINE_WORDS = 250  # words encoded at once
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"  # normal and lower-case as they are
PUNCTUATION = "!\"#$%&()*+,-./:;=?@[]^_`{}~|<>"

_of_letters = re.compile(f"[{LETTERS}]+").fullmatch


class WordCodes:
    """Ids of words as little-endian unsigned 16-bit bytes (vocabularies of up to 65,536 ids)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids do not fit 16 bits")
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends_piece = np.zeros(1 << 16, dtype=bool)
        for piece, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.ends_piece[i] = bool(suffix) and piece.endswith(suffix)
        # the same model without the steps that leave lines of LETTERS as they are, if this file's steps do
        self.bare = Tokenizer(self.tokenizer.model)
        self.bare.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        line = " ".join([LETTERS, LETTERS[::-1], *LETTERS])
        if self.bare.encode(line).ids != self.tokenizer.encode(line, add_special_tokens=False).ids:
            self.bare = self.tokenizer
        self.words: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _encode(self, words: list[bytes]) -> list[bytes]:
        """Ids of words.  Words of letters alone are one piece each, so a line of them is encoded at
        once and cut behind the ids that end a piece; the others are encoded one by one."""
        if not words:
            return []
        out: list[bytes] = [b""] * len(words)
        texts = b" ".join(words).decode().split(" ")
        simple, plain, left = [], [], []
        for i, t in enumerate(texts):
            (simple if _of_letters(t) else plain if t.isalpha() else left).append(i)
        for tokenizer, some in ((self.bare, simple), (self.tokenizer, plain)):
            lines = [some[at:at + LINE_WORDS] for at in range(0, len(some), LINE_WORDS)]
            found = tokenizer.encode_batch_fast([" ".join([texts[i] for i in line]) for line in lines], add_special_tokens=False)
            for line, x in zip(lines, found):
                ids = np.array(x.ids, dtype="<u2")
                ends = np.flatnonzero(self.ends_piece[ids]) + 1
                if len(ends) != len(line):  # a letter whose lower case is more than a letter
                    left += line
                    continue
                data, lo = ids.tobytes(), 0
                for i, hi in zip(line, (2 * ends).tolist()):
                    out[i] = data[lo:hi]
                    lo = hi
        for i, x in zip(left, self.tokenizer.encode_batch_fast([texts[i] for i in left], add_special_tokens=False)):
            out[i] = np.array(x.ids, dtype="<u2").tobytes()
        return out

    def _learn(self, words: set[bytes]) -> None:
        """Enter words that are not in the table."""
        known = words & self.older.keys()
        self.words.update(zip(known, map(self.older.__getitem__, known)))
        new = list(words - known)
        self.words.update(zip(new, self._encode(new)))

    def _codes_of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of words one after another, with the number of each word's ids and where they start.

        Punctuation at a word's end, behind a letter, is a piece of its own, so "word," and "word" share an encoding.
        """
        core = pc.ascii_rtrim(words, characters=PUNCTUATION)
        cut = pc.and_not(pc.and_(pc.less(pc.binary_length(core), pc.binary_length(words)), pc.match_substring_regex(core, "[a-z]$")),
                         pc.match_substring(words, SPECIAL))
        tails = pc.replace_substring_regex(words.filter(cut), "^.*[a-z]", "")
        coded = pa.concat_arrays([pc.if_else(cut, core, words), tails]).dictionary_encode()
        ids = self._ids_of(utf8_list(coded.dictionary))
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 2
        pool, start = np.frombuffer(b"".join(ids), "<u2"), np.cumsum(size) - size
        del ids
        cut, at = cut.to_numpy(zero_copy_only=False), coded.indices.to_numpy()
        first = np.arange(len(cut)) + np.cumsum(cut) - cut  # a word's place among all pieces; its tail's is the next one
        pieces = np.empty(len(at), dtype=np.int64)
        pieces[first], pieces[first[cut] + 1] = at[:len(cut)], at[len(cut):]
        n = size[pieces]
        to = np.cumsum(n) - n
        flat = pool[np.arange(n.sum()) + np.repeat(start[pieces] - to, n)]
        start = to[first]
        return flat, np.diff(start, append=len(flat)), start

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text of a string column; null is empty.

        Words are split and numbered in Arrow; Python sees each distinct word of a batch once.
        """
        texts = pc.fill_null(texts, "")
        texts = pc.if_else(pc.match_substring(texts, SPECIAL), texts, pc.ascii_lower(texts))
        words = pc.ascii_split_whitespace(texts)
        coded = words.flatten().dictionary_encode()
        gc.disable()  # nothing here makes cycles, and the collector would walk the table again and again
        try:
            pool, size, start = self._codes_of(coded.dictionary)
        finally:
            gc.enable()
        at, ends = coded.indices.to_numpy(), words.offsets.to_numpy().astype(np.int64)
        ends = ends - ends[0]
        lo = 0
        while lo < len(texts):  # texts of about CHUNK_WORDS words at a time
            hi = min(max(lo + 1, int(np.searchsorted(ends, ends[lo] + CHUNK_WORDS))), len(texts))
            part = at[ends[lo]:ends[hi]]
            n = size[part]
            to = np.concatenate([[0], np.cumsum(n)])
            flat = pool[np.arange(to[-1]) + np.repeat(start[part] - to[:-1], n)]
            bounds = to[ends[lo:hi + 1] - ends[lo]].tolist()
            for x, y in zip(bounds, bounds[1:]):
                yield flat[x:y]
            lo = hi

    def _ids_of(self, words: list[bytes]) -> list[bytes]:
        out: list[bytes] = []
        for at in range(0, len(words), TABLE_WORDS // 4):
            part = words[at:at + TABLE_WORDS // 4]
            if len(self.words) > TABLE_WORDS:
                self.older, self.words = self.words, {}
            self._learn(set(part).difference(self.words))
            out.extend(map(self.words.__getitem__, part))
        return out


_CODES: dict[str, WordCodes] = {}


def word_codes(path: str) -> WordCodes:
    """The table of this worker for a tokenizer file."""
    if path not in _CODES:
        _CODES[path] = WordCodes(path)
    return _CODES[path]
