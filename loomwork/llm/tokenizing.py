"""Encoding of words with public tokenizer files, each distinct word once.

Both tokenizer families used here cut a text into words before any merge, so the ids of a text are the ids of its words
in order. Words are encoded many at a time: joined by a special token of the tokenizer, whose id parts the result again.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
from tokenizers import Tokenizer

#: White space as the tokenizers' patterns have it.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Words of byte-level tokenizers: a word takes the one space before it, other white space stands alone.
BYTE_LEVEL_WORDS = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: Words a task remembers.
REMEMBERED = 600_000
_TOGETHER = 500


def _after_letters(text: np.ndarray) -> bool:
    """Whether every full stop and comma before white space follows a lower-case ASCII letter or one that begins with C3."""
    ends = (text[2:] == 32) | (text[2:] == 10)
    at = np.flatnonzero(((text[1:-1] == 46) | (text[1:-1] == 44)) & ends)
    last, first = text[at], text[np.maximum(at, 1) - 1]
    latin = (first == 0xC3) & (last >= 0x80) & (last <= 0xBF) & (last != 0x97) & (last != 0xB7)
    return bool((((last >= 97) & (last <= 122)) | latin).all())


def word_end_words(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text for tokenizers that lower-case, drop white space and part letters from punctuation.

    Lower-casing and parting full stops and commas from the letter before leaves fewer distinct words. Texts where that
    could change the outcome (combining marks, what may be a special token, marks after others) are only cut at white space.
    """
    if not text:
        return []
    if b"<|" in text or b"\xcc" in text or b"\xcd" in text:
        return text.split()
    low = text.lower()
    if _after_letters(np.frombuffer(low, np.uint8)):
        for mark in (b". ", b", ", b".\n", b",\n"):
            low = low.replace(mark, b" " + mark)
    return low.split()


class WordEncoder:
    """Little-endian unsigned 32-bit ids of words, remembered up to a bound."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = {t.content: i for i, t in sorted(self.tokenizer.get_added_tokens_decoder().items()) if t.special}
        self.part, self.part_id = next(iter(self.special.items()), (None, None))
        suffix, vocabulary = getattr(self.tokenizer.model, "end_of_word_suffix", None), self.tokenizer.get_vocab(True)
        self.ends: np.ndarray | None = None
        if suffix:
            self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
            self.ends[[i for piece, i in vocabulary.items() if piece.endswith(suffix)]] = True
        self.known: dict[bytes, bytes] = {}

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def encode(self, words: list[str]) -> list[bytes]:
        """The ids of each word.

        Where pieces that end a word are marked in the vocabulary, words of letters are joined by spaces and their ends
        read from the ids; others are joined by a special token, and those that hold one are encoded alone.
        """
        out: list[bytes | None] = [None] * len(words)
        letters = [i for i, w in enumerate(words) if w.isalpha()] if self.ends is not None else []
        for some, ids in self._together(words, letters, " "):
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(some):
                self._deal(out, some, ids, [0, *ends[:-1].tolist()], ends.tolist())
        plain = [i for i, ids in enumerate(out) if ids is None] if self.part else []
        held = "\n".join([words[i] for i in plain])
        if "" in words or any(x in held for x in self.special):
            plain = [i for i in plain if words[i] and not any(x in words[i] for x in self.special)]
        for some, ids in self._together(words, plain, self.part):
            ends = np.flatnonzero(ids == self.part_id).tolist()
            self._deal(out, some, ids, [0, *(e + 1 for e in ends)], [*ends, len(ids)])
        return [self.ids(w).tobytes() if ids is None else ids for w, ids in zip(words, out)]

    def _together(self, words: list[str], chosen: list[int], glue: str) -> Iterator[tuple[list[int], np.ndarray]]:
        parts = [chosen[start : start + _TOGETHER] for start in range(0, len(chosen), _TOGETHER)]
        texts = [glue.join([words[i] for i in some]) for some in parts]
        for some, encoded in zip(parts, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            yield some, np.array(encoded.ids, dtype="<u4")

    @staticmethod
    def _deal(out: list[bytes | None], some: list[int], ids: np.ndarray, begins: list[int], ends: list[int]) -> None:
        data = ids.tobytes()
        for i, begin, end in zip(some, begins, ends, strict=True):
            out[i] = data[4 * begin : 4 * end]

    def learn(self, words: Iterable[bytes]) -> dict[bytes, bytes]:
        """Ids of these UTF-8 words, among others met before.

        Beyond the bound the later half is forgotten: frequent words were met early.
        """
        needed = set(words)
        new = needed.difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.known = dict(islice(self.known.items(), REMEMBERED // 2))
            new = needed.difference(self.known)
        self.known.update(zip(new, self.encode([w.decode() for w in new])))
        return self.known


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """The encoder of a task's process, in one thread: Spark runs as many tasks as there are cores."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordEncoder(path)
