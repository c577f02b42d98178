"""A tokenizers file in tasks: words encoded once, remembered within bounds."""

from __future__ import annotations

import os

import numpy as np

REMEMBERED = 1 << 20
#: Marks that the pre-tokenizer cuts off a letter or digit; a run of one alone stays whole.
MARKS = b".,;:!?"


class Words:
    """Ids of the stretches between ASCII white space, which no token crosses."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.known: dict[bytes, bytes] = {}
        self.marks = {bytes([m]): b"" for m in MARKS}
        for mark in self.marks:
            self.marks[mark] = self._packed([mark])[0]

    def _packed(self, words: list[bytes]) -> list[bytes]:
        encodings = self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        return [np.array(e.ids, dtype=self.kind).tobytes() for e in encodings]

    @staticmethod
    def stem(word: bytes) -> bytes:
        """The word without one mark at its end, where a letter or ASCII digit comes before the mark."""
        if len(word) > 1 and word[-1:] in _MARKS:
            if word[-2:-1].isalnum():
                return word[:-1]
            before = word[:-1].decode()[-1:] if word[-2] >= 0x80 else ""
            # A letter that lower-cases to several characters may end in one that is no letter.
            if before.isalpha() and len(before.lower()) == 1:
                return word[:-1]
        return word

    def learn(self, words: set[bytes]) -> None:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = words.difference(self.known)
        stems = list({self.stem(w) for w in new}.difference(self.known))
        self.known.update(zip(stems, self._packed(stems)))
        for word in new:
            if word not in self.known:
                self.known[word] = self.known[word[:-1]] + self.marks[word[-1:]]

    def encode(self, text: bytes) -> bytes:
        """Packed ids of a text, ``kind`` each."""
        words = text.split()
        self.learn(set(words))
        return b"".join(map(self.known.__getitem__, words))


_MARKS = frozenset(bytes([m]) for m in MARKS)
_loaded: dict[str, Words] = {}


def words_of(path: str) -> Words:
    if path not in _loaded:
        _loaded[path] = Words(path)
    return _loaded[path]
