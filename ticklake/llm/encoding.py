"""Token ids of whole Arrow batches by a public word-based BPE vocabulary.

The vocabulary drops white space, so a text's ids are its words' ids one
after another.  Each distinct word of a batch is encoded once and its ids
gathered with NumPy; a worker keeps the ids of words that it has seen, up to
``MAX_WORDS`` words (then it starts anew), so memory is bounded.
"""

from __future__ import annotations

import numpy as np

from ticklake.llm.words import Words

MAX_WORDS = 1_500_000
_ENCODERS: dict[str, "WordEncoder"] = {}


def encoder(path: str) -> "WordEncoder":
    """The worker's encoder for the vocabulary file ``path``."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


class PartEncoder:
    """Ids of texts whose parts are encoded independently; remembers the parts that it has seen."""

    def __init__(self, max_words: int = MAX_WORDS):
        self.max_words = max_words
        self._clear()

    def _parts(self, texts) -> Words:
        return Words(texts)

    def _encode_new(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all parts, number of ids of each)."""
        raise NotImplementedError

    def _clear(self) -> None:
        self.hashes = np.zeros(0, np.uint64)  # sorted
        self.slot = np.zeros(0, np.int64)     # of each hash: its place in begin / length
        self.begin = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, words: Words, at: np.ndarray, hashes: np.ndarray) -> None:
        """Encode the words at the indices ``at`` (hashes ascending and new)."""
        ids, length = self._encode_new([words.word(i) for i in at])
        begin = len(self.ids) + np.cumsum(length) - length
        self.ids = np.concatenate([self.ids, ids])
        slot = len(self.begin) + np.arange(len(at))
        self.begin, self.length = np.concatenate([self.begin, begin]), np.concatenate([self.length, length])
        place = np.searchsorted(self.hashes, hashes)
        self.hashes, self.slot = np.insert(self.hashes, place, hashes), np.insert(self.slot, place, slot)

    def _slots(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(slot of each distinct word, index of its distinct word for each word)."""
        distinct, at, inverse = np.unique(words.hashes(), return_index=True, return_inverse=True)
        if len(self.hashes) + len(distinct) > self.max_words:
            self._clear()
        place = np.searchsorted(self.hashes, distinct)
        known = np.zeros(len(distinct), bool)
        inside = place < len(self.hashes)
        known[inside] = self.hashes[place[inside]] == distinct[inside]
        if not known.all():
            self._learn(words, at[~known], distinct[~known])
            place = np.searchsorted(self.hashes, distinct)
        return self.slot[place], inverse

    def counts(self, texts) -> np.ndarray:
        """Number of ids of each text (null: 0)."""
        words = self._parts(texts)
        if not len(words):
            return np.zeros(len(words.first) - 1, np.int64)
        slot, inverse = self._slots(words)
        total = np.concatenate([[0], np.cumsum(self.length[slot][inverse])])
        return np.diff(total[words.first])

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts as uint32, offsets of each text)."""
        words = self._parts(texts)
        if not len(words):
            return np.zeros(0, np.uint32), np.zeros(len(words.first), np.int64)
        slot, inverse = self._slots(words)
        slot = slot[inverse]
        length = self.length[slot]
        total = np.concatenate([[0], np.cumsum(length)])
        take = np.repeat(self.begin[slot] - total[:-1], length) + np.arange(total[-1])
        return self.ids[take], total[words.first]


class WordEncoder(PartEncoder):
    """Words by a vocabulary file of the tokenizers library that drops white space."""

    def __init__(self, path: str, max_words: int = MAX_WORDS):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        super().__init__(max_words)

    def _encode_new(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        texts = [p.decode("utf-8", "replace") for p in parts]
        got = [self._plain(t) for t in texts]
        rest = [i for i, g in enumerate(got) if g is None]
        for i, e in zip(rest, self.tokenizer.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False), strict=True):
            got[i] = e.ids
        length = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter((i for g in got for i in g), np.uint32, int(length.sum())), length

    def _plain(self, text: str) -> list[int] | None:
        """Ids of ASCII letters with at most one mark behind (the pre-tokenizer splits those there); else None.

        Lower-casing is all that the normalizer does to them, and byte-level
        spelling leaves them as they are, so the merges can run directly.
        """
        if not text.isascii():
            return None
        if text.isalpha():
            return [t.id for t in self.tokenizer.model.tokenize(text.lower())]
        if text[:-1].isalpha() and text[-1] in ".,;:!?":
            return [t.id for part in (text[:-1].lower(), text[-1]) for t in self.tokenizer.model.tokenize(part)]
        return None
