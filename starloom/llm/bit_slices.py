"""Words one letter apart, by a bit-sliced position index.

The index holds one bitset over its words for every place and letter: the words with that
letter at that place. A word is looked up by going through its letters once. Bitsets carry
the words that agree with it so far (no error), and those that agree but for one letter
replaced (no shift), one more (shifted by one place up) or one less (shifted down). Each
step is a few word-parallel operations, done for many looked-up words at a time.

Words are given in Latin-1, one byte a letter, sorted.
"""

from __future__ import annotations

import numpy as np

_QUERIES = 512
_ZERO_ROW = 0


def letter_matrix(words: list[bytes], width: int) -> np.ndarray:
    """One row a word, filled up with zeros, which are no letter."""
    return np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)


def _bits(members: np.ndarray) -> np.ndarray:
    """Booleans along the last axis as 64-bit words, the first one in the lowest bit."""
    size = -(-members.shape[-1] // 64) * 64
    padded = np.zeros((*members.shape[:-1], size), dtype=bool)
    padded[..., : members.shape[-1]] = members
    return np.packbits(padded, axis=-1, bitorder="little").view(np.uint64)


class BitSlices:
    """The words of length ``short`` and ``short + 1`` of one block."""

    def __init__(self, words: list[bytes], short: int):
        self.short = short
        self.letters = letter_matrix(words, short + 1)
        sizes = np.array([len(w) for w in words])
        self._short_ones, self._long_ones = _bits(sizes == short), _bits(sizes == short + 1)
        self._all = _bits(np.ones(len(words), dtype=bool))
        self._slices, self._row_of = [], []
        for place in range(short + 1):
            column = self.letters[:, place]
            present = np.unique(column[column > 0])
            rows = np.zeros(256, dtype=np.intp)
            rows[present] = np.arange(1, len(present) + 1)
            held = np.concatenate((np.zeros((1, len(column)), bool), column[None, :] == present[:, None]))
            self._slices.append(_bits(held))
            self._row_of.append(rows)

    def _with_letter(self, place: int, letters: np.ndarray) -> np.ndarray:
        return self._slices[place][self._row_of[place][letters]]

    def near(self, queries: np.ndarray, size: int, head: int, same_head: bool) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) pairs one letter apart, by their places.

        ``queries`` are letter rows of words of one length ``size``: ``short``, to find words
        of that length and one more, or ``short + 1``, to find those of ``short``. A pair
        counts if its first ``head`` letters agree, or only if they do not.
        """
        found = [self._near(queries[at : at + _QUERIES], size, head, same_head) for at in range(0, len(queries), _QUERIES)]
        if not found:
            return np.zeros(0, np.intp), np.zeros(0, np.intp)
        who = np.concatenate([pair[0] + at * _QUERIES for at, pair in enumerate(found)])
        return who, np.concatenate([pair[1] for pair in found])

    def _near(self, queries: np.ndarray, size: int, head: int, same_head: bool) -> tuple[np.ndarray, np.ndarray]:
        exact = np.tile(self._all, (len(queries), 1))
        agreeing = exact
        if size == self.short:
            replaced, inserted = np.zeros_like(exact), exact
            for place in range(size):
                here = self._with_letter(place, queries[:, place])
                replaced = (replaced & here) | (exact & ~here)
                exact = exact & here
                inserted = (inserted & self._with_letter(place + 1, queries[:, place])) | exact
                agreeing = exact if place + 1 == head else agreeing
            result = (replaced & self._short_ones) | (inserted & self._long_ones)
        else:
            removed = np.zeros_like(exact)
            for place in range(size):
                if place:
                    removed = removed & self._with_letter(place - 1, queries[:, place])
                removed = removed | exact
                exact = exact & self._with_letter(place, queries[:, place])
                agreeing = exact if place + 1 == head else agreeing
            result = removed & self._short_ones
        result &= agreeing if same_head else ~agreeing
        who, chunk = np.nonzero(result)
        bits = np.unpackbits(result[who, chunk].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        hit, bit = np.nonzero(bits)
        return who[hit], chunk[hit] * 64 + bit
