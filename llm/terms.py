"""Runs of characters of a class in whole texts, as 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from llm.common import slices
from llm.segments import _texts, code_points, segment_keys

CHARS = 600_000

#: The ASCII characters inside a run; characters from 0x80 on are inside any run.
WORDS = np.array([c not in (0x20, 9, 10, 11, 12, 13) for c in range(128)])
ALNUM = np.array([chr(c).isalnum() for c in range(128)])
LETTERS = np.array([chr(c).isalpha() for c in range(128)])


class Runs:
    """The runs of some texts in order: ``keys`` (A-Z in lower case), ``owner`` (number of the text), and their text."""

    def __init__(self, texts: list[str], inside: np.ndarray) -> None:
        flat, starts = code_points(texts)
        size = len(flat)
        if not size:
            self.keys, self.owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            return
        self.flat = flat = flat + np.where((flat >= 65) & (flat <= 90), np.uint32(32), np.uint32(0))
        word = inside[np.minimum(flat, 127)] | (flat > 127)
        cut = np.append(True, word[1:] != word[:-1])
        cut[starts[starts < size]] = True
        cuts = np.flatnonzero(cut)
        of = word[cuts]
        self.keys = segment_keys(flat, cuts)[of]
        self.starts, self.ends = cuts[of], np.append(cuts[1:], size)[of]
        self.owner = np.searchsorted(starts, self.starts, "right") - 1

    def texts(self, which: np.ndarray) -> list[str]:
        return _texts(self.flat, self.starts[which], self.ends[which]) if len(which) else []


def runs(texts: list[str], inside: np.ndarray) -> Iterator[tuple[int, int, Runs]]:
    """Slices of the texts (first, stop) with their runs."""
    for first, stop in slices(np.fromiter(map(len, texts), np.int64, len(texts)), CHARS):
        yield first, stop, Runs(texts[first:stop], inside)


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of the values of each."""
    if not len(keys):
        return keys, values
    by = np.argsort(keys, kind="stable")
    keys, values = keys[by], values[by]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(values, first)
