"""Sets of word shingles of whole texts, as sorted arrays of 64-bit hashes."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

from llm.common import slices
from llm.segments import code_points, segment_keys

CHARS = 600_000


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = a * np.uint64(0x9E3779B97F4A7C15) + b
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(28)
    return out


def shingle_sets(texts: list[str], n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per slice of the texts: number of the first, all distinct shingles text by text (sorted), and how many each has.

    Words are runs of anything but ASCII white space, A-Z in lower case; a text of fewer than ``n`` words has its whole
    sequence as one shingle, a text without words none."""
    for first, stop in slices(np.fromiter(map(len, texts), np.int64, len(texts)), CHARS):
        part = texts[first:stop]
        flat, starts = code_points(part)
        size = len(flat)
        if not size:
            yield first, np.zeros(0, np.uint64), np.zeros(len(part), np.int64)
            continue
        flat = flat + np.where((flat >= 65) & (flat <= 90), np.uint32(32), np.uint32(0))
        space = (flat == 0x20) | ((flat >= 9) & (flat <= 13))
        cut = np.append(True, space[1:] != space[:-1])
        cut[starts[starts < size]] = True
        cuts = np.flatnonzero(cut)
        word = ~space[cuts]
        keys = segment_keys(flat, cuts)[word]
        owner = np.searchsorted(starts, cuts[word], "right") - 1
        words = np.bincount(owner, minlength=len(part))
        begin = np.cumsum(words) - words
        count = np.where(words >= n, words - n + 1, (words > 0).astype(np.int64))
        who = np.repeat(np.arange(len(part)), count)
        at = np.arange(len(who)) - np.repeat(np.cumsum(count) - count, count) + begin[who]
        left = np.minimum(words[who], n)
        padded = np.append(keys, np.zeros(n, np.uint64))
        shingle = left.astype(np.uint64)
        for k in range(n):
            step = mix(shingle, padded[at + k])
            shingle = np.where(k < left, step, shingle)
        by = np.lexsort((shingle, who))
        shingle, who = shingle[by], who[by]
        new = np.append(True, (shingle[1:] != shingle[:-1]) | (who[1:] != who[:-1])) if len(who) else np.zeros(0, bool)
        yield first, shingle[new], np.bincount(who[new], minlength=len(part))


def exact_shingles(text: str, n: int) -> set[tuple[str, ...]]:
    """The same set, shingles as tuples of words."""
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))
    if not words:
        return set()
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))}
