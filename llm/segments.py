"""Texts as code point arrays, cut into segments whose results are worked out once per distinct segment."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from llm.common import ragged

_RANDOM = np.random.default_rng(20_240_229).integers(1, 2**63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array, and where each starts."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return flat, np.cumsum(lengths) - lengths


def segment_keys(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each segment ``starts[i] .. starts[i + 1] - 1``, its length included.

    Multilinear hashing with fixed random odd factors; position 4096 and later use a second factor, so that
    segments of any length are covered.
    """
    lengths = np.diff(np.append(starts, len(flat)))
    place = np.arange(len(flat), dtype=np.int64) - np.repeat(starts, lengths)
    mixed = flat.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    factor = _RANDOM[place & 4095]
    if lengths.max(initial=0) > 4096:
        factor *= (place >> 12).astype(np.uint64) * np.uint64(0x94D049BB133111EB) * np.uint64(2) + np.uint64(1)
    mixed *= factor
    keys = np.add.reduceat(mixed, starts) if len(starts) else np.zeros(0, np.uint64)
    keys += lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    keys ^= keys >> np.uint64(32)
    return keys


class SegmentCache:
    """Lists of integers by segment. ``compute`` gets the texts of segments that are new; at most ``limit`` are kept."""

    def __init__(self, compute: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = 1_200_000) -> None:
        self.compute, self.limit = compute, limit
        self.clear()

    def clear(self) -> None:
        self.keys, self.offset, self.length = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.chunks: list[np.ndarray] = []
        self.values = np.zeros(0, np.int32)

    def look_up(self, flat: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each segment, where its list starts in ``self.values``, and its length."""
        keys, first, back = np.unique(segment_keys(flat, starts), return_index=True, return_inverse=True)
        if len(self.keys) > self.limit:
            self.clear()
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        if not known.all():
            new = np.flatnonzero(~known)
            ends = np.append(starts, len(flat))
            values, lengths = self.compute(_texts(flat, starts[first[new]], ends[first[new] + 1]))
            offset = len(self.values) + np.cumsum(lengths) - lengths
            self.values = np.concatenate([self.values, values.astype(np.int32)])
            self.keys = np.insert(self.keys, at[new], keys[new])
            self.offset = np.insert(self.offset, at[new], offset)
            self.length = np.insert(self.length, at[new], lengths)
            at = np.searchsorted(self.keys, keys)
        return self.offset[at][back], self.length[at][back]


def _texts(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[str]:
    lengths = ends - starts
    joined = flat[ragged(starts, lengths)].tobytes().decode("utf-32-le", "surrogatepass")
    stops = np.cumsum(lengths).tolist()
    return [joined[a:b] for a, b in zip([0, *stops], stops)]
