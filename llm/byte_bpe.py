"""Ids of the byte-level BPE vocabulary by the tokenizers library, each distinct pre-token encoded once."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import cache

import numpy as np

from llm.common import ragged, slices
from llm.segments import SegmentCache, code_points

CHARS = 600_000  # code points handled at once
_SPACE, _LETTER, _NUMBER, _OTHER, _UNSURE = range(5)


@cache
def _classes() -> np.ndarray:
    """The class of every code point; unsure where two Unicode versions differ, as the library's may be either."""
    import unicodedata

    import regex

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    table = np.full(0x110000, _OTHER, np.uint8)
    for kind, pattern in ((_SPACE, r"\p{White_Space}+"), (_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+")):
        for match in regex.finditer(pattern, every):
            a, b = ord(match.group()[0]), ord(match.group()[-1])
            table[a:b + 1] = kind
    older = np.array([{"L": _LETTER, "N": _NUMBER}.get(unicodedata.category(c)[0], _OTHER) for c in every], np.uint8)
    points = np.append(np.arange(0xD800), np.arange(0xE000, 0x110000))
    table[points[(older != table[points]) & (table[points] != _SPACE)]] = _UNSURE
    return table


def _byte_signs() -> dict[int, int]:
    """Byte-level vocabularies write printable Latin-1 bytes as themselves and the others as signs from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    return {byte: 256 + i for i, byte in enumerate(b for b in range(256) if b not in plain)}


def pre_token_starts(flat: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Where pre-tokens start: runs of letters, digits or other signs, each with one space before it,
    English contractions, and white space (without the last sign before other text)."""
    n = len(flat)
    kind = _classes()[flat]
    begins = np.zeros(n + 4, bool)
    begins[text_starts[text_starts < n]] = True
    begins[n] = True
    run = begins[:n].copy()
    run[1:] |= kind[1:] != kind[:-1]
    start = np.append(run, np.ones(4, bool))
    after_space = np.flatnonzero(run & ~begins[:n] & (kind != _SPACE))
    after_space = after_space[kind[after_space - 1] == _SPACE]
    start[after_space - 1] = True
    start[after_space] = flat[after_space - 1] != 0x20
    quote = np.flatnonzero((flat == 0x27) & run & start[:n])
    padded = np.append(flat, np.zeros(4, flat.dtype))
    follows = (start[quote + 1]) & ~begins[quote + 1]
    quote = quote[follows]
    first, second = padded[quote + 1], padded[quote + 2]
    one = np.isin(first, [ord(c) for c in "stmd"])
    two = ~begins[quote + 2] & np.logical_or.reduce([(first == ord(a)) & (second == ord(b)) for a, b in ("re", "ve", "ll")])
    for at, size in ((quote[one], 2), (quote[two], 3)):
        start[at + 1] = False
        start[at + size] = True
    return np.flatnonzero(start[:n])


class Encoder:
    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.signs = _byte_signs()
        self.cache = SegmentCache(self._encode)

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pre-tokens go straight to the library's model, which spares it a second pre-tokenisation."""
        lists = [[t.id for t in self.model.tokenize(text.encode().decode("latin-1").translate(self.signs))] for text in texts]
        lengths = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter((i for ids in lists for i in ids), np.int32, int(lengths.sum())), lengths

    def encode(self, texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Slices of the texts: the number of the first, the ids of all in a row, and the number of ids of each."""
        for a, b in slices(np.fromiter(map(len, texts), np.int64, len(texts)), CHARS):
            part = texts[a:b]
            odd = {i for i, t in enumerate(part) if any(s in t for s in self.special)}
            if not all(map(str.isascii, part)):
                flat, starts = code_points(part)
                unsure = np.flatnonzero(_classes()[flat] == _UNSURE)
                odd |= {*(np.searchsorted(starts, unsure, "right") - 1).tolist()}
            if odd:
                whole = {i: np.array(self.tokenizer.encode(part[i], add_special_tokens=False).ids, np.int32) for i in odd}
                ids, counts = self._plain([("" if i in whole else t) for i, t in enumerate(part)])
                pieces = np.split(ids, np.cumsum(counts)[:-1])
                pieces = [whole.get(i, p) for i, p in enumerate(pieces)]
                yield a, np.concatenate(pieces), np.array([len(p) for p in pieces], np.int64)
            else:
                yield a, *self._plain(part)

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        flat, starts = code_points(texts)
        if not len(flat):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        cuts = pre_token_starts(flat, starts)
        offset, length = self.cache.look_up(flat, cuts)
        ids = self.cache.values[ragged(offset, length.astype(np.int64))]
        before = np.append(0, np.cumsum(length))
        bounds = before[np.searchsorted(cuts, np.append(starts, len(flat)))]
        return ids, np.diff(bounds)


@cache
def encoder(path: str) -> Encoder:
    """One encoder a worker."""
    return Encoder(path)
