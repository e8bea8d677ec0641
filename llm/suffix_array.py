"""Two-stage suffix sorting of byte contexts, as deep as a match is long, in arrays.

Positions whose suffix is smaller than the next one's are sorted directly; all others are induced from them by one scan
over the buckets of first bytes (a suffix larger than its successor is met, in order, when its successor is scanned).
Only the positions at which a match may start, and those up to the next directly sorted one, take part.
"""

from __future__ import annotations

import numpy as np

from llm.common import ragged


def words_at(text: np.ndarray, pad: int) -> np.ndarray:
    """The eight bytes from every place on as a number, so that order of numbers is order of bytes."""
    data = np.append(text, np.zeros(pad + 8, np.uint8)).astype(np.uint64)
    for width in (1, 2, 4):
        data = (data[:-width] << np.uint64(8 * width)) | data[width:]
    return data[:len(text) + pad]


def smaller_than_next(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than its successor; always so at ``ends``, which hold the byte 0."""
    rises = np.zeros(len(text), bool)
    rises[:-1] = text[:-1] < text[1:]
    differs = np.ones(len(text), bool)
    differs[:-1] = text[:-1] != text[1:]
    rises[ends] = differs[ends] = True
    place = np.where(differs, np.arange(len(text)), len(text))
    return rises[np.minimum.accumulate(place[::-1])[::-1]]


def sort_directly(places: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """``places`` ordered by their first ``depth`` bytes; only ties are looked at again, eight bytes further."""
    first = words[places]
    by = np.argsort(first)
    order, first = places[by], first[by]
    new = np.append(True, first[1:] != first[:-1])
    active = np.arange(len(order))
    at = 8
    while True:
        # members of groups of one are done
        alone = new & np.append(new[1:], True)
        keep = ~alone
        active, new = active[keep], new[keep]
        if not len(active) or at >= depth:
            return order
        here = order[active]
        key = words[here + at]
        splits = (key[1:] != key[:-1]) & ~new[1:]
        if splits.any():
            group = np.cumsum(new) - 1
            mixed = np.zeros(group[-1] + 1, bool)
            mixed[group[1:][splits]] = True
            part = np.flatnonzero(mixed[group])
            by = np.lexsort((key[part], group[part]))
            order[active[part]] = here[part[by]]
            key[part] = key[part[by]]
            new[1:] |= key[1:] != key[:-1]
        at += 8


def induce(text: np.ndarray, direct: np.ndarray, rises: np.ndarray, member: np.ndarray) -> np.ndarray:
    """All members in order, from the sorted ``direct`` ones, bucket by bucket."""
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    heads = text[direct]
    cuts = np.searchsorted(heads, np.arange(257))
    done = []
    falls = member & ~rises
    for c in range(256):
        bucket = waiting[c]
        wave = np.concatenate(bucket) if bucket else np.zeros(0, np.int64)
        found = [wave]
        while len(wave):  # runs of one byte
            before = wave[wave > 0] - 1
            wave = before[falls[before] & (text[before] == c)]
            found.append(wave)
        found.append(direct[cuts[c]:cuts[c + 1]])
        scanned = np.concatenate(found)
        if not len(scanned):
            continue
        done.append(scanned)
        before = scanned[scanned > 0] - 1
        before = before[falls[before] & (text[before] > c)]
        if len(before):
            head = text[before]
            by = np.argsort(head, kind="stable")
            before, head = before[by], head[by]
            starts = np.flatnonzero(np.append(True, head[1:] != head[:-1]))
            for b, part in zip(head[starts].tolist(), np.split(before, starts[1:])):
                waiting[b].append(part)
    return np.concatenate(done) if done else np.zeros(0, np.int64)


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int, rows: int = 16_000) -> np.ndarray:
    """Length of the common beginning of each suffix in order and the one before it, up to ``depth`` (0 for the first)."""
    out = np.zeros(len(order), np.int64)
    wide = -(-depth // 8) * 8
    view = np.lib.stride_tricks.sliding_window_view(np.append(text, np.zeros(wide, np.uint8)), wide)
    for a in range(1, len(order), rows):
        part = view[order[a - 1:a + rows]]
        out[a:a + rows] = _first_difference(part[1:], part[:-1])
    return np.minimum(out, depth)


def _first_difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    differs = a.view(np.uint64) != b.view(np.uint64)
    word = np.argmax(differs, 1)
    every = np.arange(len(a))
    found = differs[every, word]
    out = np.full(len(a), a.shape[1], np.int64)
    for i in range(8):  # the byte within the first word that differs
        at = np.flatnonzero(found)
        place = word[at] * 8 + i
        here = a[at, place] != b[at, place]
        out[at[here]] = place[here]
        found[at[here]] = False
    return out


def repeated_starts(contexts: list[bytes], length: int) -> list[np.ndarray]:
    """For each context, which of its first ``len - length + 1`` places start a string of ``length`` bytes that also
    starts at another such place of any context."""
    sizes = np.array([len(c) for c in contexts], np.int64)
    text = np.frombuffer(b"\0".join(contexts) + b"\0", np.uint8)
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    widths = sizes - length + 1
    rises = smaller_than_next(text, ends)
    # from the last start on, the first place that is sorted directly
    marks = np.flatnonzero(rises)
    last = marks[np.searchsorted(marks, starts + widths)]
    member = np.zeros(len(text), bool)
    member[ragged(starts, last - starts + 1)] = True
    eligible = np.zeros(len(text), bool)
    eligible[ragged(starts, widths)] = True
    direct = sort_directly(np.flatnonzero(member & rises), words_at(text, length + 16), length)
    order = induce(text, direct, rises, member)
    order = order[eligible[order]]
    same = common_prefixes(text, order, length) >= length
    twice = same.copy()
    twice[:-1] |= same[1:]
    flags = np.zeros(len(text), bool)
    flags[order[twice]] = True
    return [flags[s:s + w] for s, w in zip(starts.tolist(), widths.tolist())]
