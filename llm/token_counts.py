"""Token counts of whole texts under a SentencePiece BPE vocabulary.

Texts become code point arrays and fall into pre-tokens (a run of spaces with the word after it; no piece of the
vocabulary crosses such a cut, which is checked when it is loaded). Each distinct pre-token is counted once a worker:
all of a batch are held as one ragged array of symbols, every round applies to each sequence its pair of the best rank
(the leftmost of equal ones), and the symbols that survive are the tokens. A sign outside the vocabulary counts as its
UTF-8 bytes.

Defined cases: a null or empty text has 0 bytes and 0 tokens; null ids and repeated rows are counted like any row;
other columns of the input are ignored. Sequences of over ``LONG`` symbols take the same merges from a heap, since one
merge a round would take them time in the square of their length.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import lean, ragged, slices
from llm.segments import SegmentCache, code_points

CHARS = 600_000  # code points handled at once
LONG = 400
MARK = "▁"


class MergeCounter:
    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        special = {i for i in range(model.vocab_size()) if model.is_control(i) or model.is_byte(i) or model.is_unknown(i)}
        score = {model.id_to_piece(i): model.get_score(i) for i in range(model.vocab_size()) if i not in special}
        if any(a != MARK and b == MARK for piece in score for a, b in zip(piece, piece[1:])):
            raise ValueError("a piece crosses a word start; pre-tokens would not be independent")
        if model.normalize(" a  b\tC") != MARK * 2 + "a" + MARK * 2 + "b\tC":
            raise ValueError("only vocabularies that keep their texts as they are")
        symbols = dict.fromkeys([*score, *(c for piece in score for c in piece)])
        self.number = {s: i for i, s in enumerate(symbols)}
        self.size = len(self.number) + 4  # the last four: unknown signs of one to four bytes
        order = {s: r for r, s in enumerate(sorted({*score.values()}, reverse=True))}
        pairs = {}
        for piece, value in score.items():
            for k in range(1, len(piece)):
                left, right = self.number.get(piece[:k]), self.number.get(piece[k:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = (order[value], self.number[piece])
        self.keys = np.array(sorted(pairs), np.int64)
        self.rank = np.array([pairs[k][0] for k in self.keys.tolist()], np.int64)
        self.made = np.array([pairs[k][1] for k in self.keys.tolist()], np.int64)
        self.pairs = pairs
        self.tokens = np.array([1 if s in score else len(s.encode()) for s in symbols] + [1, 2, 3, 4], np.int64)
        self.neighbours = {a + b for piece in score for a, b in zip(piece, piece[1:])}
        self.cache = SegmentCache(self._compute)

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        out = np.zeros(len(texts), np.int64)
        for a, b in slices(np.fromiter(map(len, texts), np.int64, len(texts)), CHARS):
            flat, starts = code_points([MARK + t.replace(" ", MARK) if t else "" for t in texts[a:b]])
            if len(flat):
                mark = flat == ord(MARK)
                cut = np.append(True, mark[1:] & ~mark[:-1])
                cut[starts[starts < len(flat)]] = True
                cuts = np.flatnonzero(cut)
                at, _ = self.cache.look_up(flat, cuts)
                before = np.append(0, np.cumsum(self.cache.values[at], dtype=np.int64))
                out[a:b] = np.diff(before[np.searchsorted(cuts, np.append(starts, len(flat)))])
        return out

    def _symbols(self, text: str) -> list[int]:
        return [self.number.get(c) if c in self.number else self.size - 5 + len(c.encode("utf-8", "surrogatepass")) for c in text]

    def _compute(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """One count a word. No merge joins two signs that are nowhere neighbours in a piece: words fall apart there."""
        parts, owner = [], []
        for i, word in enumerate(words):
            start = 0
            for k in range(1, len(word)):
                if word[k - 1:k + 1] not in self.neighbours:
                    parts.append(word[start:k])
                    owner.append(i)
                    start = k
            parts.append(word[start:])
            owner.append(i)
        counts = np.zeros(len(parts), np.int64)
        short = [i for i, p in enumerate(parts) if len(p) <= LONG]
        if short:
            sequences = [self._symbols(parts[i]) for i in short]
            counts[short] = self._merge(np.array([s for q in sequences for s in q], np.int64),
                                        np.array([len(q) for q in sequences], np.int64))
        for i, p in enumerate(parts):
            if len(p) > LONG:
                counts[i] = self._merge_long(self._symbols(p))
        return np.bincount(owner, counts, len(words)).astype(np.int64), np.ones(len(words), np.int64)

    def _merge(self, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """All sequences side by side; each round merges one pair of every sequence that has one."""
        done = np.zeros(len(lengths), np.int64)
        who = np.arange(len(lengths))
        none = np.int64(2**62)
        while len(who):
            starts = np.cumsum(lengths) - lengths
            key = symbols[:-1] * self.size + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            fits = self.keys[at] == key
            fits[starts[1:] - 1] = False  # not over the end of a sequence
            # the rank first, then the place: the smallest value is the leftmost pair of the best rank
            value = np.append(np.where(fits, self.rank[at] * len(symbols) + np.arange(len(key)), none), none)
            best = np.minimum.reduceat(value, starts)
            open_ = best < none
            if not open_.all():
                ended = ~open_
                kept = np.repeat(ended, lengths)
                done[who[ended]] = np.add.reduceat(np.where(kept, self.tokens[symbols], 0), starts)[ended]
            place = best[open_] % len(symbols)
            symbols = symbols.copy()
            symbols[place] = self.made[at[place]]
            stays = np.repeat(open_, lengths)
            stays[place + 1] = False
            symbols, who, lengths = symbols[stays], who[open_], lengths[open_] - 1
        return done

    def _merge_long(self, symbols: list[int]) -> int:
        after = [*range(1, len(symbols)), -1]
        before = [*range(-1, len(symbols) - 1)]
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (found := self.pairs.get(symbols[i] * self.size + symbols[j])):
                heapq.heappush(heap, (found[0], i, symbols[i], symbols[j]))

        for i in range(len(symbols)):
            offer(i)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != left or j < 0 or symbols[j] != right:
                continue
            symbols[i] = self.pairs[left * self.size + right][1]
            symbols[j] = -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return int(sum(self.tokens[s] for s in symbols if s >= 0))


@cache
def counter(path: str) -> MergeCounter:
    """One counter a worker."""
    return MergeCounter(path)


def token_counts(docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row; one pass over the table, no shuffle."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "n_bytes": batch["n_bytes"],
                                "n_tokens": counter(path).counts(batch["text"].tolist())})

    rows = docs.select(F.col(id_col).alias("id"), F.octet_length(F.coalesce(text_col, F.lit(""))).cast("long").alias("n_bytes"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    counted = rows.mapInPandas(lean(count), f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
