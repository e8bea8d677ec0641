"""Quality rules: statistics of whole texts, hard limits on them, and an isolation forest over their ratios.

One pass over the documents gives the statistics (hash sums of words and lines in arrays, nothing is cut off). An
isolation forest is grown on documents that pass the hard limits, each tree on its own ``PSI`` of all of them (the lowest
hashes of id, statistics and tree): trees split a random ratio at a random value, and documents that end on short paths are odd. The
oddness at which a document is dropped comes from a histogram (``BINS``) of all labelled rows: the limit between clean and bad ones with the best
balance that still keeps ``KEEP`` of the clean ones. Without labels of both kinds nothing is dropped by the forest.

Signs are all code points but letters, digits, white space and combining marks; capitals are those of all scripts.

Defined cases: a null or empty text has no words and fails the limits; null ids and repeated rows are counted like any
row; labels with null values are ignored, and a document with several labels takes the worst; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import durable, lean, slices
from llm.segments import code_points, segment_keys

CHARS = 600_000
TREES, PSI = 200, 128  # trees, documents per tree
BINS = 1 << 16  # of oddness
KEEP = 0.995
SYMBOLS = "#*$%&|<>"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_upper", "n_signs", "n_lines", "n_distinct"]


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = a * np.uint64(0x9E3779B97F4A7C15) + b
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(28)
    return out


def _per_text(owner: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner, minlength=n).astype(np.int64)


def statistics(texts: list[str]) -> dict[str, np.ndarray]:
    parts = [_statistics(texts[a:b]) for a, b in slices(np.fromiter(map(len, texts), np.int64, len(texts)), CHARS)]
    return {k: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in BASE + MORE}


def _statistics(texts: list[str]) -> dict[str, np.ndarray]:
    n = len(texts)
    out = dict.fromkeys(BASE + MORE, np.zeros(n, np.int64))
    flat, starts = code_points(texts)
    size = len(flat)
    if not size:
        return out
    text_of = np.repeat(np.arange(n), np.diff(np.append(starts, size)))
    space = (flat == 0x20) | ((flat >= 9) & (flat <= 13))
    first = np.zeros(size, bool)
    first[starts[starts < size]] = True
    out["word_chars"] = _per_text(text_of[~space], n)
    out["n_symbols"] = _per_text(text_of[np.isin(flat, [ord(c) for c in SYMBOLS])], n)
    out["n_upper"], out["n_signs"] = (_per_text(text_of[t[flat]], n) for t in _signs())

    cut = first.copy()
    cut[1:] |= space[1:] != space[:-1]
    cuts = np.flatnonzero(cut)
    is_word = ~space[cuts]
    keys = segment_keys(flat, cuts)[is_word]
    owner = text_of[cuts[is_word]]
    out["n_words"] = _per_text(owner, n)
    mine = _mix(keys, owner.astype(np.uint64))
    _, at = np.unique(mine, return_index=True)
    out["n_distinct"] = _per_text(owner[at], n)
    repeated = np.zeros(len(keys), bool)
    if len(keys) > 2:
        window = _mix(_mix(mine[:-2], keys[1:-1]), keys[2:])
        inside = owner[:-2] == owner[2:]
        place = np.flatnonzero(inside)
        _, back, times = np.unique(window[inside], return_inverse=True, return_counts=True)
        twice = place[times[back] > 1]
        for k in range(3):
            repeated[twice + k] = True
    out["n_repeat_words"] = _per_text(owner[repeated], n)

    newline = flat == 10
    cut = first | newline
    cut[1:] |= newline[:-1]
    cuts = np.flatnonzero(cut)
    has_word = np.add.reduceat((~space).astype(np.int64), cuts) > 0
    line_owner = text_of[cuts[has_word]]
    out["n_lines"] = _per_text(line_owner, n)
    _, at = np.unique(_mix(segment_keys(flat, cuts)[has_word], line_owner.astype(np.uint64)), return_index=True)
    out["n_dup_lines"] = out["n_lines"] - _per_text(line_owner[at], n)
    return out


@cache
def _signs() -> tuple[np.ndarray, np.ndarray]:
    """Whether each code point is a capital, and whether it is a sign."""
    every = [chr(c) for c in range(0x110000)]
    return (np.array([c.isupper() for c in every]),
            np.array([not (c.isalnum() or c.isspace() or unicodedata.category(c)[0] == "M") for c in every]))


def ratios(s: pd.DataFrame) -> np.ndarray:
    """The features of the forest; sizes of documents do not enter."""
    words, chars = np.maximum(s["n_words"], 1), np.maximum(s["word_chars"], 1)
    return np.stack([s["word_chars"] / words, s["n_symbols"] / words, s["n_signs"] / chars, s["n_upper"] / chars,
                     s["n_repeat_words"] / words,
                     np.log1p(s["n_distinct"]) / np.log1p(s["n_words"])], 1).astype(np.float64)


class IsolationForest:
    """Trees as flat arrays: feature (-1 for a leaf), split, left child (the right one follows), path length at a leaf."""

    def __init__(self, rows: np.ndarray | list[np.ndarray], trees: int = TREES, psi: int = PSI, seed: int = 1) -> None:
        """``rows``: a table that each tree draws from, or a list of the rows of each tree."""
        random = np.random.default_rng(seed)
        if isinstance(rows, np.ndarray):
            psi = min(psi, len(rows))
            rows = [rows[random.choice(len(rows), psi, replace=False)] for _ in range(trees)]
        psi = max(map(len, rows))
        limit = int(np.ceil(np.log2(max(psi, 2)))) + 4
        self.norm = max(_average_path(psi), 1e-9)
        self.trees = [self._grow(part, limit, random) for part in rows]

    @staticmethod
    def _grow(rows: np.ndarray, limit: int, random: np.random.Generator) -> tuple[np.ndarray, ...]:
        feature, split, child, path = [-1], [0.0], [0], [0.0]
        queue = [(0, rows, 0)]
        while queue:
            node, part, depth = queue.pop()
            low, high = part.min(0), part.max(0)
            open_ = np.flatnonzero(high > low)
            if depth >= limit or len(part) <= 1 or not len(open_):
                path[node] = depth + _average_path(len(part))
                continue
            f = int(random.choice(open_))
            at = random.uniform(low[f], high[f])
            left = part[:, f] <= at
            feature[node], split[node], child[node] = f, at, len(feature)
            for side in (part[left], part[~left]):
                queue.append((len(feature), side, depth + 1))
                feature.append(-1), split.append(0.0), child.append(0), path.append(0.0)
        return np.array(feature), np.array(split), np.array(child), np.array(path)

    def oddness(self, rows: np.ndarray) -> np.ndarray:
        """2 ** -(mean path / expected path): near 1 for odd rows, below 0.5 for usual ones."""
        total, every = np.zeros(len(rows)), np.arange(len(rows))
        for feature, split, child, path in self.trees:
            node = np.zeros(len(rows), np.int64)
            while True:
                f = feature[node]
                inner = f >= 0
                if not inner.any():
                    break
                right = rows[every, np.maximum(f, 0)] > split[node]
                node = np.where(inner, child[node] + right, node)
            total += path[node]
        return 2.0 ** (-total / (len(self.trees) * self.norm))


def _average_path(n: int) -> float:
    """Mean depth of an unsuccessful search in a random binary tree of n rows."""
    if n <= 1:
        return 0.0
    return 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else 1.0


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], **statistics(batch["text"].tolist())})

    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    schema = "id string, " + ", ".join(f"{c} long" for c in BASE + MORE)
    return rows.mapInPandas(lean(run), schema).withColumn("id", F.col("id").cast(docs.schema[id_col].dataType)).withColumn(
        "base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def tree_samples(passed: DataFrame, trees: int = TREES, psi: int = PSI) -> list[np.ndarray]:
    """For each tree its ``psi`` rows of all of ``passed``, as ratios."""
    total = passed.count()
    if not total:
        return []
    # so many rows of a tree are below the cut that fewer than psi never happen; the driver gets about as many a tree
    share = min(1.0, 4 * psi / total)
    keys = F.array(*(F.xxhash64(F.lit(t), F.col("id").cast("string"), *BASE, *MORE) for t in range(trees)))
    rows = passed.select(*BASE, *MORE, F.posexplode(keys).alias("tree", "key"))
    if share < 1:
        rows = rows.filter(F.col("key") < int(share * 2.0**64) - 2**63)
    # equal rows have equal keys; they travel as one
    rows = rows.groupBy("tree", "key", *BASE, *MORE).agg(F.least(F.count("*"), F.lit(psi)).alias("times"))
    rows = rows.toPandas().sort_values(["tree", "key", *BASE, *MORE])
    samples = []
    for _, part in rows.groupby("tree"):
        samples.append(ratios(part.loc[part.index.repeat(part["times"])][:psi]))
    return samples


def threshold(clean: np.ndarray, bad: np.ndarray, keep: float = KEEP, n_clean: np.ndarray | None = None,
              n_bad: np.ndarray | None = None) -> float:
    """The largest oddness that is kept: best balance of kept clean and dropped bad rows, with ``keep`` of the clean kept.
    ``n_clean``, ``n_bad``: how many rows each value stands for."""
    if not len(clean) or not len(bad):
        return 2.0

    def up_to(values: np.ndarray, times: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        by = np.argsort(values)
        return values[by], np.append(0, np.cumsum(np.ones(len(values), np.int64) if times is None else times[by]))

    (clean, clean_rows), (bad, bad_rows) = up_to(clean, n_clean), up_to(bad, n_bad)
    floor = clean[np.searchsorted(clean_rows, np.ceil(keep * (clean_rows[-1] - 1)), "right") - 1]
    places = np.unique(np.append(bad[bad > floor], [floor, 2.0]))
    limits = np.append(floor, (places[1:] + places[:-1]) / 2)
    gain = (clean_rows[np.searchsorted(clean, limits, "right")] / clean_rows[-1]
            - bad_rows[np.searchsorted(bad, limits, "right")] / bad_rows[-1])
    return float(limits[np.flatnonzero(gain >= gain.max() - 1e-12)[0]])


def quality_rules(docs: DataFrame, labels: DataFrame | None, id_col: str = "doc_id", text_col: str = "text",
                  label_id: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """(id, base and further statistics, base_failed, oddness, limit, kept), one row per row of ``docs``."""
    stats = durable(document_statistics(docs, id_col, text_col), "rules")
    passed = stats.filter(~F.col("base_failed"))
    # TREES x PSI rows (and as many more as the cut lets through) and 2 x BINS counts come to the driver
    samples = tree_samples(passed)
    forest, limit = None, 2.0
    if samples and len(samples[0]) > 1:
        forest = IsolationForest(samples)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["oddness"] = forest.oddness(ratios(batch)) if forest is not None and len(batch) else 0.0
            yield batch

    scored = stats.withColumn("id", F.col("id").cast("string")).mapInPandas(
        lean(run), f"id string, {', '.join(f'{c} long' for c in BASE + MORE)}, base_failed boolean, oddness double")
    scored = scored.withColumn("id", F.col("id").cast(docs.schema[id_col].dataType))
    if forest is not None and labels is not None:
        scored = durable(scored, "scored")
        marks = labels.select(F.col(label_id).alias("id"), F.col(label_col).cast("int").alias("label")).dropna()
        marks = marks.groupBy("id").agg(F.min("label").alias("label")).filter("label in (0, 1)")
        bins = scored.filter(~F.col("base_failed")).join(marks, "id").groupBy(
            "label", F.ceil(F.col("oddness") * BINS).alias("bin")).agg(F.count("*").alias("times")).toPandas()
        clean, bad = (bins[bins["label"] == v] for v in (1, 0))
        limit = threshold(clean["bin"].to_numpy() / BINS, bad["bin"].to_numpy() / BINS, KEEP, clean["times"].to_numpy(), bad["times"].to_numpy())
        limit = float(np.floor(limit * BINS) / BINS)  # the upper end of a bin
    return scored.select(F.col("id").alias(id_col), *BASE, *MORE, "base_failed",
                         (~F.col("base_failed") & (F.col("oddness") <= limit)).alias("kept"),
                         "oddness", F.lit(limit).alias("oddness_limit"))
