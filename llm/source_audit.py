"""Source divergence audit: how far the word frequencies of sources lie apart, within each language.

Frequencies come from single-pass in-memory indexing. A task adds the postings of its texts, (language, term) with the
documents that hold it and (language, term, source) with the occurrences, to a block in memory; when the block is full, it is
written as a run, sorted by term and cut by hash shard into short slices. The task of a shard reads slices in the order of
their first terms and merges them with a heap, which only holds slices that overlap. Terms in at least ``least`` documents
of their language stay, with their sources' counts.

All values are whole numbers, p = 1 + floor(10^9 * (count + 5) / (N + 5 * V)), from decimals, so that nothing overflows or is
rounded. Sources of a language are held against each other without a row for terms that they lack: with p0 for count 0,

    sum |p_A - p_B| = sum over A's terms |p_A - p0_B| + sum over B's terms |p_B - p0_A| + (V - |A| - |B|) |p0_A - p0_B|
                      + sum over common terms (|p_A - p_B| - |p_A - p0_B| - |p_B - p0_A| + |p0_A - p0_B|)

The first two sums need only how often each count occurs in a source. The last one is streamed: tasks read the frequencies
once, add up corrections in memory by pair of sources, and send on one row a pair. Pairs of sources are the result itself;
languages are taken in blocks of about ``BLOCK_GROUPS`` / 2 sources, whose N and V are what tasks get.

Defined cases: null text, language or source are empty ones; a group without terms has p0 everywhere; a language without kept
terms has pairs of value 0; repeated rows are documents like others; an empty table gives an empty result; other columns are
ignored. A term is known by its text, documents' terms within a text by 64-bit hashes.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import durable, lean
from llm.terms import LETTERS, runs, summed

MEMORY = 2_000_000  # postings of a block in memory
SLICE = 256  # terms of a slice of a run
BLOCK_GROUPS = 50_000
BROADCAST_ROWS = 100_000  # N and V of so many groups are copied to all tasks, others are joined
PAIRS = 2_000_000  # corrections held before they are sent on
RUN = "shard int, lang string, first string, terms array<string>, dfs array<long>, sizes array<int>, names array<string>, sources array<int>, counts array<long>"
UNIT, PRIOR = 1_000_000_000, 5


# ---------------------------------------------------------------- runs

class _Block:
    """Postings in memory."""

    def __init__(self) -> None:
        self.langs: dict[str, int] = {}
        self.groups: dict[tuple[int, str], int] = {}
        self.dfs, self.counts, self.words, self.size = defaultdict(list), defaultdict(list), {}, 0

    def add(self, texts: list[str], langs: list[str], sources: list[str]) -> None:
        own = np.array([self.langs.setdefault(x, len(self.langs)) for x in langs])
        groups = np.array([self.groups.setdefault((a, s), len(self.groups)) for a, s in zip(own.tolist(), sources)])
        for first, stop, found in runs(texts, LETTERS):
            if not len(found.keys):
                continue
            keys, at, back = np.unique(found.keys, return_index=True, return_inverse=True)
            new = np.array([k not in self.words for k in keys.tolist()])
            self.words.update(zip(keys[new].tolist(), found.texts(at[new])))
            once = np.unique(found.owner * len(keys) + back)
            lang, group = own[first:stop], groups[first:stop]
            self._gather(self.dfs, keys, lang[once // len(keys)] * len(keys) + once % len(keys))
            self._gather(self.counts, keys, group[found.owner] * len(keys) + back)

    def _gather(self, into: dict, keys: np.ndarray, codes: np.ndarray) -> None:
        """Adds 1 for each code, which stands for (number, key)."""
        codes, n = np.unique(codes, return_counts=True)
        number = codes // len(keys)
        for a, b in zip(starts := np.flatnonzero(np.diff(number, prepend=-1)), [*starts[1:], len(codes)]):
            into[int(number[a])].append((keys[codes[a:b] % len(keys)], n[a:b]))
        self.size += len(codes)

    def merge(self) -> None:
        for into in (self.dfs, self.counts):
            for number, parts in into.items():
                into[number] = [summed(np.concatenate([k for k, _ in parts]), np.concatenate([n for _, n in parts]))]
        self.size = sum(len(parts[0][0]) for into in (self.dfs, self.counts) for parts in into.values())

    def spill(self, shards: int) -> pd.DataFrame:
        """Term-sorted slices by shard."""
        self.merge()
        by_lang = defaultdict(list)
        for (lang, source), group in self.groups.items():
            by_lang[lang].append((source, group))
        out = []
        for name, lang in self.langs.items():
            if lang not in self.dfs:
                continue
            keys, dfs = self.dfs[lang][0]
            held = [(source, *self.counts[group][0]) for source, group in by_lang[lang] if group in self.counts]
            names = [source for source, _, _ in held]
            at = np.concatenate([np.searchsorted(keys, k) for _, k, _ in held])
            source = np.repeat(np.arange(len(held)), [len(k) for _, k, _ in held])
            counts = np.concatenate([n for _, _, n in held])
            by = np.argsort(at, kind="stable")
            source, counts, begin = source[by], counts[by], np.searchsorted(at[by], np.arange(len(keys) + 1))
            words = [self.words[k] for k in keys.tolist()]
            shard = (keys % np.uint64(shards)).astype(np.int64)
            order = sorted(range(len(keys)), key=words.__getitem__)
            order = np.array(order)[np.argsort(shard[order], kind="stable")]
            cuts = np.searchsorted(shard[order], np.arange(shards + 1))
            for s in np.flatnonzero(np.diff(cuts)).tolist():
                for low in range(cuts[s], cuts[s + 1], SLICE):
                    part = order[low:min(low + SLICE, cuts[s + 1])]
                    entries = np.concatenate([np.arange(begin[i], begin[i + 1]) for i in part])
                    used, local = np.unique(source[entries], return_inverse=True)
                    out.append((s, name, words[part[0]], [words[i] for i in part], dfs[part], begin[part + 1] - begin[part],
                                [names[i] for i in used], local, counts[entries]))
        self.__init__()
        return pd.DataFrame(out, columns=[c.split()[0] for c in RUN.split(", ")])


def _index(shards: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = _Block()
        for batch in batches:
            for low in range(0, len(batch), 256):
                part = batch.iloc[low:low + 256]
                block.add(part["text"].tolist(), part["lang"].tolist(), part["source"].tolist())
                if block.size > MEMORY:
                    block.merge()
                    if block.size > MEMORY // 2:
                        yield block.spill(shards)
        if block.size:
            yield block.spill(shards)
    return run


# ---------------------------------------------------------------- merge

def _entries(row) -> Iterator[tuple]:
    """(lang, term, df, {source: count}) of a slice."""
    ends, names = np.cumsum(row.sizes), list(row.names)
    for i, term in enumerate(row.terms):
        a, b = ends[i] - row.sizes[i], ends[i]
        yield row.lang, term, int(row.dfs[i]), [(names[s], int(n)) for s, n in zip(row.sources[a:b], row.counts[a:b])]


def merged(rows: Iterator, least: int) -> Iterator[tuple]:
    """(lang, term, total, sources, counts) of the terms in ``least`` documents, from the slices of whole shards in the order of
    (shard, lang, first)."""
    heap: list[tuple] = []
    state: list = [None, 0, {}]

    def take() -> tuple | None:
        """The next entry of the heap goes into the term at hand; returns the one before, if that's another that stays."""
        lang, term, number, df, found, rest = heap[0]
        done = None
        if state[0] != (lang, term):
            done = finished()
            state[:] = [(lang, term), 0, {}]
        state[1] += df
        for source, n in found:
            state[2][source] = state[2].get(source, 0) + n
        following = next(rest, None)
        if following is None:
            heapq.heappop(heap)
        else:
            heapq.heapreplace(heap, (*following[:2], number, *following[2:], rest))
        return done

    def finished() -> tuple | None:
        key, df, found = state
        if key is None or df < least:
            return None
        names = sorted(found)
        return *key, sum(found.values()), names, [found[x] for x in names]

    shard = None
    for number, row in enumerate(rows):
        # what lies before the slice's first term is complete
        while heap and (row.shard != shard or heap[0][:2] < (row.lang, row.first)):
            if (done := take()) is not None:
                yield done
        shard = row.shard
        rest = _entries(row)
        lang, term, df, found = next(rest)
        heapq.heappush(heap, (lang, term, number, df, found, rest))
    while heap:
        if (done := take()) is not None:
            yield done
    if (done := finished()) is not None:
        yield done


def _merge(least: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = []
        for row in merged((row for batch in batches for row in batch.itertuples(index=False)), least):
            out.append(row)
            if len(out) == 5000:
                yield pd.DataFrame(out, columns=["lang", "term", "total", "sources", "counts"])
                out = []
        yield pd.DataFrame(out, columns=["lang", "term", "total", "sources", "counts"])
    return run


def frequencies(docs: DataFrame, least: int) -> DataFrame:
    """(lang, term, total, sources, counts) of the terms in at least ``least`` documents (lang, source, text) of their language."""
    shards = max(64, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    slices = docs.mapInPandas(lean(_index(shards)), RUN)
    slices = slices.repartition("shard").sortWithinPartitions("shard", "lang", "first")
    return durable(slices.mapInPandas(lean(_merge(least)), "lang string, term string, total long, sources array<string>, counts array<long>"), "frequencies")


# ---------------------------------------------------------------- values

def _p(count: Column, n: str, v: str) -> Column:
    exact = [c.cast("decimal(20,0)") for c in (count, F.col(n), F.col(v))]
    return F.call_function("div", (exact[0] + PRIOR) * UNIT, exact[1] + PRIOR * exact[2]) + 1


def _corrections(stats: dict[str, dict[str, tuple[int, int]]]):
    """(lang, a, b, value): sums over common terms of a task, a < b. ``stats``: N and V of each group."""
    def flush(held: list) -> pd.DataFrame:
        codes, values = summed(np.concatenate([c for c, _ in held]), np.concatenate([v for _, v in held]))
        lang, a, b = codes // width // width, codes // width % width, codes % width
        return pd.DataFrame({"lang": [langs[i] for i in lang], "a": [names[langs[x]][i] for x, i in zip(lang, a)],
                             "b": [names[langs[x]][i] for x, i in zip(lang, b)], "value": values})

    langs = sorted(stats)
    names = {x: sorted(own) for x, own in stats.items()}
    width = max([1, *map(len, names.values())])
    place = {x: {s: i for i, s in enumerate(own)} for x, own in names.items()}

    def p(count: np.ndarray, n: np.ndarray, v: int) -> np.ndarray:
        small = int(count.max(initial=0)) < 2**32  # 10^9 * (count + 5) fits
        over = UNIT * (count if small else count.astype(object)) + UNIT * PRIOR
        return (over // (n + PRIOR * v) + 1).astype(np.int64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            for lang, rows in batch.groupby("lang", sort=False):
                if lang not in stats:
                    continue
                sizes = rows["sources"].map(len).to_numpy()
                term = np.repeat(np.arange(len(rows)), sizes)
                source = np.array([place[lang][s] for own in rows["sources"] for s in own])
                count = np.concatenate(rows["counts"].to_list()).astype(np.int64)
                n = np.array([stats[lang][s][0] for s in names[lang]], np.int64)
                v = next(iter(stats[lang].values()))[1]
                own, none = p(count, n[source], v), p(np.zeros(len(n), np.int64), n, v)
                for step in range(1, int(sizes.max())):
                    a = np.flatnonzero(term[:-step] == term[step:])
                    b = a + step
                    pa, pb, a0, b0 = own[a], own[b], none[source[a]], none[source[b]]
                    value = np.abs(pa - pb) - np.abs(pa - b0) - np.abs(pb - a0) + np.abs(a0 - b0)
                    held.append(summed((langs.index(lang) * width + source[a]) * width + source[b], value))
                    size += len(held[-1][0])
                    if size > PAIRS:
                        yield flush(held)
                        held, size = [], 0
        if held:
            yield flush(held)
    return run


def _hint(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _pairs(found: DataFrame, groups: DataFrame, several: DataFrame) -> DataFrame:
    """(lang, source, item, value) of the sources of each language; ``groups`` (lang, source, n, v), ``several`` its languages in blocks."""
    n_groups = groups.count()
    counts = found.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("x")).select("lang", F.col("x.sources").alias("source"), F.col("x.counts").alias("c"))
    often = counts.groupBy("lang", "source", "c").agg(F.count("*").alias("times"))
    often = often.join(_hint(groups, n_groups), ["lang", "source"]).select("lang", "source", "times", _p(F.col("c"), "n", "v").alias("p"))
    often = often.groupBy("lang", "source").agg(F.collect_list(F.struct("p", "times")).alias("own"), F.sum("times").alias("kept"))
    full = groups.join(often, ["lang", "source"], "left").select(
        "lang", "source", "v", F.coalesce("own", F.expr("array()").cast("array<struct<p:bigint,times:bigint>>")).alias("own"),
        F.coalesce("kept", F.lit(0)).alias("kept"), F.when(F.col("v") > 0, _p(F.lit(0), "n", "v")).otherwise(0).alias("p0"))
    full = durable(full, "groups")
    corrections = found.sparkSession.createDataFrame([], "lang string, a string, b string, value long")
    for (block,) in several.select("block").distinct().collect():
        own: dict = defaultdict(dict)
        for r in groups.join(F.broadcast(several.filter(F.col("block") == block)), "lang").select("lang", "source", "n", "v").collect():
            own[r["lang"]][r["source"]] = (r["n"], r["v"])
        corrections = corrections.unionByName(found.filter("size(sources) > 1").select("lang", "sources", "counts").mapInPandas(
            lean(_corrections(dict(own))), "lang string, a string, b string, value long"))
    corrections = corrections.groupBy("lang", "a", "b").agg(F.sum("value").alias("common"))
    x, y = full.alias("x"), full.alias("y")
    far = lambda one, other: F.aggregate(f"{one}.own", F.lit(0).cast("long"), lambda s, e: s + e["times"] * F.abs(e["p"] - F.col(f"{other}.p0")))
    both = x.join(y, F.expr("x.lang = y.lang AND x.source < y.source")).select(
        F.col("x.lang").alias("lang"), F.col("x.source").alias("a"), F.col("y.source").alias("b"),
        (far("x", "y") + far("y", "x") + F.expr("(x.v - x.kept - y.kept) * abs(x.p0 - y.p0)")).alias("apart"))
    both = both.join(corrections, ["lang", "a", "b"], "left").select(
        "lang", "a", "b", (F.col("apart") + F.coalesce("common", F.lit(0))).alias("value"))
    return both.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                                                 F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("x"), "value").select("lang", "x.*", "value")


def divergence(docs: DataFrame, least: int = 30, top: int = 50, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank): part 'pair' with the distance to each other source of the language, part 'term' with
    the ``top`` terms that a source has more of than its language."""
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    found = frequencies(rows, least)
    langs = durable(found.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("all")), "langs")
    counts = found.select("lang", "term", "total", F.explode(F.arrays_zip("sources", "counts")).alias("x")).select(
        "lang", F.col("x.sources").alias("source"), "term", "total", F.col("x.counts").alias("c"))
    sums = counts.groupBy("lang", "source").agg(F.sum("c").alias("n"))
    groups = rows.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("all", F.lit(0)).alias("all"))
    groups = durable(groups, "groups")

    sizes = groups.groupBy("lang").agg(F.count("*").alias("sources"))
    n_groups = groups.count()
    blocks = max(1, -(-2 * n_groups // BLOCK_GROUPS))
    several = durable(sizes.select("lang", F.pmod(F.xxhash64("lang"), F.lit(blocks)).alias("block")), "languages")
    pair = _pairs(found, groups.drop("all"), several).withColumn("part", F.lit("pair"))

    term = counts.join(_hint(groups, n_groups), ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"), (_p(F.col("c"), "n", "v") - _p(F.col("total"), "all", "v")).alias("value"))
    term = term.filter("value > 0").withColumn("part", F.lit("term"))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pair = pair.withColumn("rank", F.row_number().over(order)).select(columns)
    term = term.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select(columns)
    return pair.unionByName(term)
