"""Ranked lexical search: the best documents of every item by integer term scores, from trees over documents.

A document is a vector of (term, tf), restricted to the terms of the items. Documents that a task has read are gathered in
blocks; in a block the vectors, in the order of falling document frequency of their terms, share the paths of a trie (an
FP-tree, whose runs of only children are one edge). Each node knows the largest tf that its subtree has of each term, and
the smallest length factor m. The score of a document is growing in tf and falling in m, so both bound a subtree. Each item
walks the trie depth first, best child first, and leaves out what is bounded below its ``k``-th best score; a leaf holds a
few documents, which are scored exactly. The largest tfs are a table of subtrees
x terms, held to ``CELLS`` by larger leaves. A task goes on with the scores of its earlier blocks. What tasks send on are
``k`` documents an item, and a window takes the best of these.

    m = 10 + (90 * n * N) div L,     score = sum over the item's terms of w * ((10^9 * tf) div (1000 * tf + 8 * m))

Terms are known by 64-bit hashes. Items are worked off in blocks (``BLOCK_ITEMS`` items, or so many that their texts stay below
``BLOCK_CHARS``): only a block's terms are sent to tasks. One pass reads the texts for each block of items.

Defined cases: a null or empty text has no terms; a document without terms counts nowhere; items without terms, or that
nothing matches, have no rows; rows of items that share an id are one item with the terms of all (a null id is an id);
repeated documents are documents like others, equal scores rank by id, null ids last; documents with null ids get ranks,
too; empty tables give an empty result; other columns are ignored. Ids of documents are whole numbers.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.common import durable, lean
from llm.terms import ALNUM, runs

BLOCK_ITEMS, BLOCK_CHARS = 2000, 1_000_000
DOCS, POSTINGS = 16_384, 2_000_000  # of a tree
LEAF = 48  # documents below which a subtree is not divided
CELLS = 1 << 26  # largest tfs of a tree (subtrees x terms); a tree with more gets larger leaves
NO_ID = 2**63 - 1


def _item_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        items = batch["item"].to_numpy()
        for first, stop, found in runs(batch["text"].tolist(), ALNUM):
            rows = pd.DataFrame({"item": items[first:stop][found.owner], "term": found.keys.view(np.int64)})
            yield rows.drop_duplicates()


def _vectors(terms: np.ndarray):
    """(id, n, terms, tfs): numbers of the terms in the sorted hashes ``terms``, and how often each occurs."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = batch["id"].to_numpy()
            for first, stop, found in runs(batch["text"].tolist(), ALNUM):
                n = np.bincount(found.owner, minlength=stop - first)
                at = np.minimum(np.searchsorted(terms, found.keys), len(terms) - 1)
                known = terms[at] == found.keys
                codes, tf = np.unique(found.owner[known] * len(terms) + at[known], return_counts=True)
                cuts = np.searchsorted(codes, np.arange(1, stop - first) * len(terms))
                yield pd.DataFrame({"id": ids[first:stop], "n": n, "terms": np.split((codes % len(terms)).astype(np.int32), cuts),
                                    "tfs": np.split(tf.astype(np.int32), cuts)})[n > 0]
    return run


class Tree:
    """Trie over documents in blocks of rows (id, m, terms as ranks of falling frequency, tfs)."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, terms: list[np.ndarray], tfs: list[np.ndarray], width: int) -> None:
        paths = [np.sort(t).astype(">u4").tobytes() for t in terms]
        order = sorted(range(len(ids)), key=paths.__getitem__)
        paths = [paths[i] for i in order]
        self.ids, self.m = ids[order], m[order]
        terms, tfs = [terms[i] for i in order], [tfs[i] for i in order]
        sizes = np.fromiter(map(len, terms), np.int64, len(terms))
        self.start = np.append(0, np.cumsum(sizes))
        self.term, self.tf = np.concatenate(terms).astype(np.int64), np.concatenate(tfs).astype(np.int64)
        self.doc = np.repeat(np.arange(len(terms)), sizes)
        leaf = LEAF
        parents = self._divide(paths, leaf)
        while 1 < len(parents) and len(parents) * width > CELLS:
            leaf *= 2
            parents = self._divide(paths, leaf)
        self._summarise(np.array(parents), width)

    def _divide(self, paths: list[bytes], leaf: int) -> list[int]:
        """Nodes: an interval of documents each, in order of creation, so parents come before children. Returns the parents."""
        self.low, self.high, parents, self.children = [0], [len(paths)], [-1], [[]]
        todo = [(0, 0)]
        while todo:
            node, depth = todo.pop()
            low, high = self.low[node], self.high[node]
            if high - low <= leaf or paths[low] == paths[high - 1]:
                continue
            a, b = paths[low], paths[high - 1]
            while depth < len(a) and a[depth:depth + 4] == b[depth:depth + 4]:  # an edge may hold several terms
                depth += 4
            at = low
            while at < high:
                head = paths[at][:depth + 4]
                end = bisect_right(paths, head, at, high, key=lambda p: p[:depth + 4])
                child = len(self.low)
                self.low.append(at)
                self.high.append(end)
                parents.append(node)
                self.children.append([])
                self.children[node].append(child)
                todo.append((child, depth + 4 if len(head) == depth + 4 else depth))
                at = end
        return parents

    def _summarise(self, parents: np.ndarray, width: int) -> None:
        """Largest tf of each term, smallest m, of each subtree."""
        self.leaf = np.zeros(len(self.ids), np.int64)
        for node, kids in enumerate(self.children):
            if not kids:
                self.leaf[self.low[node]:self.high[node]] = node
        self.top = np.zeros((len(parents), width), np.int32)
        np.maximum.at(self.top, (self.leaf[self.doc], self.term), self.tf.astype(np.int32))
        self.least = np.full(len(parents), np.iinfo(np.int64).max)
        np.minimum.at(self.least, self.leaf, self.m)
        for node in range(len(parents) - 1, 0, -1):
            np.maximum(self.top[parents[node]], self.top[node], out=self.top[parents[node]])
            self.least[parents[node]] = min(self.least[parents[node]], self.least[node])
        self.children = [np.array(c, np.int64) for c in self.children]

    def bound(self, nodes: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        tf = self.top[nodes[:, None], terms].astype(np.int64)
        return (1_000_000_000 * tf // (1000 * tf + 8 * self.least[nodes][:, None])) @ weights

    def best(self, terms: np.ndarray, weights: np.ndarray, place: np.ndarray, k: int, held: tuple[np.ndarray, np.ndarray]):
        """``held`` (scores, ids; best first) with the documents of the tree that belong among the ``k`` best.

        ``place``: number of each term in ``terms``, or -1."""
        scores, ids = held
        root = np.zeros(1, np.int64)
        stack = [(int(self.bound(root, terms, weights)[0]), 0)]
        while stack:
            most, node = stack.pop()
            if most <= 0 or len(scores) == k and most < scores[-1]:
                continue
            if len(kids := self.children[node]):
                bounds = self.bound(kids, terms, weights)
                by = np.argsort(bounds, kind="stable")
                stack += zip(bounds[by].tolist(), kids[by].tolist())
                continue
            low, high = self.low[node], self.high[node]
            a, b = self.start[low], self.start[high]
            at = place[self.term[a:b]]
            hit = np.flatnonzero(at >= 0)
            tf, doc = self.tf[a:b][hit], self.doc[a:b][hit]
            found = np.zeros(high - low, np.int64)
            np.add.at(found, doc - low, weights[at[hit]] * (1_000_000_000 * tf // (1000 * tf + 8 * self.m[doc])))
            good = np.flatnonzero(found >= max(1, scores[-1] if len(scores) == k else 1))
            if len(good):
                scores = np.append(scores, found[good])
                ids = np.append(ids, self.ids[low:high][good])
                by = np.lexsort((ids, -scores))[:k]
                scores, ids = scores[by], ids[by]
        return scores, ids


def _search(items: list[tuple[int, np.ndarray]], rank: np.ndarray, weights: np.ndarray, total: int, length: int, k: int):
    """(item, id, score) of the ``k`` best documents of each item that a task sees. ``items``: ranks of their terms."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        none = np.zeros(0, np.int64)
        best = {item: (none, none) for item, _ in items}

        def search(rows: list[tuple]) -> None:
            ids, n, terms, tfs = zip(*rows)
            m = np.array([10 + (90 * x * total) // length for x in n], np.int64)
            tree = Tree(np.array(ids, np.int64), m, [rank[t] for t in terms], [np.asarray(t) for t in tfs], len(rank))
            place = np.full(len(rank), -1)
            for item, own in items:
                place[own] = np.arange(len(own))
                best[item] = tree.best(own, weights[own], place, k, best[item])
                place[own] = -1

        held, size = [], 0
        for batch in batches:
            for row in batch[["id", "n", "terms", "tfs"]].itertuples(index=False, name=None):
                held.append(row)
                size += len(row[2])
                if len(held) == DOCS or size >= POSTINGS:
                    search(held)
                    held, size = [], 0
        if held:
            search(held)
        out = [(item, i, s) for item, (scores, ids) in best.items() for i, s in zip(ids.tolist(), scores.tolist())]
        yield pd.DataFrame(out, columns=["item", "id", "score"])
    return run


def _block(docs: DataFrame, items: DataFrame, k: int) -> DataFrame | None:
    """(item, id, score, rank) of one block of items (item, text)."""
    found = items.mapInPandas(lean(_item_terms), "item string, term long").distinct().collect()  # of a block, so bounded
    if not found:
        return None
    own: dict = {}
    for r in found:
        own.setdefault(r["item"], []).append(r["term"])
    names = sorted(own, key=lambda x: (x is None, x))
    terms = np.unique(np.array([r["term"] for r in found], np.int64).view(np.uint64))
    vectors = durable(docs.mapInPandas(lean(_vectors(terms)), "id long, n long, terms array<int>, tfs array<int>"), "vectors")
    total, length = vectors.agg(F.count("*"), F.sum("n")).first()
    if not total:
        return None
    counts = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()
    df = np.zeros(len(terms), np.int64)
    for r in counts:
        df[r["term"]] = r["df"]
    by = np.argsort(-df, kind="stable")
    rank = np.empty(len(terms), np.int64)
    rank[by] = np.arange(len(terms))
    weights = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * f + 1))) for f in df[by].tolist()], np.int64)
    ranks = [(i, rank[np.searchsorted(terms, np.array(own[x], np.int64).view(np.uint64))]) for i, x in enumerate(names)]
    hits = vectors.filter("size(terms) > 0").mapInPandas(
        lean(_search(ranks, rank, weights, total, length, k)), "item int, id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc("id"))
    ranked = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    listed = docs.sparkSession.createDataFrame(list(enumerate(names)), "item int, name string")
    return ranked.join(F.broadcast(listed), "item").select("name", "rank", F.when(F.col("id") != NO_ID, F.col("id")).alias("id"), "score")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item id, rank, id, score): the ``k`` best documents of each item, scores above 0 only."""
    texts = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text_col).cast("string").alias("text"))
    texts = texts.filter("text != ''")
    asked = items.select(F.col(item_id).cast("string").alias("item"), F.coalesce(F.col(item_text).cast("string"), F.lit("")).alias("text"))
    rows, chars = asked.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    blocks = max(1, -(-rows // BLOCK_ITEMS), -(-chars // BLOCK_CHARS))
    result = None
    for b in range(blocks):
        part = _block(texts, asked.filter(F.pmod(F.xxhash64(F.coalesce("item", F.lit(""))), F.lit(blocks)) == b), k)
        if part is not None:
            result = part if result is None else result.unionByName(part)
    if result is None:
        result = docs.sparkSession.createDataFrame([], "name string, rank int, id long, score long")
    return result.select(F.col("name").cast(items.schema[item_id].dataType).alias(item_id), "rank",
                         F.col("id").alias(id_col), "score")
