"""Similarity join of word shingle sets by Jaccard similarity, with adaptive multi-match prefixes, and its components.

Two sets of similarity t or more share at least ``need`` = ceil(t * size) shingles of either one. Under any order of
shingles, the first ``size - need + l`` of both hold at least l common ones. That is used twice:

1. Sieve. Under the order of hashes, each text keeps a prefix with l = size / 25 (at least 1) extra matches. Shingles of
   prefixes that occur in two different sets are found by partial sums; a set with fewer than l of them has no partner
   and is done. Equal sets are one class from here on.
2. Prefixes. The sets that are left count their shingles in a sketch of fixed size, and order them from rare to frequent.
   Each set picks its own l, from the estimated cost: the postings it has to read, and the candidates that have to be
   verified, of which there are at most postings / l. Frequent shingles in a prefix thus make it longer and ask for more
   matches.
3. Star. In the postings of a shingle, all sets are tried against the most typical one only. The links found join most
   of a group of copies, however large, by one link each.
4. Rest. Pairs that share a prefix shingle but lie in different components are counted, over the prefixes that the sizes
   of the two call for; those with min(l of both) matches or more are verified. Pairs within a component cannot change it
   and are not made here.
5. Links (``linked_groups`` only). Linked sets are in one component, so the links of a set are counted against all sets of
   its component, in products of block x block; a pair is never a row. Equal sets are counted by the size of their class.

All verification is exact on whole sets (of 64-bit shingle hashes). Step 4 alone settles what the star leaves, so that no
link between components is lost.

Defined cases: a null or empty text, or one without words, has no shingles and no links; a text of fewer than n words is
one shingle; equal sets are linked; repeated rows and null ids are rows like others (a component of null ids alone has a
null id); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import durable, lean, trim
from llm.components import connected_components
from llm.shingles import mix, shingle_sets

SIEVE = 25  # one extra match per so many shingles
ROWS, WIDTH = 2, 1 << 21  # the sketch: counters per row
EXTRA = 16  # the most extra matches a set may ask for
VERIFY = 0.001  # cost of verifying one shingle of a candidate, in postings read
BITMAP = 1 << 23
STARS = 1
BLOCK_SETS, BLOCK_TOKENS = 256, 1 << 16  # of a block of a component, on average
SPREAD_SETS, SPREAD = 128, 8  # smaller components have blocks of so many sets, up to so many blocks
COLUMNS = 4096  # of a product at once


def needed(size: np.ndarray, percent: int) -> np.ndarray:
    return (size * percent + 99) // 100


def _class_keys(sets: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Two hashes of each set; 0 for an empty one."""
    begin = np.cumsum(sizes) - sizes
    full = np.flatnonzero(sizes)
    keys = np.zeros((2, len(sizes)), np.uint64)
    for k in range(2):  # order does not matter to a sum
        if len(full):
            keys[k, full] = mix(np.add.reduceat(mix(sets, np.uint64(k + 11)), begin[full]), sizes[full].astype(np.uint64))
    return keys


def _sieve_rows(n: int, percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            names, row_keys = batch["name"].to_numpy(), batch["key"].to_numpy()
            for first, sets, sizes in shingle_sets(batch["text"].tolist(), n):
                begin = np.cumsum(sizes) - sizes
                keys = _class_keys(sets, sizes)
                extra = np.maximum(sizes // SIEVE, 1)
                length = np.where(sizes > 0, np.minimum(sizes - needed(sizes, percent) + extra, sizes), 0)
                prefixes = [sets[b:b + m].view(np.int64) for b, m in zip(begin.tolist(), length.tolist())]
                yield pd.DataFrame({"name": names[first:first + len(sizes)], "key": row_keys[first:first + len(sizes)], "n": sizes, "cls": keys[0].view(np.int64),
                                    "check": keys[1].view(np.int64), "extra": extra, "prefix": prefixes})
    return run


def _sketch_places(tokens: np.ndarray) -> list[np.ndarray]:
    return [(mix(tokens, np.uint64(101 + r)) & np.uint64(WIDTH - 1)).astype(np.int64) for r in range(ROWS)]


def _sketch_part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts = np.zeros((ROWS, WIDTH), np.int32)
    for batch in batches:
        for tokens in batch["tokens"]:
            for r, at in enumerate(_sketch_places(np.asarray(tokens, np.int64).view(np.uint64))):
                np.add.at(counts[r], at, 1)
    chunk = counts.reshape(-1, WIDTH // 16)
    yield pd.DataFrame({"chunk": range(len(chunk)), "counts": [c.tobytes() for c in chunk]})


def _sum_chunk(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(WIDTH // 16, np.int64)
    for data in rows["counts"]:
        total += np.frombuffer(data, np.int32)
    return pd.DataFrame({"chunk": [key[0]], "counts": [np.minimum(total, 2**31 - 1).astype(np.int32).tobytes()]})


def sketch(sets: DataFrame) -> np.ndarray:
    """How often shingles occur, never too low: ROWS x WIDTH counters (16 MB) whatever the input."""
    parts = sets.select("tokens").mapInPandas(lean(_sketch_part), "chunk int, counts binary")
    rows = parts.groupBy("chunk").applyInPandas(_sum_chunk, "chunk int, counts binary").collect()
    whole = b"".join(bytes(r["counts"]) for r in sorted(rows, key=lambda r: r["chunk"]))
    return np.frombuffer(whole, np.int32).reshape(ROWS, WIDTH) if whole else np.zeros((ROWS, WIDTH), np.int32)


def choose_extra(often: np.ndarray, size: int, need: int) -> int:
    """The extra matches that make a prefix cheapest. ``often``: estimated frequencies from rare to frequent.

    With l extra matches the postings of size - need + l shingles are read, and at most their sum / l sets reach l."""
    limit = min(EXTRA, need)
    postings = np.cumsum(often[:size - need + limit], dtype=np.float64)[size - need:]
    extra = np.arange(1, limit + 1)
    return int(np.argmin(postings * (1 + VERIFY * size / extra))) + 1


def _postings(shared, percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = shared.value
        usual = np.median(counts, 1)
        for batch in batches:
            out = []
            for cls, tokens in zip(batch["cls"].tolist(), batch["tokens"]):
                tokens = np.asarray(tokens, np.int64).view(np.uint64)
                often = np.minimum.reduce([counts[r][at] - usual[r] for r, at in enumerate(_sketch_places(tokens))])
                often = np.maximum(often, 0)
                by = np.lexsort((tokens, often))
                size = len(tokens)
                need = int(needed(np.int64(size), percent))
                extra = choose_extra(often[by], size, need)
                prefix = tokens[by[:size - need + extra]].view(np.int64)
                out.append((cls, size, extra, float(often.mean()), prefix))
            yield pd.DataFrame(out, columns=["cls", "n", "extra", "typical", "prefix"])
    return run


def _bitmap_part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    bits = np.zeros(BITMAP, bool)
    for batch in batches:
        bits[batch["place"].to_numpy()] = True
    if bits.any():
        words = np.packbits(bits, bitorder="little").reshape(16, -1)
        yield pd.DataFrame({"chunk": range(16), "bits": [w.tobytes() for w in words]})


def _join_bits(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"chunk": [key[0]], "bits": [np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in rows["bits"]]).tobytes()]})


def bitmap_of(keys: DataFrame) -> np.ndarray:
    """The places of ``keys`` (place) in BITMAP bits (1 MB), whatever the input."""
    parts = keys.mapInPandas(lean(_bitmap_part), "chunk int, bits binary").groupBy("chunk").applyInPandas(_join_bits, "chunk int, bits binary")
    rows = sorted(parts.collect(), key=lambda r: r["chunk"])
    return np.frombuffer(b"".join(bytes(r["bits"]) for r in rows), np.int64) if rows else np.zeros(BITMAP // 64, np.int64)


def _wanted(bitmap: np.ndarray):
    """Rows whose key may be wanted, repeated rows of a task once; an exact join follows."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = set()
        for batch in batches:
            at = batch["place"].to_numpy()
            some = batch[(bitmap[at >> 6] >> (at & 63)) & 1 == 1].drop_duplicates("key")
            some = some[~some["key"].isin(seen)]
            seen.update(some["key"].tolist())
            yield some
    return run


def _only(bitmap: np.ndarray):
    """The rows whose place is in the bitmap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("place").to_numpy()
            yield batch.filter(pa.array((bitmap[at >> 6] >> (at & 63)) & 1 == 1))
    return run


def _sets_of(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """``sets`` without most of those that ``classes`` (cls) does not name, so that a join shuffles few whole sets. The bitmap
    is of fixed size: from some ten million classes on it holds back fewer, and the join does the rest."""
    place = F.pmod(F.col("cls"), F.lit(BITMAP)).alias("place")
    bitmap = bitmap_of(classes.select(place))
    return sets.select("cls", "tokens", place).mapInArrow(lean(_only(bitmap)), "cls long, tokens array<long>, place long").drop("place")


def _sets(n: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            classes = batch["cls"].to_numpy()
            for first, sets, sizes in shingle_sets(batch["text"].tolist(), n):
                rows = pd.DataFrame({"cls": classes[first:first + len(sizes)], "tokens": np.split(sets.view(np.int64), np.cumsum(sizes)[:-1])})
                yield rows[_class_keys(sets, sizes)[0].view(np.int64) == rows["cls"].to_numpy()]
    return run


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b), a stored table, whose whole sets are similar. The set of ``a`` travels; ``b`` may be a hub."""
    sets = _sets_of(sets, pairs.select(F.explode(F.array("a", "b")).alias("cls")))
    left = pairs.join(sets.select(F.col("cls").alias("a"), F.col("tokens").alias("left")), "a")
    both = left.join(sets.select(F.col("cls").alias("b"), F.col("tokens").alias("right")), "b")
    common = F.size(F.array_intersect("left", "right"))
    return both.select("a", "b", common.alias("common"), (F.size("left") + F.size("right")).alias("sizes")).filter(
        100 * F.col("common") >= percent * (F.col("sizes") - F.col("common"))).select("a", "b")


def _block_links(tokens: list[np.ndarray], lows: np.ndarray, highs: np.ndarray, percent: int) -> np.ndarray:
    """Which sets at ``lows`` (rows) are similar to which at ``highs`` (columns)."""
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    _, column, times = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(tokens)), sizes)
    twice = times[column] > 1
    column, owner = (np.cumsum(times > 1) - 1)[column[twice]], owner[twice]
    by = np.argsort(column, kind="stable")
    column, owner = column[by], owner[by]
    common = np.zeros((len(lows), len(highs)))
    for first in range(0, int((times > 1).sum()), COLUMNS):
        a, b = np.searchsorted(column, [first, first + COLUMNS])
        part = np.zeros((len(tokens), int(column[b - 1]) - first + 1), np.float32)
        part[owner[a:b], column[a:b] - first] = 1
        common += part[lows] @ part[highs].T
    return 100 * common >= percent * (sizes[lows][:, None] + sizes[highs][None, :] - common)


def _count_links(percent: int):
    """(cls, links): the rows that each set of a pair of blocks is linked to in the other block (or in the block itself)."""
    def count(key: tuple, rows: list[tuple]) -> pd.DataFrame:
        own, classes, copies, tokens = zip(*rows)
        own, copies, tokens = np.array(own), np.array(copies, np.int64), [np.asarray(t, np.int64) for t in tokens]
        lows, highs = (np.flatnonzero(own == k) for k in key[1:])
        links = np.zeros(len(rows), np.int64)
        if len(lows) and len(highs):
            similar = _block_links(tokens, lows, highs, percent)
            if key[1] == key[2]:
                np.fill_diagonal(similar, False)
            else:
                links[highs] = similar.T @ copies[lows]
            links[lows] = similar @ copies[highs]
        return pd.DataFrame({"cls": classes, "links": links})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, rows = None, []
        for batch in batches:
            out = []
            for component, low, high, *row in batch.itertuples(index=False, name=None):
                if (component, low, high) != held:
                    if rows:
                        out.append(count(held, rows))
                    held, rows = (component, low, high), []
                rows.append(row)
            if out:
                yield pd.concat(out)
        if rows:
            yield count(held, rows)
    return run


def _links_of(groups: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(cls, links): the rows of other classes that each class of ``groups`` is linked to."""
    members = durable(groups.select(F.col("node").alias("cls"), "component").join(classes.select("cls", "n", "copies"), "cls"), "members")
    blocks = members.groupBy("component").agg(F.count("*").alias("m"), F.sum("n").alias("tokens")).select("component", F.greatest(
        F.ceil(F.col("m") / BLOCK_SETS), F.ceil(F.col("tokens") / BLOCK_TOKENS),
        F.least(F.ceil(F.col("m") / SPREAD_SETS), F.lit(SPREAD).cast("long"))).alias("blocks"))
    dealt = members.join(blocks, "component").join(_sets_of(sets, members), "cls").withColumn("own", F.pmod(F.xxhash64("cls"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
    pairs = dealt.select("component", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "cls", "copies", "tokens")
    key = ["component", "low", "high"]
    counted = pairs.repartition(*key).sortWithinPartitions(*key).mapInPandas(lean(_count_links(percent)), "cls long, links long")
    return counted.groupBy("cls").agg(F.sum("links").alias("links"))


def similar_groups(docs: DataFrame, n: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id), one row per row of ``docs``; ids are whole numbers."""
    return linked_groups(docs, n, percent, id_col, text_col, False)


def linked_groups(docs: DataFrame, n: int, percent: int, id_col: str = "doc_id", text_col: str = "text", links: bool = True) -> DataFrame:
    """(id, n_shingles, component_id, n_links), one row per row of ``docs``; ids are whole numbers. ``n_links``: how many other
    rows of ``docs`` are similar to the row, equal ones too. Without ``links`` they are not counted."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    # a row is known by its id and text together: ids may be null or shared by different texts
    named = docs.select(name.alias("name"), text.alias("text")).withColumn("key", F.xxhash64("name", "text"))
    base = durable(named.mapInPandas(
        lean(_sieve_rows(n, percent)), "name string, key long, n long, cls long, check long, extra long, prefix array<long>"), "shingles")
    rows = base.select(F.when(F.col("name") != "", F.col("name").cast("long")).alias("id"), "key", "n", "cls", "check", "extra")
    full = rows.filter("n > 0")
    classes = durable(full.groupBy("cls").agg(F.min("id").alias("low_id"), F.min("key").alias("key"), F.max("n").alias("n"), F.count("*").alias("copies"),
                                              F.max("extra").alias("extra"), F.min("check").alias("c1"), F.max("check").alias("c2")), "classes")
    if classes.filter("c1 != c2").limit(1).count():
        raise ValueError("two different sets have the same 64-bit hash; give the sets another seed")

    # 1. the sieve; copies of a class only add to its count
    tokens = base.select("cls", F.explode("prefix").alias("token"))
    shared = tokens.groupBy("token").agg(F.min("cls").alias("low"), F.max("cls").alias("high")).filter("low != high").select("token")
    matches = tokens.join(shared, "token", "left_semi").groupBy("cls").agg(F.count("*").alias("matches"))
    left = durable(classes.join(matches, "cls").filter("matches >= extra").select("cls", "key"), "left")

    # sets of what is left, from one row of each class
    place = F.pmod(F.col("key"), F.lit(BITMAP))
    bitmap = bitmap_of(left.select(place.alias("place")))
    some = named.select("text", "key", place.alias("place")).mapInPandas(lean(_wanted(bitmap)), "text string, key long, place long")
    # repeated rows go before texts become sets, which are larger
    once = some.join(left, "key").select("cls", "key", "text").dropDuplicates(["key", "text"])
    sets = durable(once.select("cls", "text").mapInPandas(lean(_sets(n)), "cls long, tokens array<long>"), "sets")
    if sets.count() != left.count():
        raise ValueError("two different rows have the same 64-bit hash, or the documents changed while they were read")
    return _finish(spark, rows, classes, sets, percent, id_col, links)


def _finish(spark, rows: DataFrame, classes: DataFrame, sets: DataFrame, percent: int, id_col: str, count_links: bool) -> DataFrame:
    # 2. postings from rare to frequent
    counts = spark.sparkContext.broadcast(sketch(sets))
    trim()
    chosen = sets.mapInPandas(lean(_postings(counts, percent)), "cls long, n long, extra long, typical double, prefix array<long>")
    postings = durable(chosen.select("cls", "n", "extra", "typical", F.posexplode("prefix").alias("pos", "token")), "postings")
    # 3. stars around the most typical set of each posting list, first over all, then between components
    links = spark.createDataFrame([], "a long, b long")
    tried = spark.createDataFrame([], "a long, b long")
    components = None
    for _ in range(STARS):
        marked = _marked(postings, components)
        hubs = marked.groupBy("token").agg(F.max(F.struct("typical", "cls", "component", "n", "extra", "pos")).alias("hub"),
                                           F.min("component").alias("c1"), F.max("component").alias("c2")).filter("c1 != c2")
        hubs = hubs.select("token", "hub.*")
        pairs = marked.alias("x").join(hubs.alias("y"), F.expr(f"x.token = y.token AND x.component != y.component AND {_near(percent)}")).select(
            F.col("x.cls").alias("a"), F.col("y.cls").alias("b"))
        # every set with the hub it shares most of its prefix with
        best = pairs.groupBy("a", "b").agg(F.count("*").alias("common")).join(tried, ["a", "b"], "left_anti").groupBy("a").agg(
            F.max(F.struct("common", "b")).alias("m")).select("a", "m.b")
        best = durable(best, "pairs")
        found = durable(_links(best, sets, percent), "links")
        tried = tried.unionByName(best)
        if not found.limit(1).count():
            break
        links = links.unionByName(found)
        components = durable(connected_components(links), "components")
    # 4. pairs of different components with enough common prefix shingles
    marked = _marked(postings, components)
    mixed = marked.groupBy("token").agg(F.min("component").alias("c1"), F.max("component").alias("c2")).filter("c1 != c2").select("token")
    open_ = durable(marked.join(mixed, "token", "left_semi").select("token", "pos", "cls", "n", "extra", "component"), "open")
    pairs = open_.alias("x").join(open_.alias("y"), F.expr(f"x.token = y.token AND x.component < y.component AND {_near(percent)}")).select(
        F.col("x.cls").alias("a"), F.col("y.cls").alias("b"), F.least("x.extra", "y.extra").alias("extra"))
    pairs = pairs.groupBy("a", "b").agg(F.count("*").alias("common"), F.first("extra").alias("extra")).filter("common >= extra").select("a", "b")
    open_pairs = durable(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
    rest = durable(_links(open_pairs, sets, percent), "links")
    groups = connected_components(links.unionByName(rest))

    if count_links:  # 5. links
        classes = classes.join(_links_of(groups, classes, sets, percent), "cls", "left").withColumn(
            "n_links", F.col("copies") - 1 + F.coalesce("links", F.lit(0)))
    counted = ["n_links"] if count_links else []
    labelled = classes.join(groups.withColumnRenamed("node", "cls"), "cls", "left").select(
        "cls", "low_id", F.coalesce("component", "cls").alias("component"), *counted)
    lowest = labelled.groupBy("component").agg(F.min("low_id").alias("component_id"))
    named = labelled.join(lowest, "component").select("cls", "component_id", *counted)
    empty = rows.filter("n = 0").select("id", "n", F.col("id").alias("component_id"), *(F.lit(0).cast("long").alias(c) for c in counted))
    return rows.filter("n > 0").join(named, "cls").select("id", "n", "component_id", *counted).unionByName(empty).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", *counted)


def _near(percent: int) -> str:
    """Whether a shared shingle of x and y lies in both prefixes that their two sizes call for: similar sets share at least
    o = t / (1 + t) of their sizes' sum, so l matches are among the first size - o + l of each."""
    o = f"(({percent} * (x.n + y.n) + {99 + percent}) div {100 + percent})"
    extra = "least(x.extra, y.extra)"
    return (f"100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n) AND x.pos < x.n - {o} + {extra} AND y.pos < y.n - {o} + {extra}")


def _marked(postings: DataFrame, components: DataFrame | None) -> DataFrame:
    if components is None:
        return postings.withColumn("component", F.col("cls"))
    return postings.join(components.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
