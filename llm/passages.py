"""Which documents have a passage of over 50 words that stands in another document, too.

Of every 51 words in a row, the 32 in a row with the smallest hash are marked (20 strings to choose from, so the same one
wherever the 51 stand). A mark that two documents have is a shared passage of 32 words at least, and a shared passage of 51
words always holds one: none is missed, and nothing under 32 words counts. A task compares the documents of a batch at once
and sends on each mark with one of its documents only, so that a passage in a third of all documents is a few rows.

Defined cases: null, empty and short texts share nothing; rows with the same id and text are one document; a null id is an id;
A-Z count as a-z, and words are runs of anything but ASCII white space; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import lean
from llm.shingles import mix
from llm.suffix_dedup import _PLACE, _powers, _sliding_min
from llm.terms import WORDS, Runs, runs

MARK, CHOICE = 32, 20  # words of a mark, and marks to choose from: 51 words


def marks(found: Runs) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of the marks of the texts."""
    n, whole = len(found.keys), MARK + CHOICE - 1
    if n < whole:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    power, inverse = _powers(1 << max(20, int(n + 1).bit_length()))
    sums = np.append(np.uint64(0), np.cumsum(found.keys * power[:n]))
    hashes = mix((sums[MARK:] - sums[:-MARK]) * inverse[:n - MARK + 1], np.uint64(MARK))
    chosen = (_sliding_min((hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64), CHOICE) & _PLACE).astype(np.int64)
    inside = found.owner[:n - whole + 1] == found.owner[whole - 1:]
    chosen = np.unique(chosen[inside])
    return hashes[chosen], found.owner[chosen]


def _shared(hashes: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names that share a hash with another, and each hash with one of its names."""
    by = np.lexsort((names, hashes))
    hashes, names = hashes[by], names[by]
    if not len(hashes):
        return names, hashes, names
    first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
    sizes = np.diff(np.append(first, len(hashes)))
    several = np.repeat(names[first] != names[first + sizes - 1], sizes)
    return np.unique(names[several]), hashes[first], names[first]


def _marks(shards: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            names, found = batch["name"].to_numpy(), []
            for first, stop, words in runs(batch["text"].tolist(), WORDS):
                hashes, owner = marks(words)
                found.append((hashes, names[first:stop][owner]))
            if not found:
                continue
            caught, hashes, one = _shared(*map(np.concatenate, zip(*found)))
            shard = (hashes % np.uint64(shards)).astype(np.int64)
            by = np.argsort(shard, kind="stable")
            cuts = np.searchsorted(shard[by], np.arange(shards + 1))
            out = [(-1 - int(caught[0] % shards), caught.tobytes(), b"")] if len(caught) else []
            out += [(s, one[by[cuts[s]:cuts[s + 1]]].tobytes(), hashes[by[cuts[s]:cuts[s + 1]]].tobytes()) for s in np.flatnonzero(np.diff(cuts)).tolist()]
            yield pd.DataFrame(out, columns=["shard", "names", "marks"])
    return run


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Names of the documents that share a mark; rows arrive sorted by shard."""
    def result(held: list) -> pd.DataFrame:
        names, hashes = (np.concatenate([np.frombuffer(x, t) for x in column]) for column, t in zip(zip(*held), (np.int64, np.uint64)))
        return pd.DataFrame({"name": _shared(hashes, names)[0]})

    shard, held = None, []
    for batch in batches:
        for row in batch.itertuples(index=False):
            if row.shard != shard and held:
                yield result(held)
                held = []
            shard = row.shard
            if shard < 0:  # found within a batch
                yield pd.DataFrame({"name": np.frombuffer(row.names, np.int64)})
            else:
                held.append((row.names, row.marks))
    if held:
        yield result(held)


def sharing(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, shares_passage), one row per id."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col), F.xxhash64(F.col(id_col).cast("string"), text).alias("name"), text.alias("text"))
    shards = max(64, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = rows.select("name", "text").mapInPandas(lean(_marks(shards)), "shard long, names binary, marks binary")
    caught = found.repartition("shard").sortWithinPartitions("shard").mapInPandas(lean(_compare), "name long").distinct()
    return rows.select(id_col, "name").join(caught.withColumn("hit", F.lit(True)), "name", "left").groupBy(id_col).agg(
        F.coalesce(F.max("hit"), F.lit(False)).alias("shares_passage"))
