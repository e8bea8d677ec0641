"""Best-fit packing of token pieces into sequences of a fixed capacity.

The plan depends on lengths alone, so it is made on the histogram (at most ``capacity`` rows come to the driver) for all
pieces at once: pieces above a third of the capacity are matched greedily, the longest with the longest that still fits,
at most two a sequence; smaller ones go, longest first, to the sequence with the smallest gap that holds them. Equal
sequences are kept as one type with a count, which keeps the plan small.

Rows are then placed without sorting them: each task numbers its pieces by length, one small table turns these numbers
into numbers of the whole input, and number and length lead to sequence and offset through the plan.

Defined cases: a null text is an empty one (its piece is the end id alone); pieces of null or no length get no sequence;
null ids and repeated rows are packed like other rows; an empty table gives an empty result; ``pack`` carries all columns
of its input along, except any named sequence_id or offset, which are replaced.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from llm.byte_bpe import encoder
from llm.common import durable, lean


def token_pieces(docs: DataFrame, path: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                 with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of each document's ids and the end id; a document longer than the
    capacity is cut from its end, so that only its first piece is shorter."""
    columns = ["id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            names, texts = batch["id"].tolist(), batch["text"].tolist()
            for a, ids, counts in encoder(path).encode(texts):
                rows, at = [], 0
                for name, n in zip(names[a:a + len(counts)], counts.tolist()):
                    own = np.append(ids[at:at + n], end_id).astype("<u4")
                    at += n
                    first = (n + 1) % capacity or min(capacity, n + 1)
                    bounds = [0, *range(first, n + 2, capacity)]
                    for piece, (b, e) in enumerate(zip(bounds, bounds[1:])):
                        rows.append((name, piece, b, e - b, zlib.crc32(own[b:e].tobytes()), *([own[b:e].astype(np.int32)] * with_ids)))
                yield pd.DataFrame(rows, columns=columns)

    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    made = rows.mapInPandas(lean(run), "id string, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids)
    return made.withColumn("id", F.col("id").cast(docs.schema[id_col].dataType)).withColumnRenamed("id", id_col)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Types of sequences: (how many, [(length, pieces of it)])."""
    left = {n: c for n, c in counts.items() if c > 0}
    if left and (min(left) < 1 or max(left) > capacity):
        raise ValueError("lengths go from 1 to the capacity")
    types: list[list] = []
    by_gap: dict[int, list[int]] = defaultdict(list)
    gaps: list[int] = []

    def add(many: int, gap: int, items: list[tuple[int, int]]) -> None:
        types.append([many, items])
        if gap:
            if not by_gap[gap]:
                insort(gaps, gap)
            by_gap[gap].append(len(types) - 1)

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        a = large[-1]
        k = bisect_right(large, capacity - a) - 1
        if k < 0:
            add(left[a], capacity - a, [(a, 1)])
            large.pop()
            continue
        b = large[k]
        many = left[a] // 2 if a == b else min(left[a], left[b])
        if many:
            add(many, capacity - a - b, [(a, 2)] if a == b else [(a, 1), (b, 1)])
            left[a] -= many
            left[b] -= many
        else:  # one of this length is left and only it would fit
            if k == 0:
                add(1, capacity - a, [(a, 1)])
            else:
                b = large[k - 1]
                add(1, capacity - a - b, [(a, 1), (b, 1)])
                left[b] -= 1
            left[a] -= 1
        large = [n for n in large if left[n]] if not (left[a] and left[b]) else large

    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            at = bisect_left(gaps, n)
            if at == len(gaps):
                each = capacity // n
                full, rest = divmod(left[n], each)
                if full:
                    add(full, capacity - each * n, [(n, each)])
                if rest:
                    add(1, capacity - rest * n, [(n, rest)])
                left[n] = 0
                continue
            gap = gaps[at]
            t = by_gap[gap].pop()
            if not by_gap[gap]:
                gaps.pop(at)
            many, items = types[t]
            each = gap // n
            full = min(many, left[n] // each)
            left[n] -= full * each
            if full:
                add(full, gap - each * n, items + [(n, each)])
            if full < many:
                rest, left[n] = left[n], 0
                if rest:
                    add(1, gap - rest * n, items + [(n, rest)])
                if many - full - bool(rest):
                    add(many - full - bool(rest), gap, items)
            types[t][0] = 0
    return [(many, items) for many, items in types if many]


def pack(pieces: DataFrame, capacity: int, length_col: str = "length") -> DataFrame:
    """Adds sequence_id and offset: pieces of a sequence stand without gaps from 0 on."""
    pieces = pieces.drop("sequence_id", "offset")
    schema = T.StructType([*pieces.schema.fields, T.StructField("_part", T.LongType()), T.StructField("_number", T.LongType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            lengths = _lengths(batch.column(names.index(length_col)))
            order = np.argsort(lengths, kind="stable")
            ordered = lengths[order]
            first = np.searchsorted(ordered, ordered, "left")
            numbers = np.empty(len(lengths), np.int64)
            numbers[order] = seen[ordered] + np.arange(len(ordered)) - first
            seen += np.bincount(lengths, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(lengths), part, np.int64)), pa.array(numbers)],
                                             [*names, "_part", "_number"])

    names = pieces.columns
    numbered = durable(pieces.mapInArrow(lean(number), schema), "pieces")
    length = F.col(length_col)
    # one row per task and length; its sums by length are the histogram
    tallies = numbered.filter(length >= 1).groupBy("_part", length.alias("_length")).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("_length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = tallies.withColumn("_base", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    histogram = {int(r["_length"]): int(r["n"]) for r in tallies.groupBy("_length").agg(F.sum("_n").alias("n")).collect()}
    table = _ranges(plan(histogram, capacity))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, base = (batch.column(out.index(c)).to_numpy(zero_copy_only=False) for c in (length_col, "_base"))
            at_all = batch.column(out.index("_number")).to_numpy(zero_copy_only=False)
            sequence, offset = np.full(len(at_all), -1, np.int64), np.full(len(at_all), -1, np.int64)
            real = np.flatnonzero(~pd.isna(base))
            if len(real):
                size, n = lengths[real].astype(np.int64), (at_all[real] + base[real]).astype(np.int64)
                row = np.searchsorted(table["key"], size * SPAN + n, "right") - 1
                inner = n - (table["key"][row] - size * SPAN)
                sequence[real] = table["sequence"][row] + inner // table["each"][row]
                offset[real] = table["offset"][row] + inner % table["each"][row] * size
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(out.index(c)) for c in names), pa.array(sequence, mask=sequence < 0), pa.array(offset, mask=offset < 0)],
                [*names, "sequence_id", "offset"])

    joined = numbered.join(bases.withColumnRenamed("_part", "_p"), (F.col("_part") == F.col("_p")) & (length == F.col("_length")), "left")
    joined = joined.select(*names, "_number", "_base")
    out = joined.columns
    return joined.mapInArrow(lean(place), T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()),
                                                  T.StructField("offset", T.LongType())]))


#: Numbers of pieces of one length stay below this.
SPAN = 2**45


def _lengths(column: pa.Array) -> np.ndarray:
    values = column.to_numpy(zero_copy_only=False)
    return np.maximum(np.where(pd.isna(values), 0, values).astype(np.int64), 0)


def _ranges(types: list[tuple[int, list[tuple[int, int]]]]) -> dict[str, np.ndarray]:
    """Where numbers of a length go: from ``key`` (length and first number) on, ``each`` a sequence from ``sequence`` on."""
    rows, used, sequence = [], defaultdict(int), 0
    for many, items in types:
        offset = 0
        for n, each in items:
            rows.append((n * SPAN + used[n], sequence, each, offset))
            used[n] += many * each
            offset += n * each
        sequence += many
    rows.sort()
    columns = np.array(rows, np.int64).reshape(len(rows), 4)
    return {k: columns[:, i].copy() for i, k in enumerate(("key", "sequence", "each", "offset"))}


def sequences(packed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(sequence_id, ids, doc_ids, starts): the packed sequences themselves; at most ``capacity`` ids meet in a group."""
    rows = F.sort_array(F.collect_list(F.struct("offset", F.col(id_col).alias("id"), "ids")))
    return packed.filter(F.col("sequence_id").isNotNull()).groupBy("sequence_id").agg(rows.alias("r")).select(
        "sequence_id", F.flatten("r.ids").alias("ids"), F.col("r.id").alias("doc_ids"), F.col("r.offset").alias("starts"))
