"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of byte n-grams.

The model is trained on all trusted documents, one model a language. Counts, continuation counts, discounts and
probabilities are Spark tables keyed by (language, n-gram), built order by order:

    p_k(w | h) = (c(hw) - D(c(hw))) / c(h.) + gamma(h) * p_(k-1)(w | h'),   gamma(h) = sum of D(c(hw)) / c(h.)

with D1, D2, D3+ from the counts of counts of the order, raw counts in the highest order, numbers of distinct left
neighbours below it, and 1 / 256 under the unigrams. An n-gram of up to seven bytes is a number, so that its context is a
shift and its suffix a mask.

Scoring moves n-grams, not tokens: tasks list the distinct n-grams of a chunk of documents (an input block), sharded joins
on (language, n-gram) put probabilities to them, and each chunk gets its own list back, with its documents compressed.
What is moved grows with the n-grams the corpus has.

A document's score is its mean negative log probability per byte, drawn towards its language's mean as if ``PRIOR``
bytes of that had been seen too (short documents say little). The limit of a language comes from quantiles of trusted
documents that were held out of training (every fifth, by a hash of the id): the median plus ``SPREAD`` times the
distance from there to the upper quantile. A language of which no trusted document was held out takes the distance of its
mean to the limit from the held-out documents of all languages, each seen from its language's mean.

Defined cases: a null or empty text scores null and is rejected; a null language is a language of its own; documents of
languages without trusted text are kept, as nothing can be said; null ids and repeated rows are scored like others, and
labels with null values are ignored; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import durable, lean, slices

ORDER = 5
PRIOR = 300
QUANTILE, SPREAD = 0.9, 5.0
HELD_OUT = 5
SLICE = 1_000_000  # bytes worked on at once
PART = 4_000_000  # bytes of text that become Python objects at once
PAYLOAD = 8_000_000  # bytes of text in one compressed row
BROADCAST_ROWS = 1_000_000  # labels of up to so many documents are copied to all tasks, others are joined
BROADCAST_LANGUAGES = 100_000  # tables of up to so many languages are copied, too


def gram_keys(texts: list[bytes], order: int) -> np.ndarray:
    """The n-gram that ends at each byte of each text, with line feeds before the text's start."""
    pad = b"\n" * (order - 1)
    data = np.frombuffer(b"".join(x for t in texts for x in (pad, t)) + pad, np.uint8).astype(np.int64)
    keys = np.zeros(len(data) - order + 1, np.int64)
    for k in range(order):
        keys = (keys << 8) | data[k:len(data) - order + 1 + k]
    lengths = np.array([[len(t), order - 1] for t in texts], np.int64).ravel()
    real = np.repeat(np.arange(len(lengths)) % 2 == 0, lengths)
    return keys[real[:len(keys)]]


def _in_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
    """The batches' rows, a few at a time: a whole batch of texts would stand in memory twice."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(batch.schema.get_field_index("text"))).to_numpy(zero_copy_only=False)
        for a, b in slices(sizes.astype(np.int64), PART):
            yield batch.slice(a, b - a).to_pandas()


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, back = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(back, np.concatenate([c for _, c in parts]), len(keys)).astype(np.int64)


def _gram_rows(order: int):
    """Distinct n-grams of each chunk and language, with their counts in trusted text."""
    def rows(chunk: str, held: dict) -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            keys, counts = _merge(parts)
            n = len(keys)
            yield pa.RecordBatch.from_arrays([pa.array([chunk]).take(pa.array(np.zeros(n, np.int32))), pa.array([lang]).take(pa.array(np.zeros(n, np.int32))),
                                              pa.array(keys), pa.array(counts)], ["chunk", "lang", "gram", "count"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held = None, defaultdict(list)
        for batch in _in_parts(batches):
            for (this, lang, train), group in batch.groupby(["chunk", "lang", "train"], sort=False):
                if this != chunk:
                    yield from rows(chunk, held)
                    chunk, held = this, defaultdict(list)
                texts = group["text"].tolist()
                for a, b in slices(np.array([len(t) for t in texts], np.int64), SLICE):
                    keys = np.sort(gram_keys(texts[a:b], order))
                    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
                    counts = np.diff(np.append(first, len(keys))) if train else np.zeros(len(first), np.int64)
                    held[lang].append((keys[first], counts))
                    if len(held[lang]) > 16:
                        held[lang] = [_merge(held[lang])]
        yield from rows(chunk, held)
    return run


def _by_language(table: DataFrame) -> DataFrame:
    """``table``, a row a language, stored; copied to all tasks where it is small, so that no n-gram or document is dealt out by
    its language alone."""
    table = durable(table, "languages")
    return F.broadcast(table) if table.count() <= BROADCAST_LANGUAGES else table


def _discount(c: Column) -> Column:
    return F.when(c == 1, F.col("d1")).when(c == 2, F.col("d2")).otherwise(F.col("d3"))


def model_tables(counts: DataFrame, order: int) -> list[tuple[DataFrame, DataFrame]]:
    """Per order from 1 on: (lang, gram, alpha) of seen n-grams and (lang, context, gamma) of seen contexts."""
    tables = []
    for k in range(order, 0, -1):
        if k < order:
            counts = durable(counts.groupBy("lang", F.col("gram").bitwiseAND((1 << 8 * k) - 1).alias("gram")).agg(F.count("*").alias("c")), "counts")
        few = [F.sum((F.col("c") == i).cast("double")).alias(f"n{i}") for i in range(1, 5)]
        ratio = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
        # an order with too few counts of counts falls back on fixed discounts
        discounts = counts.groupBy("lang").agg(*few).select("lang", *(
            F.least(F.greatest(F.coalesce(F.when(F.col(f"n{i}") > 0, i - (i + 1) * ratio * F.col(f"n{i + 1}") / F.col(f"n{i}")), F.lit(0.5 * i)),
                               F.lit(0.05)), F.lit(i - 0.05)).alias(f"d{i}") for i in (1, 2, 3)))
        known = counts.join(_by_language(discounts), "lang").withColumn("d", _discount(F.col("c")))
        context = F.shiftright("gram", 8).alias("context")
        contexts = durable(known.groupBy("lang", context).agg(F.sum("c").alias("total"), F.sum("d").alias("d")), "contexts")
        seen = known.select("lang", "gram", context, (F.col("c") - F.col("d")).alias("rest")).join(contexts.drop("d"), ["lang", "context"])
        tables.append((seen.select("lang", "gram", (F.col("rest") / F.col("total")).alias("alpha")),
                       contexts.select("lang", "context", (F.col("d") / F.col("total")).alias("gamma"))))
    return tables[::-1]


def probabilities(grams: DataFrame, tables: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(lang, gram, p) of the distinct n-grams ``grams`` of the highest order."""
    wanted = [grams]
    for k in range(len(tables) - 1, 0, -1):
        wanted.append(wanted[-1].select("lang", F.col("gram").bitwiseAND((1 << 8 * k) - 1).alias("gram")).distinct())
    lower = None
    for k, (seen, contexts) in enumerate(tables, 1):
        rows = wanted[len(tables) - k].join(seen, ["lang", "gram"], "left").withColumn("context", F.shiftright("gram", 8))
        rows = rows.join(contexts, ["lang", "context"], "left").withColumn(
            "suffix", F.col("gram").bitwiseAND((1 << 8 * (k - 1)) - 1))
        if lower is None:
            rows = rows.withColumn("q", F.lit(1 / 256))
        else:
            rows = rows.join(lower.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("q")), ["lang", "suffix"])
        lower = durable(rows.select("lang", "gram", (F.coalesce("alpha", F.lit(0.0)) + F.coalesce("gamma", F.lit(1.0)) * F.col("q")).alias("p")), "p")
    return lower


def _payload(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of a chunk, compressed together; the rows of one language stand next to each other."""
    import pickle

    import zstandard

    packer = zstandard.ZstdCompressor(level=3)

    def row(chunk: str, lang: str, names: list, marks: list, texts: list) -> pa.RecordBatch:
        data = packer.compress(pickle.dumps((names, marks, texts)))
        return pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([lang]), pa.array([data], pa.binary())], ["chunk", "lang", "data"])

    chunk, held = None, {}
    for batch in _in_parts(batches):
        for (this, lang), group in batch.groupby(["chunk", "lang"], sort=False):
            if this != chunk:
                for key, (_, *lists) in held.items():
                    yield row(chunk, key, *lists)
                chunk, held = this, {}
            texts, marks = group["text"].tolist(), group["mark"].tolist()
            names = group["id"].tolist()
            for a, b in slices(np.array([len(t) for t in texts], np.int64), PAYLOAD):
                size = sum(map(len, texts[a:b]))
                if lang in held and held[lang][0] + size > PAYLOAD:
                    yield row(chunk, lang, *held.pop(lang)[1:])
                total, *lists = held.get(lang, (0, [], [], []))
                for have, more in zip(lists, (names[a:b], marks[a:b], texts[a:b])):
                    have += more
                held[lang] = (total + size, *lists)
    for key, (_, *lists) in held.items():
        yield row(chunk, key, *lists)


def _scores(order: int):
    def own(column: pa.ListArray, at: int, kind: type) -> np.ndarray:
        """A view of one row's list; a chunk of empty texts has none."""
        if not column[at].is_valid:
            return np.zeros(0, kind)
        return column.values.slice(column.offsets[at].as_py(), column.offsets[at + 1].as_py() - column.offsets[at].as_py()).to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pickle

        import zstandard

        opener = zstandard.ZstdDecompressor()
        for batch in batches:
            langs, packed, all_grams, all_logs = (batch.column(batch.schema.get_field_index(c)) for c in ("lang", "data", "grams", "logs"))
            for at_row in range(batch.num_rows):
                names, marks, texts = pickle.loads(opener.decompress(packed[at_row].as_buffer()))
                grams, logs = own(all_grams, at_row, np.int64), own(all_logs, at_row, np.float32)
                by = np.argsort(grams)
                grams, logs = grams[by], logs[by].astype(np.float64)
                del by
                sums = []
                for a, b in slices(np.array([len(t) for t in texts], np.int64), SLICE):
                    keys = gram_keys(texts[a:b], order)
                    at = np.searchsorted(grams, keys)
                    if len(keys) and (at.max() >= len(grams) or (grams[at] != keys).any()):
                        raise ValueError("a chunk was read in other blocks than before; store the documents first")
                    before = np.append(0.0, np.cumsum(logs[at]))
                    ends = np.cumsum([len(t) for t in texts[a:b]])
                    sums.append(np.diff(before[np.append(0, ends)]))
                n = len(texts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()), pa.array([langs[at_row].as_py()] * n, pa.string()), pa.array(marks, pa.int32()),
                     pa.array([len(t) for t in texts], pa.int64()), pa.array(-np.concatenate(sums) if sums else np.zeros(0), pa.float64())],
                    ["id", "lang", "mark", "n_bytes", "loss"])
    return run


def perplexity(docs: DataFrame, labels: DataFrame, trusted: Column, order: int = ORDER, id_col: str = "doc_id", text_col: str = "text",
               lang_col: str = "lang", label_id: str = "doc_id") -> DataFrame:
    """(id, lang, n_bytes, perplexity, score, score_limit, kept), one row per row of ``docs``. ``trusted``: a condition on
    ``labels`` that holds for all labels of a trusted document."""
    marks = labels.select(F.col(label_id).cast("string").alias("label_id"), F.coalesce(trusted, F.lit(False)).alias("ok")).dropna()
    marks = marks.groupBy("label_id").agg(F.min("ok").alias("ok")).filter("ok").select(
        "label_id", F.when(F.pmod(F.xxhash64("label_id"), F.lit(HELD_OUT)) == 0, 2).otherwise(1).alias("mark"))
    marks = durable(marks, "marks")
    if marks.count() <= BROADCAST_ROWS:
        marks = F.broadcast(marks)
    block = F.concat_ws(":", F.input_file_name(), F.input_file_block_start())
    name = F.col(id_col).cast("string")
    rows = docs.select(
        name.alias("id"), F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"),
        F.when(F.input_file_name() == "", F.pmod(F.xxhash64(name), F.lit(64)).cast("string")).otherwise(block).alias("chunk"))
    rows = rows.join(marks, F.col("id") == F.col("label_id"), "left").select(
        "id", "lang", "text", "chunk", F.coalesce("mark", F.lit(0)).alias("mark"))

    grams = durable(rows.select("chunk", "lang", (F.col("mark") == 1).alias("train"), "text").mapInArrow(
        lean(_gram_rows(order)), "chunk string, lang string, gram long, count long"), "grams")
    counts = durable(grams.groupBy("lang", "gram").agg(F.sum("count").alias("c")), "counts")
    tables = model_tables(counts.filter("c > 0"), order)
    p = probabilities(counts.select("lang", "gram"), tables)
    lists = grams.select("chunk", "lang", "gram").join(p, ["lang", "gram"]).groupBy("chunk", "lang").agg(
        F.collect_list(F.struct("gram", F.log("p").cast("float").alias("log"))).alias("g")).select(
        "chunk", "lang", F.col("g.gram").alias("grams"), F.col("g.log").alias("logs"))
    packed = rows.select("id", "lang", "chunk", "mark", "text").mapInArrow(lean(_payload), "chunk string, lang string, data binary")
    scored = packed.join(lists, ["chunk", "lang"], "left").select("lang", "data", "grams", "logs").mapInArrow(
        lean(_scores(order)), "id string, lang string, mark int, n_bytes long, loss double")
    scored = durable(scored, "scores")

    means = scored.filter("mark > 0 AND n_bytes > 0").groupBy("lang").agg((F.sum("loss") / F.sum("n_bytes")).alias("mean"))
    scored = scored.join(_by_language(means), "lang", "left").withColumn("score", F.when(
        F.col("n_bytes") > 0, (F.col("loss") + PRIOR * F.col("mean")) / (F.col("n_bytes") + PRIOR)))
    known = scored.filter("mark = 2 AND n_bytes > 0")
    quantiles = F.percentile_approx("score", [0.5, QUANTILE], 10_000)
    limits = known.groupBy("lang").agg(quantiles.alias("q")).select(
        "lang", (F.col("q")[0] + SPREAD * (F.col("q")[1] - F.col("q")[0])).alias("own_limit"))
    pooled = known.agg(F.percentile_approx(F.col("score") - F.col("mean"), [0.5, QUANTILE], 10_000)).first()[0]
    above = F.lit(None).cast("double") if pooled is None else F.col("mean") + pooled[0] + SPREAD * (pooled[1] - pooled[0])
    result = scored.join(_by_language(limits), "lang", "left").withColumn("score_limit", F.coalesce("own_limit", above))
    return result.select(
        F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), F.when(F.col("lang") != "", F.col("lang")).alias("lang"), "n_bytes",
        F.when(F.col("n_bytes") > 0, F.exp(F.col("loss") / F.col("n_bytes"))).alias("perplexity"), "score", "score_limit",
        ((F.col("n_bytes") > 0) & F.coalesce(F.col("score") <= F.col("score_limit"), F.lit(True))).alias("kept"))
