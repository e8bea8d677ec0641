"""Removal of repeated byte strings of a given length from all documents, by suffix arrays.

A string of ``length`` bytes that stands at two places has the same rarest gram (16 bytes of the smallest hash, the first
of equal ones) at the same distance in both. So every start of such a string belongs to one anchor, and equal strings
belong to equal anchors: anchors deal the work out, and suffix arrays settle it.

1. Each text yields its anchors: runs of neighbouring starts with the same gram, a hash of the gram, and a 64-bit hash of
   the run's context (the bytes that its strings cover). Occurrences in one text are listed in one row.
2. Anchors that occur once are dropped, after partial counts. Equal contexts of an anchor become one, with a count.
3. Contexts of an anchor meet in one task, which sorts their suffixes (``suffix_array``: two-stage sorting, adjacent
   common prefixes) for many anchors at a time. Starts that share ``length`` bytes with another start, or whose context
   stands at several places, are repeated. Contexts of an anchor with over ``HEAVY`` different ones are first cut by
   distance to the anchor and dealt out by the bytes that all strings of such a cut have in common.
4. Repeated starts go back to the documents, which drop the bytes they cover.

Texts go to the tasks of steps 3 and 4 compressed, and only one of equal texts; equal texts of at least ``length`` bytes
are repeated as a whole.

Defined cases: a null text is an empty one; texts shorter than ``length`` stay as they are; repeated rows repeat each
other's bytes; null ids are allowed; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import durable, lean, ragged, slices
from llm.suffix_array import repeated_starts, words_at

GRAM = 16
PIECE = 1_000_000  # bytes worked on at once when anchors are found
BATCH = 1_500_000  # bytes of contexts sorted at once
HEAVY = 4096  # different contexts of an anchor from which they are cut
CUT = 32  # starts of such a cut
_PLACE = np.uint64(0xFFFFFF)
_BYTES = np.random.default_rng(20_240_301).integers(1, 2**63, 256, dtype=np.uint64)


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0x9E3779B97F4A7C15
    out = []
    for b in (base, pow(base, -1, 2**64)):
        p = np.full(n, np.uint64(b))
        p[0] = 1
        out.append(np.cumprod(p))
    return out[0], out[1]


def _mix(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    rows = -(-len(values) // width)
    block = np.append(values, np.full(rows * width - len(values), ~np.uint64(0))).reshape(rows, width)
    ahead = np.minimum.accumulate(block, 1).ravel()
    back = np.minimum.accumulate(block[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[:len(values) - width + 1], ahead[width - 1:len(values)])


def anchors(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """For each run of starts its text, first start, width, and the hashes of gram and context. Long texts are cut where it does no harm: between starts."""
    pieces = []  # (text, from, to): starts from .. to - 1, with the bytes that their strings cover
    step = 4 * PIECE
    for i, t in enumerate(texts):
        pieces += [(i, a, min(a + step, len(t) - length + 1)) for a in range(0, len(t) - length + 1, step)]
    sizes = np.array([to - a + length - 1 for _, a, to in pieces], np.int64)
    for first, stop in slices(sizes, PIECE):
        part, size = pieces[first:stop], sizes[first:stop]
        data = np.frombuffer(b"".join(texts[i][a:to + length - 1] for i, a, to in part), np.uint8)
        words = words_at(data, 8)
        grams = words[:-8] * np.uint64(0x9E3779B97F4A7C15)
        grams ^= words[8:] * np.uint64(0xC2B2AE3D27D4EB4F)
        grams = _mix(grams)
        place = np.arange(len(data), dtype=np.uint64)
        chosen = (_sliding_min((grams & ~_PLACE) | place, length - GRAM + 1) & _PLACE).astype(np.int64)
        begins = np.cumsum(size) - size
        widths = size - length + 1
        starts = ragged(begins, widths)
        owner = np.repeat(np.arange(len(part)), widths)
        anchor = chosen[starts]
        cut = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])))
        low = starts[cut]
        width = np.diff(np.append(cut, len(starts)))
        power, inverse = _powers(max(1 << 20, 1 << int(len(data) + 1).bit_length()))
        sums = np.append(np.uint64(0), np.cumsum(_BYTES[data] * power[:len(data)]))
        context = (sums[low + width + length - 1] - sums[low]) * inverse[low]
        context = _mix(context + width.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        who = owner[cut]
        text = np.array([i for i, _, _ in part], np.int64)[who]
        within = low - begins[who] + np.array([a for _, a, _ in part], np.int64)[who]
        yield text, within, width, grams[anchor[cut]], context


def _key(text: Column) -> list[Column]:
    digest = F.md5(text.cast("binary"))
    return [F.conv(F.substring(digest, k, 16), 16, -10).cast("long").alias(n) for k, n in ((1, "k1"), (17, "k2"))]


def _anchor_rows(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            k1, k2 = batch["k1"].to_numpy(), batch["k2"].to_numpy()
            for text, low, width, gram, context in anchors(batch["text"].tolist(), length):
                # places of the same gram and context in one text are one row
                by = np.lexsort((low, context, gram, text))
                text, low, width, gram, context = (x[by] for x in (text, low, width, gram, context))
                new = np.append(True, (text[1:] != text[:-1]) | (gram[1:] != gram[:-1]) | (context[1:] != context[:-1]))
                at = np.flatnonzero(new)
                yield pd.DataFrame({
                    "gram": gram[at].view(np.int64), "context": context[at].view(np.int64), "k1": k1[text[at]], "k2": k2[text[at]],
                    "width": width[at].astype(np.int32), "places": np.split(low, at[1:])})
    return run


def _pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import zstandard

    packer = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        batch["text"] = [packer.compress(t) for t in batch["text"]]
        yield batch


def _contexts(length: int):
    """Cut the contexts out of their texts; those of heavy anchors in cuts, dealt out by what a cut's strings share."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        opener = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for packed, wanted in zip(batch["text"], batch["wanted"]):
                text = opener.decompress(packed)
                for w in wanted:
                    low, width, many = w["place"], w["width"], w["many"]
                    if not w["heavy"]:
                        out.append((w["gram"], w["gram"], w["context"], 0, many, text[low:low + width + length - 1]))
                        continue
                    # the anchor's distance fixes the cuts, so that equal strings fall into equal ones
                    anchor = _anchor_place(text[low:low + width + length - 1], length)
                    for a, b in _cuts(anchor, width):
                        span = (anchor - a) // CUT
                        common = low + anchor - span * CUT  # here starts the last string that the span can hold
                        shared = text[common:common + length - CUT + 1]
                        deal = hashlib.blake2b(shared, digest_size=8, key=f"{w['gram']} {span}".encode()).digest()
                        out.append((int.from_bytes(deal, "big", signed=True), w["gram"], w["context"], a, many,
                                    text[low + a:low + b + length - 1]))
                if len(out) > 20_000:
                    yield pd.DataFrame(out, columns=CONTEXT)
                    out = []
            yield pd.DataFrame(out, columns=CONTEXT)
    return run


CONTEXT = ["deal", "gram", "context", "base", "many", "data"]


def _anchor_place(context: bytes, length: int) -> int:
    """Where the anchor of a run stands in its context, as all strings of the run have the same."""
    words = words_at(np.frombuffer(context[:length], np.uint8), 8)
    grams = words[:-8] * np.uint64(0x9E3779B97F4A7C15)
    grams ^= words[8:] * np.uint64(0xC2B2AE3D27D4EB4F)
    values = _mix(grams)[:length - GRAM + 1] & ~_PLACE
    return int(np.argmin(values))


def _cuts(anchor: int, width: int) -> Iterator[tuple[int, int]]:
    """Parts of 0 .. width - 1 whose distances to the anchor fall into one span of ``CUT``."""
    a = 0
    while a < width:
        b = min(width, a + (anchor - a) % CUT + 1)
        yield a, b
        a = b


def _sorted_groups(length: int):
    """Suffix arrays over many groups at a time; a group's contexts follow one another."""
    def flush(held: dict) -> pd.DataFrame:
        out = []
        for (_, data), entries, flags in zip(held, held.values(), repeated_starts([d for _, d in held], length)):
            if len(entries) > 1 or entries[0][3]:
                flags = np.ones(len(flags), bool)
            edge = np.flatnonzero(np.diff(np.concatenate([[0], flags, [0]])))
            runs = edge.reshape(-1, 2).tolist()
            out += ((gram, context, base + a, base + b) for gram, context, base, _ in entries for a, b in runs)
        return pd.DataFrame(out, columns=["gram", "context", "a", "b"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size, last = {}, 0, None
        for batch in batches:
            for deal, gram, context, base, many, data in batch[CONTEXT].itertuples(index=False, name=None):
                if deal != last and size > BATCH:
                    yield flush(held)
                    held, size = {}, 0
                last = deal
                entries = held.setdefault((deal, data), [])
                if not entries:
                    size += len(data)
                entries.append((gram, context, base, many))
        if held:
            yield flush(held)
    return run


def _covered(length: int):
    """Spans of bytes that repeated starts cover, and what is left of each text."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        opener = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for k1, k2, packed, runs in zip(batch["k1"], batch["k2"], batch["text"], batch["runs"]):
                text = opener.decompress(packed)
                spans: list[list[int]] = []
                for a, b in sorted((r["a"], r["b"] + length - 1) for r in runs):
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], b)
                    else:
                        spans.append([a, b])
                digest, at = hashlib.sha256(), 0
                for a, b in spans:
                    digest.update(text[at:a])
                    at = b
                digest.update(text[at:])
                out.append((k1, k2, sum(b - a for a, b in spans), spans, digest.hexdigest()))
            yield pd.DataFrame(out, columns=["k1", "k2", "removed", "spans", "sha"])
    return run


def repeated_spans(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text", heavy: int = HEAVY) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, spans), one row per row of ``docs``; spans are (from, to) in bytes."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    base = durable(docs.select(F.col(id_col).alias("id"), name.alias("name"), *_key(text), F.octet_length(text).cast("long").alias("n_bytes"),
                               F.sha2(text, 256).alias("sha")), "spans")
    long_texts = docs.select(name.alias("name"), *_key(text), text.cast("binary").alias("text")).filter(F.octet_length("text") >= length)

    found = long_texts.select("k1", "k2", "text").mapInPandas(
        lean(_anchor_rows(length)), "gram long, context long, k1 long, k2 long, width int, places array<int>")
    found = durable(found, "found")  # read twice, found once
    several = found.groupBy("gram").agg(
        *(f(c).alias(f"{f.__name__}_{c}") for c in ("k1", "k2", "context") for f in (F.min, F.max)), F.max(F.size("places")).alias("times"))
    several = several.filter("min_k1 != max_k1 OR min_k2 != max_k2 OR min_context != max_context OR times > 1").select("gram")
    # one row per text, anchor and context: all that the later steps need of the anchors
    places = durable(found.join(several, "gram", "left_semi"), "anchors")

    contexts = places.groupBy("gram", "context").agg(
        F.min("k1").alias("min_k1"), F.max("k1").alias("max_k1"), F.min("k2").alias("min_k2"), F.max("k2").alias("max_k2"),
        F.max(F.size("places")).alias("times"), F.min(F.struct("k1", "k2", F.col("places")[0].alias("place"), "width")).alias("one"))
    contexts = contexts.select("gram", "context", "one.*", F.expr(
        "min_k1 != max_k1 OR min_k2 != max_k2 OR times > 1").alias("many"))
    counts = contexts.groupBy("gram").agg(F.count("*").alias("n")).filter(F.col("n") > heavy).select("gram", F.lit(True).alias("heavy"))
    wanted = contexts.join(counts, "gram", "left").groupBy("k1", "k2").agg(F.collect_list(F.struct(
        "gram", "context", "place", "width", "many", F.coalesce("heavy", F.lit(False)).alias("heavy"))).alias("wanted"))

    classes = base.groupBy("k1", "k2").agg(F.count("*").alias("copies"), F.min("name").alias("name"))
    packed = long_texts.mapInPandas(lean(_pack), "name string, k1 long, k2 long, text binary")
    cut_out = packed.join(classes.select("k1", "k2", "name").join(wanted, ["k1", "k2"]), ["k1", "k2", "name"]).select("text", "wanted")
    dealt = cut_out.mapInPandas(lean(_contexts(length)), "deal long, gram long, context long, base int, many boolean, data binary")
    runs = dealt.repartition("deal").sortWithinPartitions("deal").mapInPandas(lean(_sorted_groups(length)), "gram long, context long, a int, b int")

    per_text = places.join(runs, ["gram", "context"]).select(
        "k1", "k2", F.explode("places").alias("place"), "a", "b").groupBy("k1", "k2").agg(F.collect_list(F.struct(
            (F.col("place") + F.col("a")).alias("a"), (F.col("place") + F.col("b")).alias("b"))).alias("runs"))
    single = classes.filter(F.col("copies") == 1).select("k1", "k2", "name")
    left = packed.join(single.join(per_text, ["k1", "k2"]), ["k1", "k2", "name"]).select("k1", "k2", "text", "runs").mapInPandas(
        lean(_covered(length)), "k1 long, k2 long, removed long, spans array<array<int>>, sha string")
    rows = base.alias("d").join(classes.alias("c").select("k1", "k2", "copies"), ["k1", "k2"]).join(
        left.select("k1", "k2", "removed", "spans", F.col("sha").alias("left_sha")), ["k1", "k2"], "left")
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    all_of_it = F.array(F.array(F.lit(0), F.col("n_bytes").cast("int")))
    spans = F.when(whole, all_of_it).otherwise(F.coalesce("spans", F.array().cast("array<array<int>>")))
    return rows.select(
        F.col("id").alias(id_col), "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.size(spans).cast("long").alias("n_spans"),
        F.when(whole, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("left_sha", "sha")).alias("kept_sha256"),
        spans.alias("spans"))
