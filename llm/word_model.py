"""Language-model scoring: an interpolated modified Kneser-Ney model of word bigrams, kept in sorted arrays.

Counting and scoring move packed lists of distinct bigrams, never tokens:

1. Words. Training words (64-bit hashes, A-Z in lower case) are counted and dealt to buckets by their leading bits. A
   bucket's sorted hashes are an array file; a word's number is its bucket and its place there.
2. Bigrams. The tasks that read a chunk (an input block) map the word files and list the chunk's distinct bigrams of known
   words, as pairs of numbers, with their counts in training text. Lists are cut into shards (by the first word, and
   by the second in as many ways as the first word's count asks for, four at least, so that no frequent word fills a
   shard), sorted, delta coded and compressed.
3. Model. The task of a shard merges its lists to a sorted array of bigrams and one of counts, stores both as files, maps
   them, and answers every chunk's list with counts. It also sums what the words need: total and kinds of followers by first
   word, number of different predecessors by second word.
4. Word tables. Per bucket: sum of followers, weight of the lower order, and the unigram probability

       p1(w) = max(k(w) - d(k(w)), 0) / K + g / (V + 1)        k: different predecessors, K: all bigrams, V: words

   with the rest g going to V words and one unknown word alike.
5. Scores. The chunk is read again and gets its counts back from one file of the chunk; words are looked up in mapped files.

       p(w | h) = max(c(hw) - D(c(hw)), 0) / c(h.) + gamma(h) * p1(w),     gamma(h) = (D1 N1(h) + D2 N2(h) + D3 N3(h)) / c(h.)

   An unknown or last word as h leaves p1(w). A text starts after a start sign and ends with an end token. D1, D2, D3 come
   from the counts of counts of all bigrams, d1, d2, d3 from those of k.

Files lie in the folder in ``spark.checkpoint.dir``, which every worker has to see as a path (a mounted share, file://);
they are written under another name and then renamed, so a repeated task does no harm. A worker's memory holds one chunk's
word numbers and one shard, whatever the input; files are mapped, not read.

Defined cases: a null or empty text is an end token alone; a null id counts as the empty id; repeated rows are rows like
others; without training rows all probabilities are 1 and all words unknown; an empty table gives an empty result; other
columns are ignored. Documents that don't come from files are stored first, since a chunk is read twice alike.
"""

from __future__ import annotations

import hashlib
import math
import os
import pickle
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import durable, lean, stage_folder
from llm.shingles import mix
from llm.terms import WORDS, Runs, runs, summed

BUCKET = 1 << 16  # words of a bucket, on average
ROOM = 17  # bits of a place in a bucket
SHARD = 3_000_000  # tokens of a shard, on average
SPREAD = 4  # ways of a first word's followers at least; a way has at most 1 / SPREAD of a shard's tokens
PARTS = 4_000_000  # entries gathered before they are merged
END = np.uint64(0)  # the end token's hash
START, UNKNOWN = np.int64(2**32 - 1), np.int64(2**32 - 2)  # numbers of no word


# ---------------------------------------------------------------- files

def local_path(folder: str) -> str:
    if folder.startswith("file:"):
        return "/" + folder[5:].lstrip("/")
    if "://" in folder:
        raise ValueError(f"workers map the model's files: {folder} has to be a mounted folder")
    return folder


def store(path: str, write: Callable) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    own = f"{path}.{uuid.uuid4().hex}"
    with open(own, "wb") as out:
        write(out)
    os.replace(own, path)


def mapped(path: str) -> np.ndarray:
    return np.load(path, mmap_mode="r")


def pack(values: np.ndarray) -> bytes:
    """Integers, equal bytes of all side by side and compressed."""
    import zstandard

    values = np.ascontiguousarray(values)
    return zstandard.ZstdCompressor(level=1).compress(values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes())


def unpack(data: bytes, kind: type, n: int) -> np.ndarray:
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8) if n else np.zeros(0, np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, n).T).view(kind).reshape(n)


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=values.dtype.type(0)))


def unpack_sorted(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpack(data, np.int64, n))


def in_groups(run: Callable, *keys: str):
    """``run(key, frames)`` for each stretch of rows with the same key; rows arrive sorted by it."""
    def wrapped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, frames = None, []
        for batch in batches:
            for key, rows in batch.groupby(list(keys), sort=False):
                if key != held and frames:
                    yield run(held, frames)
                    frames = []
                held = key
                frames.append(rows)
        if frames:
            yield run(held, frames)
    return wrapped


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    return df.repartition(keys[0]).sortWithinPartitions(*keys)


# ---------------------------------------------------------------- tokens

def tokens(found: Runs, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, each text's words and its end, and where each text's end stands."""
    sizes = np.bincount(found.owner, minlength=texts) + 1
    stops = np.cumsum(sizes) - 1
    out = np.full(int(sizes.sum()), END, np.uint64)
    inner = np.ones(len(out), bool)
    inner[stops] = False
    out[inner] = found.keys
    return out, stops


class Words:
    """The mapped word files of a model with ``total`` tokens in ``shards`` shards."""

    def __init__(self, folder: str, bits: int, shards: int, total: int) -> None:
        self.folder, self.bits, self.shards, self.total, self.files = folder, bits, shards, total, {}

    def file(self, kind: str, bucket: int) -> np.ndarray:
        if (kind, bucket) not in self.files:
            self.files[kind, bucket] = mapped(f"{self.folder}/{kind}/{bucket}.npy")
        return self.files[kind, bucket]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The numbers of sorted hashes, or ``UNKNOWN``."""
        out = np.full(len(hashes), UNKNOWN, np.int64)
        buckets = bucket_of(hashes, self.bits)
        for a, b in _stretches(buckets):
            path = f"{self.folder}/hash/{buckets[a]}.npy"
            if ("hash", int(buckets[a])) not in self.files and not os.path.exists(path):
                continue  # no training word there
            known = self.file("hash", int(buckets[a]))
            at = np.minimum(np.searchsorted(known, hashes[a:b]), len(known) - 1)
            out[a:b] = np.where(known[at] == hashes[a:b], (buckets[a] << ROOM) + at, UNKNOWN)
        return out

    def of_texts(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per slice: the numbers of all tokens, and where each text ends."""
        for first, stop, found in runs(texts, WORDS):
            hashes, stops = tokens(found, stop - first)
            distinct, back = np.unique(hashes, return_inverse=True)
            yield self.numbers(distinct)[back], stops

    def look_up(self, kind: str, numbers: np.ndarray) -> np.ndarray:
        """Rows of a word table for sorted numbers of known words."""
        buckets, out = numbers >> ROOM, []
        for a, b in _stretches(buckets):
            out.append(np.asarray(self.file(kind, int(buckets[a]))[numbers[a:b] & ((1 << ROOM) - 1)]))
        return np.concatenate(out) if out else np.zeros(0)


def bucket_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


def _stretches(sorted_values: np.ndarray) -> Iterator[tuple[int, int]]:
    if len(sorted_values):
        cuts = np.flatnonzero(np.diff(sorted_values)) + 1
        yield from zip([0, *cuts.tolist()], [*cuts.tolist(), len(sorted_values)])


def pairs(numbers: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """The bigram that ends at each token, first word above the second; -1 where a word is unknown."""
    before = np.append(START, numbers[:-1])
    before[np.append(0, stops[:-1] + 1)] = START
    return np.where((before == UNKNOWN) | (numbers == UNKNOWN), -1, (before << 32) | numbers)  # START's sign bit is of no matter


def spreads(words: Words, firsts: np.ndarray) -> np.ndarray:
    """In how many ways the followers of each first word are dealt: by its count in training text, so that no way has
    more than ``1 / SPREAD`` of a shard's tokens on average. A start is counted like the end token."""
    distinct, back = np.unique(firsts, return_inverse=True)
    starts = distinct == START
    counts = np.zeros(len(distinct), np.int64)
    counts[~starts] = words.look_up("count", distinct[~starts])
    if starts.any():
        end = words.numbers(np.array([END]))
        counts[starts] = words.look_up("count", end)[0] if end[0] != UNKNOWN else 0
    return np.maximum(SPREAD, -(-SPREAD * words.shards * counts // max(words.total, 1)))[back].astype(np.uint64)


def shard_of(words: Words, bigrams: np.ndarray) -> np.ndarray:
    low = (bigrams & 0xFFFFFFFF).astype(np.uint64)
    first = bigrams >> 32 & 0xFFFFFFFF
    way = mix(low, np.uint64(5)) % spreads(words, first)
    return (mix(first.astype(np.uint64), way) % np.uint64(words.shards)).astype(np.int64)


def by_shard(words: Words, bigrams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of sorted bigrams by shard, and the bounds of the shards in it."""
    of = shard_of(words, bigrams)
    by = np.argsort(of, kind="stable")
    return by, np.searchsorted(of[by], np.arange(words.shards + 1))


# ---------------------------------------------------------------- 1. words

def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    parts, size = [], 0
    for batch in batches:
        for first, stop, found in runs(batch["text"].tolist(), WORDS):
            hashes, _ = tokens(found, stop - first)
            parts.append(summed(hashes, np.ones(len(hashes), np.int64)))
            size += len(parts[-1][0])
            if size > PARTS:
                parts = [_merged(parts)]
                size = len(parts[0][0])
                if size > PARTS:
                    yield pd.DataFrame({"word": parts[0][0].view(np.int64), "c": parts[0][1]})
                    parts, size = [], 0
    if parts:
        words, counts = _merged(parts)
        yield pd.DataFrame({"word": words.view(np.int64), "c": counts})


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    return summed(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))


def _store_words(folder: str):
    def run(bucket: tuple, frames: list[pd.DataFrame]) -> pd.DataFrame:
        words = np.concatenate([f["word"].to_numpy() for f in frames]).view(np.uint64)
        counts = np.concatenate([f["c"].to_numpy() for f in frames])
        by = np.argsort(words)
        if len(words) > 1 << ROOM:
            raise ValueError("a bucket of words is too full: words are not dealt evenly")
        store(f"{folder}/hash/{bucket[0]}.npy", lambda out: np.save(out, words[by]))
        store(f"{folder}/count/{bucket[0]}.npy", lambda out: np.save(out, counts[by]))
        return pd.DataFrame({"bucket": [bucket[0]], "n": [len(words)]})
    return run


# ---------------------------------------------------------------- 2. bigrams

def _list_pairs(folder: str, bits: int, shards: int, total: int):
    def rows(words: Words, chunk: str, parts: list) -> pd.DataFrame:
        keys, counts = _merged(parts) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        by, cuts = by_shard(words, keys)
        out = []
        for shard in np.flatnonzero(np.diff(cuts)).tolist():
            at = by[cuts[shard]:cuts[shard + 1]]
            out.append((shard, chunk, len(at), pack_sorted(keys[at]), pack(counts[at])))
        return pd.DataFrame(out, columns=["shard", "chunk", "n", "keys", "counts"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, chunk, parts, size = Words(folder, bits, shards, total), None, [], 0
        for batch in batches:
            for (this, train), group in batch.groupby(["chunk", "train"], sort=False):
                if this != chunk and chunk is not None:
                    yield rows(words, chunk, parts)
                    parts, size = [], 0
                chunk = this
                for numbers, stops in words.of_texts(group["text"].tolist()):
                    keys = pairs(numbers, stops)
                    keys = keys[keys != -1]
                    parts.append(summed(keys, np.full(len(keys), int(train))))
                    size += len(parts[-1][0])
                    if size > PARTS:
                        parts = [_merged(parts)]
                        size = len(parts[0][0]) // 2  # merged again when as much is new
        if chunk is not None:
            yield rows(words, chunk, parts)
    return run


# ---------------------------------------------------------------- 3. model

ANSWER, FIRST, SECOND, KINDS = 0, 1, 2, 3
MADE = "kind int, chunk string, part long, n long, data binary, ones long, twos long, threes long, fours long"


def kinds(counts: np.ndarray) -> list[int]:
    return [int((counts == i).sum()) for i in (1, 2, 3, 4)]


def _by_bucket(kind: int, numbers: np.ndarray, columns: list[np.ndarray]) -> list[tuple]:
    """Sorted numbers with their columns, a row for each bucket; START's is -1."""
    buckets = np.where(numbers == START, -1, numbers >> ROOM)
    by = np.argsort(buckets, kind="stable")
    out = []
    for a, b in _stretches(buckets[by]):
        at = by[a:b]
        data = pickle.dumps([pack_sorted(numbers[at]), *(pack(c[at]) for c in columns)])
        out.append((kind, None, int(buckets[at[0]]), b - a, data, 0, 0, 0, 0))
    return out


def _merge_shard(folder: str):
    def run(key: tuple, frames: list[pd.DataFrame]) -> pd.DataFrame:
        lists, counts = [], []
        for frame in frames:
            for n, data, own in zip(frame["n"], frame["keys"], frame["counts"]):
                lists.append(unpack_sorted(data, n))
                counts.append(unpack(own, np.int64, n))
        keys, count = summed(np.concatenate(lists), np.concatenate(counts))
        keys, count = keys[count > 0], count[count > 0]
        store(f"{folder}/bigram/{key[0]}.npy", lambda out: np.save(out, keys))
        store(f"{folder}/bigram-count/{key[0]}.npy", lambda out: np.save(out, count.astype(np.uint32) if count.max(initial=0) < 2**32 else count))
        known, known_count = mapped(f"{folder}/bigram/{key[0]}.npy"), mapped(f"{folder}/bigram-count/{key[0]}.npy")
        out = [(KINDS, None, 0, len(keys), b"", *kinds(count))]
        chunks = [c for frame in frames for c in frame["chunk"]]
        for chunk, own in zip(chunks, lists):
            answer = np.zeros(len(own), np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                answer = np.where(known[at] == own, known_count[at], 0).astype(np.int64)
            out.append((ANSWER, chunk, key[0], len(own), pack(answer), 0, 0, 0, 0))
        firsts = keys >> 32 & 0xFFFFFFFF
        starts = np.flatnonzero(np.append(True, firsts[1:] != firsts[:-1])) if len(keys) else np.zeros(0, np.int64)
        if len(keys):
            sums = [np.add.reduceat(x.astype(np.int64), starts) for x in (count, count == 1, count == 2, count > 2)]
            by = np.argsort(firsts[starts])
            out += _by_bucket(FIRST, firsts[starts][by], [s[by] for s in sums])
            seconds, different = summed(keys & 0xFFFFFFFF, np.ones(len(keys), np.int64))
            out += _by_bucket(SECOND, seconds, [different])
        return pd.DataFrame(out, columns=[c.split()[0] for c in MADE.split(", ")])
    return run


# ---------------------------------------------------------------- 4. word tables

def _sum_words(folder: str):
    """Per bucket: followers, their kinds, and predecessors of its words, in rows of arrays. Rows arrive sorted by bucket and are
    added one by one, so that only one bucket's sums are held, however many shards there are."""
    def summary(part: int, table: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"part": [part], "n": [table.shape[1]], "data": [pack(table.ravel())], "total": [int(table[4].sum())],
                             **{name: [v] for name, v in zip(("ones", "twos", "threes", "fours"), kinds(table[4]))}})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, table = None, None
        for batch in batches:
            for part, kind, n, data in zip(batch["part"], batch["kind"], batch["n"], batch["data"]):
                if part != held:
                    if table is not None:
                        yield summary(held, table)
                    held, table = part, np.zeros((5, 1 if part < 0 else len(mapped(f"{folder}/hash/{part}.npy"))), np.int64)
                numbers, *columns = pickle.loads(data)
                at = unpack_sorted(numbers, n) & ((1 << ROOM) - 1) if part >= 0 else np.zeros(n, np.int64)
                for row, column in zip(range(4) if kind == FIRST else [4], columns):
                    table[row, at] += unpack(column, np.int64, n)
        if table is not None:
            yield summary(held, table)
    return run


def discounts(ones: int, twos: int, threes: int, fours: int) -> list[float]:
    """D1, D2, D3 by counts of counts; an order with too few of them falls back on fixed ones."""
    n, out = [ones, twos, threes, fours], [0.0]
    ratio = ones / (ones + 2 * twos) if ones else 0.0
    for i in (1, 2, 3):
        d = i - (i + 1) * ratio * n[i] / n[i - 1] if n[i - 1] and ones else 0.5 * i
        out.append(min(max(d, 0.05), i - 0.05))
    return out


def _store_tables(folder: str, high: list[float], low: list[float], all_bigrams: int, rest: float, vocabulary: int):
    """Word tables (words x 3): sum of followers, weight of the lower order, unigram probability."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, n, data in zip(batch["part"], batch["n"], batch["data"]):
                total, ones, twos, more, before = unpack(data, np.int64, 5 * n).reshape(5, n)
                gamma = (high[1] * ones + high[2] * twos + high[3] * more) / np.maximum(total, 1)
                p1 = (before - np.array(low)[np.minimum(before, 3)]) / max(all_bigrams, 1) + rest / (vocabulary + 1)
                table = np.stack([total, np.where(total > 0, gamma, 1.0), p1], 1)
                store(f"{folder}/table/{part}.npy", lambda out: np.save(out, table))
            yield pd.DataFrame({"part": batch["part"]})
    return run


# ---------------------------------------------------------------- 5. scores

def chunk_file(folder: str, chunk: str) -> str:
    name = hashlib.sha256(chunk.encode()).hexdigest()
    return f"{folder}/chunk/{name[:2]}/{name}"


def _store_answers(folder: str):
    def run(key: tuple, frames: list[pd.DataFrame]) -> pd.DataFrame:
        answers = {p: (n, bytes(d)) for f in frames for p, n, d in zip(f["part"], f["n"], f["data"])}
        store(chunk_file(folder, key[0]), lambda out: pickle.dump(answers, out))
        return pd.DataFrame({"chunk": [key[0]]})
    return run


def _score(folder: str, bits: int, shards: int, high: list[float], unknown: float, total: int, vocabulary: int):
    def counts_of(words: Words, chunk: str, bigrams: np.ndarray) -> np.ndarray:
        """The counts of a chunk's distinct bigrams, from its file."""
        counts = np.zeros(len(bigrams), np.int64)
        if not len(bigrams):
            return counts
        with open(chunk_file(folder, chunk), "rb") as held:
            answers = pickle.load(held)
        by, cuts = by_shard(words, bigrams)
        for shard in np.flatnonzero(np.diff(cuts)).tolist():
            at = by[cuts[shard]:cuts[shard + 1]]
            n, data = answers.get(shard, (-1, b""))
            if n != len(at):
                raise ValueError("a chunk was read in other blocks than before; store the documents first")
            counts[at] = unpack(data, np.int64, n)
        return counts

    def scored(words: Words, numbers: np.ndarray, stops: np.ndarray, bigrams: np.ndarray, counts: np.ndarray) -> tuple:
        distinct, at = np.unique(numbers, return_inverse=True)
        known = distinct < UNKNOWN
        table, seen = np.tile([0.0, 1.0, unknown], (len(distinct), 1)), np.zeros(len(distinct), np.int64)
        if known.any():
            table[known], seen[known] = words.look_up("table", distinct[known]), words.look_up("count", distinct[known])
        first = np.append(0, stops[:-1] + 1)
        before = np.roll(table[at, :2], 1, 0)
        before[first] = words.file("table", -1)[0, :2] if total else [0.0, 1.0]
        keys = pairs(numbers, stops)
        c = np.zeros(len(keys), np.int64)
        c[keys != -1] = counts[np.searchsorted(bigrams, keys[keys != -1])]
        p = np.where(c > 0, (c - np.array(high)[np.minimum(c, 3)]) / np.maximum(before[:, 0], 1), 0.0) + before[:, 1] * table[at, 2]
        seen = seen[at]
        base = np.log10((seen + 0.5) / (total + 0.5 * (vocabulary + 1)))
        return (np.diff(np.append(-1, stops)), np.add.reduceat((seen > 0).astype(np.int64), first), np.add.reduceat(base, first),
                np.add.reduceat(np.log10(p), first))

    def result(words: Words, chunk: str, names: list, parts: list[tuple[np.ndarray, np.ndarray]]) -> pd.DataFrame:
        found = [np.unique(pairs(numbers.astype(np.int64), stops)) for numbers, stops in parts]
        bigrams = np.unique(np.concatenate(found))
        bigrams = bigrams[bigrams != -1]
        counts = counts_of(words, chunk, bigrams)
        columns = zip(*(scored(words, numbers.astype(np.int64), stops, bigrams, counts) for numbers, stops in parts))
        return pd.DataFrame({"id": names} | dict(zip(("n_tokens", "n_known", "base_score", "score"), map(np.concatenate, columns))))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, chunk, names, parts = Words(folder, bits, shards, total), None, [], []
        for batch in batches:
            for this, group in batch.groupby("chunk", sort=False):
                if this != chunk and names:
                    yield result(words, chunk, names, parts)
                    names, parts = [], []
                chunk = this
                names += group["id"].tolist()
                parts += [(numbers.astype(np.uint32), stops) for numbers, stops in words.of_texts(group["text"].tolist())]
        if names:
            yield result(words, chunk, names, parts)
    return run


def score_texts(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per row of ``docs``.

    ``held_out``: a condition on the rows that the model doesn't learn from; ``base_score`` is that of single words with half a
    count more, ``score`` the model's log10 probability."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                       F.coalesce(held_out, F.lit(False)).alias("held_out"))
    if rows.select(F.input_file_name().alias("name")).filter("name = ''").limit(1).count():
        rows = durable(rows, "documents")
    block = F.concat_ws(":", F.input_file_name(), F.input_file_block_start())
    rows = rows.select("id", "text", "held_out", block.alias("chunk"))
    folder = f"{local_path(stage_folder(spark))}/bigrams-{uuid.uuid4().hex}"

    words = durable(rows.filter("NOT held_out").select("text").mapInPandas(lean(_count_words), "word long, c long")
                    .groupBy("word").agg(F.sum("c").alias("c")), "words")
    vocabulary, total = words.agg(F.count("*"), F.coalesce(F.sum("c"), F.lit(0))).first()
    bits = max(0, math.ceil(math.log2(max(vocabulary, 1) / BUCKET)))
    bucket = F.shiftrightunsigned("word", 64 - bits) if bits else F.lit(0).cast("long")
    durable(dealt(words.withColumn("bucket", bucket), "bucket").mapInPandas(
        lean(in_groups(_store_words(folder), "bucket")), "bucket long, n long"), "stored")

    shards = max(1, math.ceil(total / SHARD))
    lists = rows.select("chunk", (~F.col("held_out")).alias("train"), "text").mapInPandas(
        lean(_list_pairs(folder, bits, shards, total)), "shard long, chunk string, n long, keys binary, counts binary")
    made = durable(dealt(lists, "shard", "chunk").mapInPandas(lean(in_groups(_merge_shard(folder), "shard")), MADE), "model")
    n = made.filter(F.col("kind") == KINDS).agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("ones", "twos", "threes", "fours", "n"))).first()
    high, all_bigrams = discounts(*n[:4]), n[4]
    tables = durable(dealt(made.filter(F.col("kind").isin(FIRST, SECOND)).select("part", "kind", "n", "data"), "part").mapInPandas(
        lean(_sum_words(folder)),
        "part long, n long, data binary, total long, ones long, twos long, threes long, fours long"), "tables")
    k = tables.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("ones", "twos", "threes", "fours"))).first()
    low = discounts(*k)
    rest = 1.0 if not all_bigrams else (low[1] * k[0] + low[2] * k[1] + low[3] * (vocabulary - k[0] - k[1])) / all_bigrams
    durable(tables.mapInPandas(lean(_store_tables(folder, high, low, all_bigrams, rest, vocabulary)), "part long"), "stored")
    durable(dealt(made.filter(F.col("kind") == ANSWER).select("chunk", "part", "n", "data"), "chunk").mapInPandas(
        lean(in_groups(_store_answers(folder), "chunk")), "chunk string"), "answers")

    scored = rows.select("chunk", F.concat_ws(":", F.col("held_out").cast("int"), F.coalesce("id", F.lit(""))).alias("id"), "text").mapInPandas(
        lean(_score(folder, bits, shards, high, rest / (vocabulary + 1), total, vocabulary)),
        "id string, n_tokens long, n_known long, base_score double, score double")
    name = F.substring("id", 3, 1 << 30)
    return scored.select(F.when(name != "", name).cast(docs.schema[id_col].dataType).alias(id_col), F.col("id").startswith("1").alias("held_out"),
                         "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
