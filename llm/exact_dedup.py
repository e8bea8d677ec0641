"""Exact deduplication: equal texts find their owner in Patricia tries over whole byte strings.

1. Each task inserts the normalised texts of its rows into tries, so that copies it holds meet before any shuffle. One
   row a task and text (a local owner) goes on with the text, its best document and a count, both known when the task
   gives the trie up; every document remembers its local owner.
2. The local owners are dealt out by byte length and content hash, the only shuffle of texts. Tasks insert the full byte
   strings into one trie a partition; a terminal node keeps the best document so far and the count. A trie over
   ``SPILL_BYTES`` spills its largest subtrees: their entries go to a scratch file of the task and are inserted again,
   subtree by subtree.
3. Documents join their local owner's result. A group of any size is spread over the tasks that read it, and each of
   them sends one copy of the text.

Defined cases: a null text is an empty one; all texts without a word are equal; repeated rows count one by one, and one of
them is kept; a null id comes last; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import pickle
import tempfile
from collections.abc import Callable, Iterator
from itertools import count

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import SPACES, durable, lean

SPILL_BYTES = 96_000_000
LOCAL_BYTES = 48_000_000
#: What an entry of a local trie takes besides its text, and the texts that a task hands on at once.
ENTRY_BYTES = 300
SLICE_BYTES = 4_000_000

#: Documents (n is 0), and local owners with their text, best row and number of rows.
LOCAL = "id long, none boolean, sha string, owner long, row long, points long, text binary, n long"
FOUND = "owner long, keep_id long, keep_none boolean, keep_row long, group_size long"


class Node:
    """An edge label with what lies below it: children by first byte, and the entry of the string that ends here."""

    __slots__ = ("label", "children", "entry", "owned")

    def __init__(self, label: bytes, entry=None) -> None:
        self.label, self.children, self.entry, self.owned = label, {}, entry, None


def _common(a: bytes, b: bytes, at: int) -> int:
    """Length of the common beginning of ``a`` and ``b[at:]``."""
    low, high = 0, min(len(a), len(b) - at)
    if a[:high] == b[at:at + high]:
        return high
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[at + low:at + mid]:
            low = mid
        else:
            high = mid
    return low


class Trie:
    """A compressed radix trie. ``insert`` returns the entry of the string, made by ``new`` if there was none."""

    def __init__(self) -> None:
        self.root, self.bytes = Node(b""), 0

    def insert(self, text: bytes, new: Callable):
        node, at = self.root, 0
        while at < len(text):
            child = node.children.get(text[at])
            if child is None:
                node.children[text[at]] = leaf = Node(text[at:], new())
                self.bytes += len(text) - at + 200
                return leaf.entry
            same = _common(child.label, text, at)
            if same < len(child.label):
                fork = Node(child.label[:same])
                child.label = child.label[same:]
                fork.children[child.label[0]] = child
                node.children[text[at]] = child = fork
                self.bytes += 200
            node, at = child, at + same
        if node.entry is None:
            node.entry = new()
        return node.entry

    def items(self, node: Node | None = None, prefix: bytes = b"") -> Iterator[tuple[bytes, object]]:
        stack = [(node or self.root, prefix)]
        while stack:
            node, prefix = stack.pop()
            prefix += node.label
            if node.entry is not None:
                yield prefix, node.entry
            stack += ((child, prefix) for child in node.children.values())


def _local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every row with the number of its text in this task (its local owner), and every local owner once.

    A full trie is given up and a new one begun: a text may then have several local owners, which meet later."""
    from pyspark import TaskContext

    base = TaskContext.get().partitionId() << 40
    number, rows, trie, made = count(base), count(base), Trie(), 0
    for batch in batches:
        owners, places = [], []
        for text, points, none, doc in zip(batch["text"], batch["points"].tolist(), batch["none"].tolist(), batch["id"].tolist()):
            row = (-points, none, doc, next(rows))
            entry = trie.insert(text.encode("utf-8", "surrogatepass"), lambda: [next(number), row, 0])
            entry[1], entry[2] = min(entry[1], row), entry[2] + 1
            made += entry[2] == 1
            owners.append(entry[0])
            places.append(row[3])
        yield batch.assign(owner=owners, row=places, text=None, n=0)
        if trie.bytes + ENTRY_BYTES * made > LOCAL_BYTES:
            yield from _given_up(trie)
            trie, made = Trie(), 0
    yield from _given_up(trie)


def _given_up(trie: Trie) -> Iterator[pd.DataFrame]:
    """The local owners of a trie, in slices."""
    out, size = [], 0
    for text, (owner, (points, none, doc, row), n) in trie.items():
        out.append((doc, none, None, owner, row, -points, text, n))
        size += len(text) + ENTRY_BYTES
        if size > SLICE_BYTES:
            yield _frame(out, LOCAL)
            out, size = [], 0
    yield _frame(out, LOCAL)


def _grouped(rows: Iterator[tuple[bytes, list]], limit: int) -> Iterator[list]:
    """Insert all rows into one trie and yield, for each string, the values of its rows.

    Past ``limit`` bytes the larger subtrees (by the two bytes after what all strings share) are spilled: their rows, and
    those that follow, go to scratch files, and each file is worked through in the same way afterwards."""
    trie, files, depths = Trie(), {}, set()
    with tempfile.TemporaryDirectory() as folder:
        for text, values in rows:
            # of several files the oldest: a string stays with the first file that took it
            spilled = min((files[text[:d]] for d in depths if text[:d] in files), default=None, key=lambda f: f[0])
            if spilled:
                pickle.dump((text, values), spilled[1])
                continue
            trie.insert(text, list).extend(values)
            if trie.bytes > limit:
                held = [*trie.items()]
                depth = len(os.path.commonprefix([min(held)[0], max(held)[0]])) + 2
                sizes: dict[bytes, int] = {}
                for data, _ in held:
                    if len(data) >= depth:
                        sizes[data[:depth]] = sizes.get(data[:depth], 0) + len(data)
                depths.add(depth)
                for key in sorted(sizes, key=sizes.get)[len(sizes) // 2:]:
                    files[key] = (len(files), open(f"{folder}/{len(files)}", "w+b"))
                trie = Trie()
                for data, old in held:
                    if data[:depth] in files:
                        pickle.dump((data, old), files[data[:depth]][1])
                    else:
                        trie.insert(data, list).extend(old)
        for _, values in trie.items():
            yield values
        del trie
        for _, file in files.values():
            yield from _grouped(_read(file), limit)
            file.close()


def _read(file) -> Iterator[tuple[bytes, list]]:
    file.seek(0)
    while True:
        try:
            yield pickle.load(file)
        except EOFError:
            return


def _owners(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each local owner, the best row of its text and the size of the text's group."""
    def rows():
        for batch in batches:
            for text, owner, points, none, doc, row, n in zip(batch["text"], *(batch[c].tolist() for c in (
                    "owner", "points", "none", "id", "row", "n"))):
                yield text, [(owner, (-points, none, doc, row), n)]

    out: list[tuple] = []
    for group in _grouped(rows(), SPILL_BYTES):
        _, none, doc, row = min(best for _, best, _ in group)
        total = sum(n for _, _, n in group)
        out += ((owner, doc, none, row, total) for owner, _, _ in group)
        if len(out) > 50_000:
            yield _frame(out, FOUND)
            out = []
    yield _frame(out, FOUND)


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    kinds = dict(c.split(" ") for c in schema.split(", "))
    as_numpy = {"long": "int64", "boolean": "bool", "string": "object", "binary": "object"}
    return pd.DataFrame(rows, columns=[*kinds]).astype({c: as_numpy[k] for c, k in kinds.items()})


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256): one row per row of ``docs``. Ids are whole numbers."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    plain = F.translate(text, SPACES, "")
    number = F.col(id_col).cast("long")  # a null goes as a flag: a column of numbers and nulls comes to tasks as doubles
    rows = docs.select(F.coalesce(number, F.lit(0)).alias("id"), number.isNull().alias("none"), F.length(text).cast("long").alias("points"),
                       F.sha2(plain, 256).alias("sha"), plain.alias("text"))
    local = durable(rows.mapInPandas(lean(_local), LOCAL), "dedup")
    found = local.filter("n > 0").select("owner", "text", "points", "none", "id", "row", "n").repartition(
        F.length("text"), F.xxhash64("text")).mapInPandas(lean(_owners), FOUND)
    return local.filter("n = 0").select("id", "none", "sha", "owner", "row").join(found, "owner").select(
        F.when(~F.col("none"), F.col("id")).alias(id_col), F.when(~F.col("keep_none"), F.col("keep_id")).alias("keep_id"), "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"), F.col("sha").alias("text_sha256"))
