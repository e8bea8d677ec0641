"""Each operator against brute force on a small table with all the odd cases: nulls, empty and long texts, ties, repeated
rows, clashing column names; on the empty table; and its helpers on random input."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import (chat, exact_dedup, kneser_ney, mixing, ngram_join, packing, quality_rules, suffix_array, suffix_dedup,
                 token_counts, token_files)
from llm.queries import tokenizer
from llm.shingles import exact_shingles

SCHEMA = "doc_id long, text string, lang string, source string, n string, cls string, token string, size string, label string"


def _words(rng, n):
    return " ".join("".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 6))) for _ in range(n))


def _texts():
    rng = random.Random(7)
    base = [_words(rng, n) for n in (3, 4, 40, 120, 300, 2500)]
    passage = _words(rng, 110)
    near = base[3].split(" ")
    near[10] = "changed"
    return [*base, None, "", "  \n", base[2], base[2].replace(" ", "\n"), " " + base[2], " ".join(near), base[3].upper(),
            base[0] + " " + passage + " end", "start " + passage, passage, "x " * 600, "<|endoftext|> it's <|im_end|> A　b \U0001F600",
            "\n".join(["same line here"] * 30), "a" * 3000, "### !! ### $$ " * 40, "one two", "ONE two"]


@pytest.fixture(scope="module")
def rows():
    texts = _texts()
    out = [(i, t, ("en", "de", None)[i % 3], ("a", "b", "B", None)[i % 4]) for i, t in enumerate(texts)]
    return out + [out[2], out[2], (None, texts[3], None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in rows], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _bag(items):
    return Counter(items)


def test_packing(docs, rows, empty):
    path = tokenizer("byte_bpe_50k.json")
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    want = Counter()
    total = 0
    for doc, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        total += len(ids)
        first = len(ids) % 100 or 100 if len(ids) > 100 else len(ids)
        bounds = [0, *range(first, len(ids) + 1, 100)]
        for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
            want[doc, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    packed = packing.pack(packing.token_pieces(docs, path, 100, 2, with_ids=True), 100)
    got = packed.collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for items in places.values():
        end = 0
        for offset, length in sorted(items):
            assert offset == end
            end += length
        assert end <= 100
    assert len(places) <= -(-total // 100) + 2
    for r in packing.sequences(packed).collect():
        assert len(r.ids) <= 100 and len(r.doc_ids) == len(r.starts)
    assert packing.pack(packing.token_pieces(empty, path, 100, 2), 100).count() == 0


@pytest.mark.parametrize("seed", range(30))
def test_packing_plan(seed):
    rng = random.Random(seed)
    capacity = rng.choice([1, 7, 30, 100])
    counts = {n: rng.randint(1, 50) for n in rng.sample(range(1, capacity + 1), rng.randint(1, capacity))}
    made = Counter()
    sequences = 0
    for many, items in packing.plan(counts, capacity):
        assert sum(n * each for n, each in items) <= capacity
        assert sum(each for n, each in items if 3 * n > capacity) <= 2
        sequences += many
        for n, each in items:
            made[n] += many * each
    assert made == counts
    # never worse than the guarantee of best fit decreasing
    assert sequences <= 11 / 9 * -(-sum(n * c for n, c in counts.items()) // capacity) + sum(c for n, c in counts.items() if 2 * n > capacity) + 1


def test_token_counts(docs, rows, empty):
    import sentencepiece

    path = tokenizer("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    want = _bag((d, len((t or "").encode()), len(library.encode(t or "")), len(library.encode(t or "")) > 500) for d, t, *_ in rows)
    assert _bag(map(tuple, token_counts.token_counts(docs, path, 500).collect())) == want
    assert token_counts.token_counts(empty, path, 500).count() == 0


def test_long_sequences_take_the_same_merges():
    import sentencepiece

    path = tokenizer("piece_bpe_32k.model")
    library, mine = sentencepiece.SentencePieceProcessor(model_file=path), token_counts.MergeCounter(path)
    rng = random.Random(1)
    texts = ["".join(rng.choice("etaoinshr ") for _ in range(n)) for n in (399, 400, 401, 3000)] + ["the" * 400, " " * 900, "ab" * 700]
    assert mine.counts(texts).tolist() == [len(library.encode(t)) for t in texts]


def test_pre_tokens_are_the_librarys():
    from llm.byte_bpe import encoder

    mine = encoder(tokenizer("byte_bpe_50k.json"))
    rng = random.Random(2)
    signs = "ab'stredvml  \n\t\x1c\x85\xa0é1²Ⅷ中ا!-_<|endoftext|>　\U00018dda"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    got = [p.tolist() for _, ids, counts in mine.encode(texts) for p in np.split(ids, np.cumsum(counts)[:-1])]
    assert got == [e.ids for e in mine.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_token_files(spark, docs, rows, empty, tmp_path):
    from tokenizers import Tokenizer

    path = tokenizer("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    want, start = [], 0
    for doc, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    for k, width in enumerate((2, 4)):
        token_files.write_tokens(docs, f"{tmp_path}/{k}", path, 2, width)
        got = token_files.read_tokens(spark, f"{tmp_path}/{k}", with_ids=True).orderBy("start").collect()
        assert [tuple(r) for r in got] == want
    token_files.write_tokens(empty, f"{tmp_path}/none", path, 2)
    assert token_files.read_tokens(spark, f"{tmp_path}/none").count() == 0


def test_mix(docs, rows, empty):
    got = mixing.mix(docs, [5, 2, 1]).collect()
    size = {t: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, *_ in rows}
    assert Counter((r.doc_id, r.size) for r in got) == Counter((d, size[t]) for d, t, *_ in rows)
    have = Counter()
    for _, t, _, s in rows:
        have[s] += size[t]
    order = sorted(have, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, open_, rest = {}, set(order), sum(have.values())
    while open_:
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] >= 3 * have[s]}
        for s in over or open_:
            target[s] = 3 * have[s] if s in over else share[s]
        rest -= sum(3 * have[s] for s in over)
        open_ = open_ - over if over else set()
    by_target = defaultdict(int)
    largest = max(size.values())
    for r in got:
        assert r.taken <= 3 * r.size and (not r.size or r.taken % r.size == 0)
        by_target[round(r.target, 6), r.source_size] += r.taken
    assert {k[0] for k in by_target} == {round(t, 6) for t in target.values()}
    for (t, _), words in by_target.items():
        assert abs(words - t) <= largest
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(5), [5, 2, 1]).collect()))
    assert mixing.mix(empty, [5, 2, 1]).count() == 0


def test_mix_with_document_weights(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.lit("s").alias("source"),
                                    F.when(F.col("id") < 1000, 3.0).otherwise(1.0).alias("w"))
    extra = docs.withColumn("source", F.lit("t")).withColumn("doc_id", F.col("doc_id") + 5000)
    got = mixing.mix(docs.unionByName(extra), [3, 5], weight_col="w").filter("doc_id < 5000").groupBy((F.col("doc_id") < 1000).alias("h")).agg(
        F.avg(F.col("taken") / F.col("size")).alias("c")).collect()
    mean = {r.h: r.c for r in got}
    assert mean[True] / mean[False] == pytest.approx(3, rel=0.15)


def test_chat_round_trip(spark, empty):
    said = "<|im_end|><|im_start|>assistant ok <|| <| <"
    turns = [(1, 0, "user", said), (1, 1, "assistant", said), (1, 1, "assistant", None), (None, None, None, "x"), (2, 3, "a\nb<|", "é")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.digests(chat.format_chat(df)).collect()}
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1].turns_sha256 == digest(f"user\n{said}\nassistant\n\nassistant\n{said}\n")
    assert (got[1].loss_sha256, got[1].loss_chars, got[1].n_turns) == (digest(said), len(said), 3)
    assert got[None].turns_sha256 == digest("\nx\n") and got[2].turns_sha256 == digest("a\nb<|\né\n")
    assert chat.digests(chat.format_chat(df.limit(0))).count() == 0


def test_chat_parts(spark):
    parts = ('[{"type": "text", "text": "see <|image|>"}, {"type": "image", "ref": "i1", "width": 28, "height": 15}, {"type": "document",'
             ' "ref": "d", "pages": 2, "parts": ["in", {"type": "audio", "ref": "s", "seconds": 1.5}]}]')
    df = spark.createDataFrame([(1, 0, "user", None, parts)], "conv_id long, turn long, role string, text string, parts string")
    r = chat.format_chat(df, parts_col="parts").first()
    assert r.formatted == "<|im_start|>user\nsee <||image|><|image|><|document|>in<|audio|><|im_end|>\n"
    assert [(a.kind, a.ref, a.tokens) for a in r.attachments] == [("image", "i1", 4), ("document", "d", 512), ("audio", "s", 38)]
    assert all(r.formatted[a["at"]:].startswith(f"<|{a.kind}|>") for a in r.attachments) and r.attachment_tokens == 554


def test_exact_dedup(docs, rows, empty):
    groups = defaultdict(list)
    for d, t, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), d is None, d or 0, d))
    want = Counter()
    for text, members in groups.items():
        best = min(members)[3]
        first = True
        for _, _, _, d in members:
            kept = d == best and first
            first = first and not kept
            want[d, best, len(members), kept, hashlib.sha256(text.encode()).hexdigest()] += 1
    assert _bag(map(tuple, exact_dedup.exact_groups(docs).collect())) == want
    assert exact_dedup.exact_groups(empty).count() == 0


def test_exact_dedup_large_ids_beside_null(spark):
    big = 2 ** 53 + 1
    df = spark.createDataFrame([(big, "a b"), (None, "a b"), (big + 1, "a  b"), (None, "c"), (-big, "c")], "doc_id long, text string")
    got = _bag((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(df.coalesce(1)).collect())
    assert got == _bag([(big, big + 1, 3, False), (None, big + 1, 3, False), (big + 1, big + 1, 3, True), (None, -big, 2, False),
                        (-big, -big, 2, True)])


def test_exact_dedup_shuffles_texts_once(spark, docs):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = spark._jvm.PythonSQLUtils.explainString(exact_dedup.exact_groups(docs)._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    dealt = re.findall(r"^\(\d+\) Exchange.*\nInput.*: (.*)$", plan, re.M)
    assert len(dealt) >= 3 and sum("text#" in columns for columns in dealt) == 1


def test_exact_dedup_gives_up_full_tries(monkeypatch):
    import pandas as pd
    import pyspark

    rng = random.Random(5)
    texts = ["".join(rng.choice("ab\ud800é") for _ in range(rng.randint(0, 4))) for _ in range(900)]
    rows = pd.DataFrame({"id": [i % 7 for i in range(900)], "none": [i % 7 == 0 for i in range(900)], "sha": "s",
                         "points": [i % 5 for i in range(900)], "text": texts})
    monkeypatch.setattr(pyspark.TaskContext, "get", lambda: type("At", (), {"partitionId": lambda self: 3})())
    monkeypatch.setattr(exact_dedup, "SLICE_BYTES", 2000)
    for limit, several in ((20_000, True), (10**9, False)):
        monkeypatch.setattr(exact_dedup, "LOCAL_BYTES", limit)
        out = pd.concat([*exact_dedup._local(iter([rows[k:k + 100] for k in range(0, 900, 100)]))])
        members, owners = out[out.n == 0], out[out.n > 0].set_index("owner")
        assert len(members) == 900 and owners.index.is_unique and {*members.owner} == {*owners.index}
        assert (len(owners) > len({*texts})) == several
        held = defaultdict(list)
        for text, r in zip(texts, members.itertuples()):
            assert owners.text[r.owner] == text.encode("utf-8", "surrogatepass")
            held[r.owner].append((-r.points, r.none, r.id, r.row))
        assert all((-o.points, o.none, o.id, o.row, o.n) == (*min(held[k]), len(held[k])) for k, o in owners.iterrows())


def test_trie_spills_subtrees():
    rng = random.Random(3)
    texts = [b"common start " + bytes(rng.choice(b"ab\xff") for _ in range(rng.randint(0, 12))) for _ in range(3000)] + [b"", b"c"]
    want = Counter(texts)
    for limit in (500, 20_000, 10**9):
        got = [sorted(g) for g in exact_dedup._grouped(iter((t, [(t, i)]) for i, t in enumerate(texts)), limit)]
        assert Counter({g[0][0]: len(g) for g in got}) == want and len(got) == len(want)
        assert all(len({t for t, _ in g}) == 1 for g in got)


def _components(sets, percent):
    low = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = low[i], low[j]
                low = [min(x, y) if v in (x, y) else v for v in low]
    return low


@pytest.mark.parametrize("percent", [85, 50])
def test_ngram_join(docs, rows, empty, percent):
    ids = [r[0] for r in rows]
    sets = [exact_shingles(t or "", 4) for _, t, *_ in rows]
    low = _components(sets, percent)
    group = defaultdict(list)
    for i, c in enumerate(low):
        group[c].append(ids[i])
    want = Counter()
    for i, s in enumerate(sets):
        known = [x for x in group[low[i]] if x is not None]
        want[ids[i], len(s), (min(known) if known else None) if s else ids[i]] += 1
    assert _bag(map(tuple, ngram_join.similar_groups(docs, 4, percent).collect())) == want
    assert ngram_join.similar_groups(empty, 4, percent).count() == 0


def test_ngram_join_of_many_near_copies(spark):
    """Copies of a text that isn't there itself, each with words changed: links form a web, not a star."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(90)]
    texts = []
    for k in range(160):
        words = list(base)
        for _ in range(rng.randint(1, 3)):
            words[rng.randrange(90)] = f"x{rng.randrange(40)}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [exact_shingles(t, 4) for t in texts]
    got = {r.doc_id: r.component_id for r in ngram_join.similar_groups(docs, 4, 85).collect()}
    assert got == dict(enumerate(_components(sets, 85)))


@pytest.mark.parametrize("ids", ["null", "shared"])
def test_ngram_join_of_rows_that_share_an_id(spark, ids):
    """Texts are told apart where their ids are not."""
    rng = random.Random(3)
    texts = []
    for _ in range(12):
        words = _words(rng, 80).split(" ")
        texts += [" ".join(words), " ".join(["new", *words[1:]])]
    texts += [" ".join(["w", *texts[0].split(" ")[1:]])]
    rows = [(None if ids == "null" else i % 2, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([*rows, *rows[:3], (100, texts[2]), (101, texts[5])], "doc_id long, text string").repartition(3)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    sets = [exact_shingles(t, 4) for _, t in rows]
    low = _components(sets, 85)
    want = Counter()
    for i, (d, _) in enumerate(rows):
        known = [rows[j][0] for j in range(len(rows)) if low[j] == low[i] and rows[j][0] is not None]
        want[d, len(sets[i]), min(known, default=None)] += 1
    assert _bag(map(tuple, ngram_join.similar_groups(docs, 4, 85).collect())) == want


def test_ngram_join_counts_links(spark):
    """Links within a group too, of copies and near copies, over several blocks."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(90)]
    texts = [None, "", "one", "ONE", _words(rng, 50)]
    for k in range(120):
        words = list(base)
        for _ in range(rng.randint(1, 3)):
            words[rng.randrange(90)] = f"x{rng.randrange(40)}"
        texts.append(" ".join(words))
    texts += texts[:20]
    sets = [exact_shingles(t or "", 4) for t in texts]
    near = lambda a, b: bool(a and b and 100 * len(a & b) >= 85 * len(a | b))
    want = Counter((i if i % 9 else None, sum(near(a, b) for b in sets) - bool(a)) for i, a in enumerate(sets))
    docs = spark.createDataFrame([(i if i % 9 else None, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = ngram_join.linked_groups(docs, 4, 85).select("doc_id", "n_links").collect()
    assert _bag(map(tuple, got)) == want
    assert 1 < max(r.n_links for r in got) < 140


def test_block_links(monkeypatch):
    monkeypatch.setattr(ngram_join, "COLUMNS", 7)
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 40, n)) for n in rng.integers(1, 60, 30)]
    want = [[2 * len({*a} & {*b}) >= len({*a} | {*b}) for b in sets[12:]] for a in sets[:12]]
    assert ngram_join._block_links(sets, np.arange(12), np.arange(12, 30), 50).tolist() == want


def test_suffix_array():
    rng = random.Random(3)
    for _ in range(200):
        length, signs = rng.choice([1, 3, 8, 9, 20]), rng.choice([b"a", b"ab", b"abc\0", b"\0\xff"])
        base = bytes(rng.choice(signs) for _ in range(60))
        contexts = []
        for _ in range(rng.randint(1, 12)):
            at = rng.randint(0, 30)
            x = bytearray(base[at:at + rng.randint(length, length + 25)])
            if rng.random() < 0.5:
                x[rng.randrange(len(x))] = rng.choice(signs)
            contexts.append(bytes(x))
        times = Counter(c[i:i + length] for c in contexts for i in range(len(c) - length + 1))
        want = [[times[c[i:i + length]] > 1 for i in range(len(c) - length + 1)] for c in contexts if len(c) >= length]
        assert [f.tolist() for f in suffix_array.repeated_starts([c for c in contexts if len(c) >= length], length)] == want


@pytest.mark.parametrize("length, heavy", [(400, 4096), (40, 4096), (40, 0)])
def test_suffix_dedup(docs, rows, empty, length, heavy):
    texts = [(t or "").encode() for _, t, *_ in rows]
    times = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    want = Counter()
    for (doc, *_), t in zip(rows, texts):
        covered = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if times[t[i:i + length]] > 1:
                covered[i:i + length] = b"\1" * length
        left = bytes(b for b, c in zip(t, covered) if not c)
        want[doc, len(t), sum(covered), len(re.findall(b"\1+", bytes(covered))), hashlib.sha256(left).hexdigest()] += 1
    got = suffix_dedup.repeated_spans(docs, length, heavy=heavy).drop("spans").collect()
    assert _bag(map(tuple, got)) == want
    assert suffix_dedup.repeated_spans(empty, length).count() == 0


def _rule_numbers(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = {k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in (i, i + 1, i + 2)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated)


def test_quality_rules(spark, docs, rows, empty):
    labels = spark.createDataFrame([(2, 1), (3, 1), (21, 0), (None, 1), (4, None)], "doc_id long, quality int")
    got = quality_rules.quality_rules(docs, labels).collect()
    want = Counter()
    for d, t, *_ in rows:
        n = _rule_numbers(t or "")
        want[(d, *n, n[0] < 50 or 100 * n[4] > 50 * n[0])] += 1
    assert _bag((r.doc_id, *(r[c] for c in quality_rules.BASE), r.base_failed) for r in got) == want
    assert not any(r.kept and r.base_failed for r in got)
    assert quality_rules.quality_rules(empty, labels).count() == 0


def test_forest_finds_odd_rows():
    rng = np.random.default_rng(1)
    usual = rng.normal(0, 1, (2000, 4))
    odd = rng.normal(8, 1, (40, 4))
    forest = quality_rules.IsolationForest(np.concatenate([usual, odd]))
    limit = quality_rules.threshold(forest.oddness(usual), forest.oddness(odd))
    assert (forest.oddness(usual) <= limit).mean() >= 0.995 and (forest.oddness(odd) > limit).mean() > 0.95


def test_signs_of_all_scripts():
    got = quality_rules.statistics(["— • █ \U0001F600 Привет, Ժ किताब"])
    assert (got["n_signs"][0], got["n_upper"][0]) == (5, 2)


def test_forest_draws_from_all_rows(spark):
    """Not from a pool of 8192, whatever the size."""
    same = {"n_words": F.lit(1), "word_chars": F.col("id")}
    rows = spark.range(30_000).select("id", *(same.get(c, F.lit(0)).cast("long").alias(c) for c in quality_rules.BASE + quality_rules.MORE))
    samples = quality_rules.tree_samples(rows)
    assert [len(x) for x in samples] == [quality_rules.PSI] * quality_rules.TREES
    assert len({x for s in samples for x in s[:, 0].tolist()}) > 12_000
    few = quality_rules.tree_samples(rows.limit(60).unionByName(rows.limit(60)), 5)
    assert [len(x) for x in few] == [120] * 5


def test_threshold_of_counts():
    rng = np.random.default_rng(4)
    clean, bad = np.round(rng.normal(0.4, 0.05, 30_000), 2), np.round(rng.normal(0.6, 0.05, 9_000), 2)
    (a, n_a), (b, n_b) = np.unique(clean, return_counts=True), np.unique(bad, return_counts=True)
    limit = quality_rules.threshold(a, b, 0.995, n_a, n_b)
    assert limit == quality_rules.threshold(clean, bad, 0.995) >= np.quantile(clean, 0.995, method="higher")


def _kneser_ney(texts, order):
    """A literal model of one language: p(w | h) by recursion."""
    def grams(t, k):
        padded = b"\n" * (order - 1) + t
        return [padded[i:i + k] for i in range(order - k, len(padded) - k + 1)]

    counts = {order: Counter(g for t in texts for g in grams(t, order))}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    discounts = {}
    for k, c in counts.items():
        n = Counter(c.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else 0
        discounts[k] = [min(max((i - (i + 1) * y * n[i + 1] / n[i]) if n[i] else 0.5 * i, 0.05), i - 0.05) for i in (1, 2, 3)]
    totals = {k: Counter() for k in counts}
    held = {k: Counter() for k in counts}
    for k, c in counts.items():
        for g, v in c.items():
            totals[k][g[:-1]] += v
            held[k][g[:-1]] += discounts[k][min(v, 3) - 1]

    def p(g):
        k = len(g)
        if k == 0:
            return 1 / 256
        lower = p(g[1:])
        total = totals[k][g[:-1]]
        if not total:
            return lower
        v = counts[k][g]
        return (v - discounts[k][min(v, 3) - 1] if v else 0) / total + held[k][g[:-1]] / total * lower

    return lambda t: float(np.exp(-sum(np.log(p(g)) for g in grams(t, order)) / len(t)))


def test_kneser_ney(spark, docs, rows, empty):
    labels = spark.createDataFrame([(i, 1 if i % 2 else 0) for i in range(24)] + [(None, 1), (3, 1), (5, None)], "doc_id long, quality int")
    got = kneser_ney.perplexity(docs, labels, F.col("quality") == 1, order=3).collect()
    held = {int(r.i) for r in spark.range(24).select(F.col("id").cast("string").alias("i")).filter(
        F.pmod(F.xxhash64("i"), F.lit(kneser_ney.HELD_OUT)) == 0).collect()}
    trusted = {i for i in range(24) if i % 2 and i != 5} - held
    models = {}
    for lang in ("en", "de", None):
        train = [(t or "").encode() for d, t, g, _ in rows if g == lang and d in trusted]
        models[lang] = _kneser_ney(train, 3)
    want = sorted((str(d), len((t or "").encode()), models[g]((t or "").encode()) if t else 0) for d, t, g, _ in rows)
    have = sorted((str(r.doc_id), r.n_bytes, r.perplexity or 0) for r in got)
    assert [r[:2] for r in have] == [r[:2] for r in want]
    assert [r[2] for r in have] == pytest.approx([r[2] for r in want], rel=1e-6)  # logarithms travel in single precision
    assert not any(r.kept for r in got if not r.n_bytes)
    assert kneser_ney.perplexity(empty, labels, F.col("quality") == 1).count() == 0


def test_kneser_ney_takes_a_batch_apart():
    import pickle
    import tracemalloc

    import pyarrow as pa
    import zstandard

    rng = np.random.default_rng(5)
    words = rng.integers(97, 123, (4000, 5), np.uint8)
    texts = [words[rng.integers(0, 4000, 3000)].tobytes() for _ in range(4000)]  # 60 MB in one batch
    size = sum(map(len, texts))
    batch = pa.RecordBatch.from_pydict({
        "id": [str(i) for i in range(4000)], "lang": ["en", "de"] * 2000, "chunk": ["a"] * 4000, "mark": [1] * 4000, "train": [True] * 4000, "text": texts})
    tracemalloc.start()
    counts = sum(sum(b.column(3).to_pylist()) for b in kneser_ney._gram_rows(2)(iter([batch])))
    rows = list(kneser_ney._payload(iter([batch])))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 0.9 * size  # texts as objects alone would be all of it
    assert counts == size
    opened = [pickle.loads(zstandard.ZstdDecompressor().decompress(r.column(2)[0].as_py())) for r in rows]
    assert sorted((int(i), t) for names, _, held in opened for i, t in zip(names, held)) == list(enumerate(texts))
    assert len(rows) <= size / kneser_ney.PAYLOAD + 4  # a row is joined to its chunk's whole list
    assert all(sum(map(len, held)) <= kneser_ney.PAYLOAD for _, _, held in opened)
