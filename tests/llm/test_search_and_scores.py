"""Lexical search, word model and source audit against plain versions, with the odd rows of every table."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import lexical_search, passages, source_audit, word_model

DOCS = "doc_id long, text string, lang string, source string, term string, score double, chunk string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def texts_of(rng, n):
    words = ["alpha", "Beta", "gamma,", "d4", "É", "éa", "x-y", "zeta", "the", "the", "The", "of", "日本", "q"] + [f"w{i}" for i in range(40)]
    return [" ".join(rng.choice(words, rng.integers(1, 30))) for _ in range(n)]


def documents(spark, n=120, seed=1):
    rng = np.random.default_rng(seed)
    texts = texts_of(rng, n)
    rows = [(i, t, ["en", "de", None][i % 3], ["a", "b", None, "c"][i % 4]) for i, t in enumerate(texts)]
    rows += [(500, None, "en", "a"), (501, "", "fr", None), (502, " \t\n", "fr", "x"), (None, texts[0], "en", "a"), (None, "solo", None, None)]
    rows += [(7, texts[7], "en", "b"), (600, texts[3], "en", "b"), (601, texts[3], "en", "b"), (602, "The " * 4000 + texts[5], "de", "c")]
    return spark.createDataFrame([(*r, "clash", 0.0, "clash") for r in rows], DOCS).repartition(5)


# ---------------------------------------------------------------- search

def plain_search(docs, items, k=10):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(t))
    found = [(i, Counter(terms(t))) for i, t in docs]
    found = [(i, c, sum(c.values())) for i, c in found if c]
    total, length = len(found), sum(n for _, _, n in found)
    df = Counter(t for _, c, _ in found for t in c)
    asked = defaultdict(set)
    for item, text in items:
        asked[item] |= set(terms(text))
    out = []
    for item, own in asked.items():
        scored = []
        for i, c, n in found:
            m = 10 + (90 * n * total) // length
            s = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in own if t in c)
            if s > 0:
                scored.append((-s, i is None, i))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def benchmark(spark):
    rows = [(1, "alpha É w3 W4 the"), (2, "日本 beta"), (3, None), (4, ""), (5, "unheard"), (None, "zeta of"), (6, "w1 w2"), (6, "w2 w9 w9"), (7, "the")]
    return spark.createDataFrame([(*r, 1) for r in rows], "item_id long, text string, rank int")


def listed(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("blocks", [1, 3])
def test_search(spark, monkeypatch, blocks):
    monkeypatch.setattr(lexical_search, "BLOCK_ITEMS", 9 // blocks)
    docs, items = documents(spark), benchmark(spark)
    want = plain_search([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert listed(lexical_search.ranked_search(docs, items), "item_id", "rank", "doc_id", "score") == want
    assert {r[0] for r in want} == {1, 2, None, 6, 7}


def test_search_empty(spark):
    docs, items = documents(spark), benchmark(spark)
    none = lexical_search.ranked_search(docs.filter("false"), items)
    assert none.columns == ["item_id", "rank", "doc_id", "score"] and none.count() == 0
    assert lexical_search.ranked_search(docs, items.filter("false")).count() == 0


def test_tree_bounds_and_pruning(monkeypatch):
    """Any leaf size gives the scores of all documents; copies share a leaf."""
    rng = np.random.default_rng(5)
    width, ids = 30, np.arange(400)
    terms = [np.flatnonzero(rng.random(width) < np.linspace(0.9, 0.05, width)) for _ in ids]
    terms[50:150] = [terms[50]] * 100
    terms = [t if len(t) else np.array([0]) for t in terms]
    tfs = [rng.integers(1, 5, len(t)) for t in terms]
    m = rng.integers(20, 300, len(ids))
    weights = rng.integers(1, 5000, width)
    for leaf in (1, 8, 1000):
        monkeypatch.setattr(lexical_search, "LEAF", leaf)
        tree = lexical_search.Tree(ids, m, terms, tfs, width)
        for _ in range(20):
            own = rng.choice(width, 6, False)
            place = np.full(width, -1)
            place[own] = np.arange(6)
            none = np.zeros(0, np.int64)
            scores, found = tree.best(own, weights[own], place, 10, (none, none))
            all_ = [sum(int(weights[t]) * (10**9 * int(f) // (1000 * int(f) + 8 * int(x))) for t, f in zip(a, b) if place[t] >= 0)
                    for a, b, x in zip(terms, tfs, m)]
            want = sorted((-s, i) for i, s in enumerate(all_) if s > 0)[:10]
            assert list(zip(scores.tolist(), found.tolist())) == [(-s, i) for s, i in want]


def test_tree_table_is_bounded(monkeypatch):
    """Where subtrees x terms would be too many, leaves grow; a single node always fits."""
    rng = np.random.default_rng(6)
    width, ids = 200, np.arange(500)
    terms = [np.sort(rng.choice(width, 5, False)) for _ in ids]
    tfs = [np.ones(5, np.int64)] * len(ids)
    m, none = np.full(len(ids), 50), np.zeros(0, np.int64)
    own, place = np.arange(6), np.append(np.arange(6), np.full(width - 6, -1))
    found = []
    for cells in (1 << 26, 20 * width, 1):
        monkeypatch.setattr(lexical_search, "CELLS", cells)
        tree = lexical_search.Tree(ids, m, terms, tfs, width)
        assert tree.top.size <= cells or len(tree.top) == 1
        found.append([x.tolist() for x in tree.best(own, np.full(6, 100), place, 10, (none, none))])
    assert found[0] == found[1] == found[2] and len(found[0][0]) == 10


# ---------------------------------------------------------------- word model

def plain_scores(rows):
    """The model by dictionaries; rows (id, text, held_out)."""
    end, start = ("end",), ("start",)
    tokens = [(i, [*re.findall(r"[^\x20\x09-\x0D]+", lower(t)), end], h) for i, t, h in rows]
    count = Counter(w for _, ws, h in tokens if not h for w in ws)
    pair = Counter(p for _, ws, h in tokens if not h for p in zip([start, *ws], ws))
    before, follow, total = Counter(), defaultdict(Counter), Counter()
    for (a, b), c in pair.items():
        before[b] += 1
        follow[a][min(c, 3)] += 1
        total[a] += c
    kinds = lambda c: [sum(v == i for v in c.values()) for i in (1, 2, 3, 4)]
    high, low = word_model.discounts(*kinds(pair)), word_model.discounts(*kinds(before))
    n, v, k = sum(count.values()), len(count), len(pair)
    rest = sum(low[min(c, 3)] for c in before.values()) / k if k else 1.0
    p1 = lambda w: ((before[w] - low[min(before[w], 3)]) / k if w in before else 0.0) + rest / (v + 1)
    def p(a, b):
        if a not in total:
            return p1(b)
        c = pair[a, b]
        gamma = sum(high[x] * y for x, y in follow[a].items()) / total[a]
        return (c - high[min(c, 3)] if c else 0.0) / total[a] + gamma * p1(b)
    out = [(i, h, len(ws), sum(w in count for w in ws), n, sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws),
            sum(math.log10(p(a, b)) for a, b in zip([start, *ws], ws))) for i, ws, h in tokens]
    return out, p, count


COLUMNS = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


@pytest.mark.parametrize("bucket,shard", [(1 << 16, 3_000_000), (8, 500)])
def test_word_model(spark, monkeypatch, bucket, shard):
    monkeypatch.setattr(word_model, "BUCKET", bucket)
    monkeypatch.setattr(word_model, "SHARD", shard)
    docs = documents(spark)
    held_out = F.col("doc_id") % 5 == 1
    rows = [(r.doc_id, r.text, r.doc_id is not None and r.doc_id % 5 == 1) for r in docs.collect()]
    want, p, count = plain_scores(rows)
    got = listed(word_model.score_texts(docs, held_out), *COLUMNS)
    want = sorted(want, key=repr)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    np.testing.assert_allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9)
    # probabilities of all words and one unknown one sum to 1 after any word
    for a in list(count)[:20]:
        assert abs(sum(p(a, b) for b in [*count, "never seen"]) - 1) < 1e-9


def test_frequent_first_words_are_spread():
    """A word with a third or more of all tokens does not fill a shard, nor do the starts of texts."""
    class Counts(word_model.Words):
        def numbers(self, hashes):
            return np.full(len(hashes), 1)

        def look_up(self, kind, numbers):
            return np.array([100_000, 60_000, 3])[numbers]

    words = Counts("", 0, 20, 200_000)
    starts = word_model.START << 32
    hot = np.concatenate([np.arange(1000, 101_000), starts | np.arange(1000, 61_000), (2 << 32) | np.arange(1000, 1003)])
    assert sorted(set(word_model.spreads(words, hot >> 32 & 0xFFFFFFFF).tolist())) == [4, 24, 40]
    by, cuts = word_model.by_shard(words, hot)
    assert sorted(by.tolist()) == list(range(len(hot))) and cuts[-1] == len(hot)
    assert np.diff(cuts).max() < 3 * len(hot) / 20
    assert len(word_model.by_shard(words, hot[:0])[0]) == 0


def test_word_model_learns(spark):
    docs = documents(spark, 400, 2)
    rows = word_model.score_texts(docs, F.col("doc_id") % 5 == 1).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert rows[0] > rows[1]


def test_word_model_without_training_rows(spark):
    docs = documents(spark, 10)
    got = listed(word_model.score_texts(docs, F.lit(True)), "n_known", "train_tokens", "base_score", "score")
    assert set(got) == {(0, 0, 0.0, 0.0)}
    assert word_model.score_texts(docs.filter("false"), F.lit(False)).count() == 0


def test_model_folder_has_to_be_mounted():
    assert word_model.local_path("file:///a/b") == "/a/b" and word_model.local_path("/a") == "/a"
    with pytest.raises(ValueError):
        word_model.local_path("hdfs://a/b")


# ---------------------------------------------------------------- audit

def plain_audit(rows, least, top):
    rows = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(t))) for t, lang, source in rows]
    df, counts = Counter(), Counter()
    for lang, source, ws in rows:
        df.update((lang, w) for w in set(ws))
        counts.update((lang, source, w) for w in ws)
    out = []
    for lang in {r[0] for r in rows}:
        kept = [w for (x, w), n in df.items() if x == lang and n >= least]
        sources = {s for x, s, _ in rows if x == lang}
        def p(c, n):
            return 1 + 10**9 * (c + 5) // (n + 5 * len(kept))
        own = {s: {w: counts[lang, s, w] for w in kept} for s in sources}
        q = {w: sum(own[s][w] for s in sources) for w in kept}
        all_ = sum(q.values())
        ps = {s: {w: p(c, sum(own[s].values())) for w, c in own[s].items()} for s in sources}
        for s in sources:
            pair = sorted((-sum(abs(ps[s][w] - ps[o][w]) for w in kept), o) for o in sources - {s})
            term = sorted((-(ps[s][w] - p(q[w], all_)), w) for w in kept if own[s][w] and ps[s][w] > p(q[w], all_))[:top]
            out += [(lang, s, part, item, -v, i) for part, found in (("pair", pair), ("term", term)) for i, (v, item) in enumerate(found, 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("least,top", [(3, 4), (1, 50), (1000, 50)])
def test_audit(spark, monkeypatch, least, top):
    docs = documents(spark)
    want = plain_audit([(r.text, r.lang, r.source) for r in docs.collect()], least, top)
    for rows, blocks in ((100_000, 50_000), (0, 4)):  # joined in place of copied; languages in several blocks
        monkeypatch.setattr(source_audit, "BROADCAST_ROWS", rows)
        monkeypatch.setattr(source_audit, "BLOCK_GROUPS", blocks)
        got = source_audit.divergence(docs, least, top)
        assert listed(got, "lang", "source", "part", "item", "value", "rank") == want
    assert source_audit.divergence(docs.filter("false")).count() == 0


def test_runs_are_merged_in_order():
    """Small blocks give many overlapping runs; their merge is the count of all."""
    rng = np.random.default_rng(3)
    texts, slices = texts_of(rng, 90), []
    for a in range(0, 90, 10):
        block = source_audit._Block()
        block.add(texts[a:a + 10], ["en"] * 10, ["a", "b"] * 5)
        slices += list(block.spill(2).itertuples(index=False))
    slices.sort(key=lambda r: (r.shard, r.lang, r.first))
    got = {t: (n, dict(zip(s, c))) for _, t, n, s, c in source_audit.merged(iter(slices), 1)}
    words = lambda i: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(texts[i]))
    for term in {w for i in range(90) for w in words(i)}:
        own = Counter("ab"[i % 2] for i in range(90) for w in words(i) if w == term)
        assert got.pop(term) == (sum(own.values()), dict(own))
    assert not got


# ---------------------------------------------------------------- passages

def test_shared_passages(spark):
    """Every passage of 51 words that two documents share is found, wherever it stands; nothing below 32 words counts."""
    rng = np.random.default_rng(9)
    text = lambda n: " ".join("".join(rng.choice(list("abcdefgh"), 6)) for _ in range(n))
    long, short = text(51), text(31)
    rows = [(i, f"{text(int(rng.integers(0, 300)))} {long.upper() if i % 2 else long}\n{text(int(rng.integers(0, 300)))}") for i in range(8)]
    rows += [(100 + i, f"{text(60)} {short} {text(60)}") for i in range(4)]
    alone = text(200)
    rows += [(200, None), (201, ""), (202, long[:100]), (203, alone), (203, alone), (204, text(40)), (None, text(80)), (None, f"{text(80)} {long}")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, name string").repartition(6)
    got = {r.doc_id: r.shares_passage for r in passages.sharing(docs).collect()}
    assert got == {i: i is None or i < 8 for i, _ in rows}
    assert passages.sharing(docs.filter("false")).count() == 0
