import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from vitalgrid.llm import lexical as L

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def brute(docs, items, k=50):
    counts = [(d, Counter(terms_of(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    big_n, big_l = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms_of(text))
    out = []
    for item, own in asked.items():
        scored = []
        for d, c in counts:
            m = 50 + (50 * sum(c.values()) * big_n) // big_l
            s = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in own if c[t])
            if s > 0:
                scored.append((-s, d is None, d or 0))
        out += [(item, i + 1, None if none else d, -s) for i, (s, none, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def got(spark, docs, items, k=50, segment_words=L.SEGMENT_WORDS):
    asked = spark.createDataFrame([(*i, "x", 1) for i in items], "item_id long, text string, term string, number long")
    index, n = L.built(docs, segment_words=segment_words)
    return sorted((tuple(r) for r in L.search(index, n, asked, k).select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"t{i}" for i in range(40)] + ["Été", "日本", "x-y", "THE"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    draw = lambda n: " ".join(rng.choices(vocabulary, weights, k=n))
    docs = [(i, draw(rng.choice([0, 1, 3, 10, 30, 30, 200]))) for i in range(300)]
    docs += [(1000 + i, docs[7][1]) for i in range(30)] + [(5, docs[5][1]), (None, docs[7][1]), (2000, "...")]
    items = [(i, draw(rng.choice([1, 2, 5, 20]))) for i in range(12)] + [(3, "t1 t2"), (None, "t5"), (50, None), (51, ""), (52, "unknown only")]
    return docs, items


@pytest.mark.parametrize("seed, words, block, k", [(1, 2_000_000, 4_096, 50), (2, 200, 4_096, 50), (3, 200, 3, 5), (4, 1, 1, 1)])
def test_against_all_documents(spark, make, monkeypatch, seed, words, block, k):
    """Any size of segments and of blocks of items gives the same ranks."""
    monkeypatch.setattr(L, "ITEM_BLOCK", block)
    docs, items = corpus(seed)
    assert got(spark, make([(*d, "en", "a") for d in docs]), items, k, words) == brute(docs, items, k)


def test_edges(spark, odd, make):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    items = [(1, "no ID same y word5"), (2, "y" * 70_000), (3, "other7 Other8 12 é"), (4, " ")]
    assert got(spark, odd, items) == brute(rows, items)
    assert got(spark, make([]), items) == got(spark, odd, []) == got(spark, make([(1, "..", "en", "a"), (2, None, "en", "a")]), items) == []


def test_strata_are_left_out(monkeypatch):
    """A stratum whose bound is below the k-th score is not visited, and the result is the same."""
    import pandas as pd
    rng = np.random.default_rng(1)
    rows = []
    for t in range(6):  # four strata of 100 slots each, longer documents last
        m, tf = np.repeat([50, 200, 2_000, 20_000], 3), np.tile([9, 2, 1], 4)
        slot = np.concatenate([rng.permutation(100)[:30] + 100 * s for s in range(4)])
        rows.append((0, 0, f"t{t}", 100 + t, m, tf, np.tile([5, 10, 15], 4), slot, [0, 1] if t < 3 else [1]))
    pdf = pd.DataFrame(rows, columns=["segment", "block", "term", "w", "m", "tf", "size", "slot", "items"])
    visited = []
    monkeypatch.setattr(L, "best_slots", lambda score, k, f=L.best_slots: visited.append(int((score > 0).sum())) or f(score, k))
    few, many = L.searched(3)(pdf), L.searched(400)(pdf)
    assert min(visited) < max(visited) / 2
    for item in (0, 1):
        assert few[few.number == item][["slot", "score"]].values.tolist() == many[many.number == item][["slot", "score"]].values.tolist()[:3]
