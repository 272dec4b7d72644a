import hashlib
import random
import re

import pytest

from vitalgrid.llm import decontaminate as D

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    strings = []
    for item, text in items:
        w = words_of(text)
        strings += [(item, w[i : i + 10]) for i in range(max(1, len(w) - 9)) if w]
    out = []
    for doc, text in docs:
        w, hit, ids = words_of(text), set(), set()
        for item, s in strings:
            for i in range(len(w) - len(s) + 1):
                if w[i : i + len(s)] == s:
                    hit.update(range(i, i + len(s)))
                    ids.update(() if item is None else (str(item),))
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def benchmark(spark, items):
    return spark.createDataFrame([(*i, "x", "y") for i in items], "item_id long, text string, words string, doc_id string")


def got(spark, docs, items):
    return sorted((tuple(r) for r in D.report(D.hits(docs, benchmark(spark, items))).collect()), key=repr)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "c", "Été", "x1", "日本", "ZZ"]
    draw = lambda n: rng.choice([" ", "\n", "-"]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, draw(n)) for i, n in enumerate([1, 2, 3, 3, 5, 9, 10, 11, 14, 30, 30])]
    items += [(4, draw(12)), (None, draw(4)), (20, None), (21, ""), (22, "-- .."), (23, items[6][1])]
    docs = []
    for i in range(60):
        text = draw(rng.choice([0, 1, 2, 8, 40, 90]))
        for _ in range(rng.choice([0, 0, 1, 2])):
            text += rng.choice(["", " ", ". "]) + (rng.choice(items)[1] or "").upper() + " " + draw(3)
        docs.append((i, text))
    return docs, items


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("most", [200_000, 9])
def test_against_every_position(spark, make, monkeypatch, seed, most):
    """With room for nine strings the items are searched in several blocks, whose hits meet in one row."""
    monkeypatch.setattr(D, "MOST_STRINGS", most)
    docs, items = corpus(seed)
    items = items if seed == 1 else items[3:]  # without the shortest, fewer words are hit
    assert got(spark, make([(*d, "en", "a") for d in docs]), items) == brute(docs, items)


def test_edges(spark, odd, make):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    items = [(1, "no id HERE at all"), (2, "y" * 70_000), (3, " ".join(f"word{i % 977} other{i % 331}" for i in range(400, 420))), (4, "")]
    assert got(spark, odd, items) == brute(rows, items)
    assert got(spark, make([]), items) == []
    assert not any(r[5] for r in got(spark, odd, []))
    clean = D.drop_contaminated(odd, benchmark(spark, items))
    assert clean.schema == odd.schema
    assert sorted(r.doc_id for r in clean.collect()) == [1, 2, 3, 4, 8, 9, 10]


def test_runs_and_pieces_lose_nothing(spark, make, monkeypatch):
    """Texts are read run by run and items cut into pieces: strings across the cuts are found."""
    monkeypatch.setattr(D, "PIECE", 3)
    monkeypatch.setattr(D, "byte_words", lambda text, word, f=D.byte_words: f(text, word, 7))
    docs, items = corpus(5)
    want = brute(docs, items)
    found = D.tables([(None if i is None else str(i), [w.encode() for w in words_of(t)]) for i, t in items if words_of(t)])
    for (doc, text), row in zip(docs, [next(w for w in want if w[0] == d[0]) for d in docs]):
        n, spans, ids = D.hits_of(text.encode(), found)
        assert (n, sum(s["hi"] - s["lo"] for s in spans), len(ids)) == row[1:4]
    pieces = [p for b in D.cut_items(benchmark(spark, items).selectExpr("cast(item_id as string) item_id", "cast(text as binary) text").toArrow().to_batches())
              for p in zip(b.column("item_id").to_pylist(), b.column("words").to_pylist())]
    assert max(len(p[1]) for p in pieces) == 12
    again = D.tables(pieces)
    assert [D.hits_of(t.encode(), again) for _, t in docs] == [D.hits_of(t.encode(), found) for _, t in docs]
