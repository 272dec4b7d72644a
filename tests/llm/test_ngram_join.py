import random

import pytest

from vitalgrid.llm import ngram_join as J
from vitalgrid.llm.components import components


def brute(rows):
    sets = []
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets.append(frozenset(tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))) if w else frozenset())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    groups = {}
    for a in range(len(rows)):
        groups.setdefault(find(a), []).append(rows[a][0])
    best = {g: min((i is None, i or 0) for i in ids) for g, ids in groups.items()}
    return sorted((rows[a][0] or -1, len(sets[a]), -1 if best[find(a)][0] else best[find(a)][1]) for a in range(len(rows)))


def got(df):
    return sorted((r.doc_id or -1, r.n_shingles, -1 if r.component_id is None else r.component_id) for r in J.similar(df).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(make, seed):
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(30)]
    bases = [[f"w{rng.randrange(400)}" for _ in range(rng.choice([1, 3, 4, 9, 40, 120]))] for _ in range(12)]
    rows = []
    for i in range(140):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 5])):
            words[rng.randrange(len(words))] = f"new{rng.randrange(9)}"
        if rng.random() < 0.3:
            words = words[: len(words) // 2] + passage + words[len(words) // 2 :]
        text = " ".join(words)
        rows.append((i, text.upper() if rng.random() < 0.1 else text.replace(" ", "\t\n", 2)))
    df = make([(*r, "en", "a") for r in rows])
    want = brute(rows)
    assert got(df) == want and len({w[2] for w in want}) < 130


def test_edges(odd, make):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert got(odd) == brute(rows)
    assert J.similar(make([])).count() == 0
    kept = J.first_of_components(odd)
    assert kept.schema == odd.schema
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [1, 2, 3, 4, 5, 6, 8, 9]


def test_components_of_paths_and_hubs(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 260)] + [(9, 7), (7, 8)]
    roots = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(roots[i] == 100 for i in range(100, 161)) and all(roots[i] == 5 for i in range(200, 260))
    assert roots[9] == roots[8] == 7
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
