import math

import numpy as np
import pytest

from vitalgrid.llm import toxicity as T


def corpus(spark, make):
    rng = np.random.default_rng(3)
    plain, bad = [f"word{chr(97 + i)}" for i in range(20)], ["idiot", "scum", "trash", "moron"]
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        words = list(rng.choice(plain, 15)) + (list(rng.choice(bad, 1 + i % 3)) if toxic else [])
        rows.append((i, " ".join(words), "en", "a"))
        if i < 300:
            labels.append((i, 1, int(toxic)))
    return make(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_unlabelled_texts_are_graded(spark, make):
    docs, labels = corpus(spark, make)
    got = {r.doc_id: r for r in T.severity(docs, labels).collect()}
    assert all(got[i].toxic == (i % 4 == 0) for i in range(300, 400))
    clean, toxic = (np.mean([got[i].severity for i in range(300, 400) if (i % 4 == 0) == t]) for t in (False, True))
    assert clean < 0.3 < 0.9 < toxic and all(0 <= r.severity <= 2 and r.grade in (0, 1, 2) for r in got.values())


def test_fit_orders_grades():
    docs, grades = [[0], [0, 1], [1], [2], []] * 20, np.array([1, 2, 1, 0, 0] * 20)
    w, theta = T.fit(docs, grades, 3)
    assert theta[0] < theta[1] and w[0] > w[2] and w[1] > w[2]


def test_edges(spark, odd, make):
    labels = spark.createDataFrame([(6, 1, 1), (6, 1, 0), (4, 1, 0), (2, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = T.severity(odd, labels).collect()
    assert len(got) == odd.count() and all(r.severity is not None for r in got)
    assert len({(r.doc_id, r.severity) for r in got if r.doc_id == 7}) == 1
    assert T.severity(make([]), labels).count() == 0
    none = T.severity(odd, labels.limit(0)).collect()
    assert all(r.severity < 1e-9 and not r.toxic for r in none)


def loss(docs, grades, w, theta):
    """Mean negative log likelihood of the grades, grade by grade, and the penalty."""
    total = 0.0
    for words, grade in zip(docs, grades):
        score = sum(w[x] for x in words)
        above = [1.0, *[1 / (1 + math.exp(t - score)) for t in theta], 0.0]
        total -= math.log(above[grade] - above[grade + 1])
    return total / len(docs) + T.L2 * float((np.asarray(w) ** 2).sum()) / 2


@pytest.mark.parametrize("seed", [1, 2])
def test_fit_minimises_the_likelihood(seed):
    """No step along any weight or threshold lowers the loss by more than a trifle, and numeric descent gains nothing."""
    rng = np.random.default_rng(seed)
    docs = [sorted(rng.choice(6, rng.integers(0, 5), replace=False).tolist()) for _ in range(150)]
    grades = np.array([min(2, max(0, int(sum(x < 2 for x in d) + (rng.random() < 0.3) - (rng.random() < 0.2)))) for d in docs])
    w, theta = T.fit(docs, grades, 6)
    found = loss(docs, grades, w, theta)
    at = np.concatenate([w, theta])
    for k in range(len(at)):
        for step in (-0.05, 0.05):
            near = at.copy()
            near[k] += step
            assert loss(docs, grades, near[:6], near[6:]) >= found - 1e-4
    own = np.concatenate([np.zeros(6), [-0.5, 0.5]])
    for _ in range(1_500):
        g = np.array([(loss(docs, grades, *np.split(own + e, [6])) - loss(docs, grades, *np.split(own - e, [6]))) / 2e-5 for e in 1e-5 * np.eye(8)])
        own -= 0.8 * g
    assert found <= loss(docs, grades, *np.split(own, [6])) + 1e-4


def test_scores_follow_the_definition(spark, make):
    """Vocabulary by plain counts, and severity, grade and verdict of each text by the sums of its words' weights."""
    docs, labels = corpus(spark, make)
    texts, marked = {r.doc_id: r.text for r in docs.collect()}, {r.doc_id: r.toxic for r in labels.collect()}
    weights, theta = T.trained(docs, labels, "doc_id", "text")
    held = {i: T.words_of(texts[i]) for i in marked}
    n = [sum(y == k for y in marked.values()) for k in (0, 1)]
    want = set()
    for word in set().union(*held.values()):
        has = [sum(word in held[i] for i, y in marked.items() if y == k) for k in (0, 1)]
        both = sum(has) / sum(n)
        z = (has[1] / n[1] - has[0] / n[0]) / math.sqrt(both * (1 - both) * (1 / n[0] + 1 / n[1])) if 0 < both < 1 else 0
        if sum(has) >= T.LEAST_TEXTS and abs(z) >= T.LEAST_Z:
            want.add(word)
    assert set(weights) == want and want
    for r in T.severity(docs, labels).collect():
        score = sum(weights.get(x, 0) for x in T.words_of(texts[r.doc_id]))
        above = [1 / (1 + math.exp(t - score)) for t in theta]
        shares = [1 - above[0], above[0] - above[1], above[1]]
        assert r.severity == pytest.approx(sum(above)) and r.toxic == (above[0] >= 0.5) and r.grade == shares.index(max(shares))


def test_ties_and_long_texts(spark, make):
    """Texts of the same words tie, whatever their order, repeats and length."""
    docs, labels = corpus(spark, make)
    long_text = "wordb idiot " * 300_000
    more = docs.union(make([(900, "idiot wordb", "en", "a"), (901, "WORDB idiot", "en", "a"), (902, long_text, "en", "a"), (903, "", "en", "a")]))
    got = {r.doc_id: r for r in T.severity(more, labels).collect()}
    assert got[900].severity == got[901].severity == got[902].severity > got[903].severity
