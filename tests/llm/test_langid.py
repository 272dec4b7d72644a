import numpy as np

from vitalgrid.llm import langid as L

WORDS = {"en": "the and of that with have this from", "de": "der die und nicht ein ist mit sich", "fr": "les des une dans que pour avec est"}


def corpus(make, n=240):
    rng = np.random.default_rng(1)
    langs = list(WORDS)
    return make([(i, " ".join(rng.choice(WORDS[langs[i % 3]].split(), 20)), langs[i % 3], "a") for i in range(n)])


def test_held_out_accuracy(make):
    df = corpus(make)
    got = L.identify(df).join(df.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 240 and held and sum(r.lang == r.lang_pred for r in held) >= 0.9 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_presence_kernel_against_sets():
    texts = ["abcab", "Abc", "zz"]
    grams = [{t.lower()[i : i + n] for n in L.GRAMS for i in range(len(t) - n + 1)} for t in texts]
    x = L.batch(texts)
    for i in range(3):
        for j in range(3):
            want = len(grams[i] & grams[j]) / np.sqrt(len(grams[i]) * len(grams[j]))
            assert abs(x[i] @ x[j] - want) < 0.02  # a hash may join two n-grams


def test_long_text_equals_whole(make):
    text = "".join(chr(97 + i * i % 26) for i in range(70_000))
    out, own = np.zeros(L.DIM, np.float32), np.zeros(L.DIM, np.float32)
    L.presence(text, out)
    for at in range(0, len(text), 1000):  # overlapping pieces see every n-gram
        L.presence(text[at : at + 1002], own)
    assert (out == own).all()


def test_very_long_texts_keep_their_language():
    rng = np.random.default_rng(3)
    known = [(" ".join(rng.choice(words.split(), 20)), lang) for lang, words in WORDS.items() for _ in range(40)]
    model = L.fit(L.cells([t for t, _ in known]), [lang for _, lang in known])
    foreign = "".join(map(chr, rng.integers(0x3B1, 0x3CA, 10_000_000)))  # n-grams of no language fill a small table
    assert L.predict(model, [f"{words} {foreign}" for words in WORDS.values()])[0] == list(WORDS)


def test_runs_of_non_letters_are_one_space():
    a, b, c = L.cells(["one two", "one -- 12.5\n\ttwo", "onetwo"])
    assert (a == b).all() and len(a) != len(c)


def test_edges(odd, make):
    got = {(r.doc_id, r.held_out): r for r in L.identify(odd).collect()}
    by_id = {r.doc_id: r for r in got.values()}
    for i in (1, 2, 3):
        assert by_id[i].lang_pred == "und" and by_id[i].score == 0
    assert by_id[None].held_out is False and by_id[4].lang_pred in ("en", "fr")
    assert L.identify(make([])).count() == 0
    alone = L.identify(make([(1, "some words", None, "a")])).collect()[0]
    assert alone.lang_pred == "und"


def test_accepted_keeps_columns(make):
    df = corpus(make, 60).union(make([(1000, "12 34", "en", "a"), (1001, None, "en", "a")]))
    kept = L.accepted(df)
    assert kept.columns == df.columns and kept.count() == 60


def test_batched_products_equal_kernel_values(monkeypatch):
    """Dense batches of any size give the same kernel values as pairs of cell sets, and scores are linear in them."""
    import numpy as np

    from vitalgrid.llm import langid as L

    texts = ["the cat sat on the mat", "der hund lief in den wald", "el perro come pan", "thé été", "x", "zzz qqq"] * 3
    rows = L.cells(texts)
    marks = rows[:4]
    held = np.unique(np.concatenate(marks))
    columns = np.zeros((len(held), 4), np.float32)
    for j, own in enumerate(marks):
        columns[np.searchsorted(held, own), j] = 1 / np.sqrt(len(own))
    want = [[len(np.intersect1d(a, b)) / np.sqrt(len(a) * len(b)) for b in marks] for a in rows]
    for at_once in (1, len(held) * 5, 1 << 24):
        monkeypatch.setattr(L, "AT_ONCE", at_once)
        assert np.allclose(L.products(rows, held, columns), want, atol=1e-6)
    fold = np.random.default_rng(1).normal(size=(4, 3)).astype(np.float32)
    assert np.allclose(L.products(rows, held, columns @ fold), np.array(want) @ fold, atol=1e-5)
    assert L.products(rows, held[:0], columns[:0]).shape == (18, 4) and not L.products([], held, columns).size
