import hashlib
import re

import numpy as np
import pytest

from vitalgrid.llm import exact_dedup as X


@pytest.mark.parametrize("n", [1, 2, 3, 1000])
def test_golomb_round_trip(n):
    values = np.unique(np.random.default_rng(n).integers(0, 2**64, n, np.uint64))
    k, code = X.golomb_encode(values)
    assert (X.golomb_decode(len(values), k, code) == values).all()


def test_golomb_extremes():
    values = np.array([0, 1, 2**63, 2**64 - 1], np.uint64)
    k, code = X.golomb_encode(values)
    assert (X.golomb_decode(4, k, code) == values).all()


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_against_brute_force(odd):
    rows = [(r.doc_id, norm(r.text)) for r in odd.collect()]
    got = X.exact_dedup(odd).collect()
    assert len(got) == len(rows)
    for r in got:
        text = next(t for i, t in rows if i == r.doc_id and hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
        group = [i for i, t in rows if t == text]
        assert r.group_size == len(group)
        assert r.keep_id == min(group, key=lambda i: (i is None, i or 0))
    assert sum(r.kept for r in got) == len({t for _, t in rows})


def test_copies_in_one_and_in_many_partitions(make):
    df = make([(i, "the same words" if i % 3 else f"own words {i}", "en", "a") for i in range(300)])
    for parts in (1, 7):
        got = X.exact_dedup(df.repartition(parts)).collect()
        assert sum(r.kept for r in got) == 101 and {r.keep_id for r in got if r.doc_id % 3} == {1}


def test_drop_copies_keeps_columns(odd, make):
    kept = X.drop_copies(odd)
    assert kept.columns == odd.columns and kept.schema == odd.schema
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id in (6, 7, 9, 10)) == [6, 9]
    assert X.drop_copies(make([])).count() == 0 and X.exact_dedup(make([])).count() == 0
