import itertools
import os
import random

import pytest
from pyspark.sql import functions as F

from vitalgrid.llm import pieces as S

PATH = "/opt/tokenizers/piece_bpe_32k.model"
needs_model = pytest.mark.skipif(not os.path.exists(PATH), reason="no public tokenizer files")


@pytest.fixture(scope="module")
def model():
    return S.Model.load(PATH)


@needs_model
def test_round_trip_and_library_ids(odd, make, model):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rng = random.Random(4)
    chars = "abcdefghij  thenger \n\t.,!?éüñßØ門ข123\U0001f600▁́"
    rows = [(100 + i, "".join(rng.choice(chars) for _ in range(rng.randrange(200))), "en", "a") for i in range(150)]
    rows += [(300, "a" * 3000, "en", "a"), (301, "the" * 900, "en", "a"), (302, " " * 40, "en", "a"), (303, "<s> <0x41> </s>", "en", "a")]
    df = odd.union(make(rows))
    texts = {r.doc_id: r.text or "" for r in df.collect()}
    got = S.encode(df, model).withColumn("back", S.decoded(F.col("ids"), model)).collect()
    assert len(got) == df.count()
    for r in got:
        assert list(r.ids) == lib.encode(texts[r.doc_id]) and r.n_tokens == len(r.ids)
        assert r.back == texts[r.doc_id].replace("▁", " ")


@needs_model
def test_empty_table(make, model):
    assert S.encode(make([]), model).count() == 0


@needs_model
def test_decode_replaces_broken_bytes(spark, model):
    ids = [model.byte_ids[0xC3], model.ids["a"], model.byte_ids[0xC3], model.byte_ids[0xA9], 1, 2]
    got = spark.createDataFrame([(ids,), ([],)], "ids array<int>").select(S.decoded(F.col("ids"), model).alias("t")).collect()
    assert [r.t for r in got] == ["�aé", ""]


def splits(text):
    for n in range(len(text)):
        for cut in itertools.combinations(range(1, len(text)), n):
            yield [text[a:b] for a, b in zip((0, *cut), (*cut, len(text)))]


def test_unigram_fold_against_all_paths(spark):
    rng = random.Random(8)
    table = {"▁": -2.5, "a": -3.1, "b": -2.9, "c": -4.0, "ab": -3.7, "bc": -4.4, "abc": -5.05, "▁a": -3.3, "ca": -4.6, "▁ab": -4.1}
    m = S.Model({p: (i, s) for i, (p, s) in enumerate(table.items())}, "unigram", [], 99, [])
    units = sorted({"▁" + "".join(rng.choice("abcx") for _ in range(rng.randrange(1, 9))) for _ in range(60)})
    worst = min(table.values()) - S.UNKNOWN_PENALTY
    score = lambda parts: sum(table.get(p, worst if len(p) == 1 else -1e9) for p in parts)
    masks = {r.unit: r["mask"] for r in S.segmented(spark.createDataFrame([(u,) for u in units], "unit string"), m).collect()}
    for u in units:
        cuts = [i for i in range(len(u)) if masks[u] >> i & 1] + [len(u)]
        parts = [u[a:b] for a, b in zip(cuts, cuts[1:])]
        best = max(map(score, splits(u)))
        assert abs(score(parts) - best) < 1e-9 and abs(score(S.best_path(u, m)) - best) < 1e-9


def test_models_whose_merges_are_out_of_order_are_refused():
    pieces = {"a": (0, -9.0), "b": (1, -9.0), "c": (2, -9.0), "abc": (3, -1.0), "ab": (4, -2.0)}
    with pytest.raises(ValueError, match="not in order"):
        S.Model(pieces, "bpe", [], 9, [])
