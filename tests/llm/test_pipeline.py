"""The corpus pipeline on small documents against a brute-force version of its stages."""

import os

import pytest

import corpus_pipeline as C

from test_ngram_join import brute

needs_model = pytest.mark.skipif(not os.path.exists(C.PIECE_MODEL), reason="no public tokenizer files")


@needs_model
def test_stages(spark, make, tmp_path):
    words = {"en": "the and of that with have this from".split(), "de": "der die und nicht ein ist mit sich".split()}
    rows = [(i, " ".join(f"{words[l][(i * 7 + k * k + k * i) % 8]}{chr(97 + (i * k) % 26)}" for k in range(60)), l, f"s{i % 4}")
            for i, l in enumerate(["en", "de"] * 40)]
    rows += [(200, rows[0][1] + " ", "en", "s0"), (201, rows[0][1].replace(" ", "  ", 1), "en", "s1"),
             (202, rows[2][1] + " tail", "en", "s2"), (203, None, "en", "s0"), (204, "123 456", "de", None), (205, rows[5][1], "de", "s1")]
    docs = make(rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    kept, frames = docs, {}
    for name, stage in C.STAGES:
        out = stage(spark, kept, str(tmp_path))
        if name != C.STAGES[-1][0]:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}.parquet")
        kept = frames[name] = spark.read.parquet(f"{tmp_path}/{name}.parquet")
    ids = {n: sorted(r.doc_id for r in f.collect()) for n, f in frames.items()}
    assert ids["language_id"] == sorted(i for i, *_ in rows if i not in (203, 204))
    assert ids["exact_dedup"] == sorted(i for i, *_ in rows if i not in (201, 203, 204, 205))  # 200 ends in a space
    text = {r[0]: r[1] for r in rows}
    alone = {c for _, _, c in brute([(i, text[i]) for i in ids["exact_dedup"]])}
    assert ids["ngram_join"] == sorted(alone) and 200 not in alone
    assert set(ids["mixing"]) <= alone and max(ids["mixing"].count(i) for i in ids["mixing"]) <= 2
    drawn = sum(len((r.text or "").split()) for r in frames["mixing"].collect())
    whole = sum(len(text[i].split()) for i in alone)
    assert abs(drawn - 1.5 * whole) <= 0.02 * whole
    assert ids["sentencepiece"] == ids["mixing"]
    assert C.run(spark, str(tmp_path)).count() == len(ids["mixing"])
