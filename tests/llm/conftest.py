import pytest

#: Names that the operators use inside themselves.
CLASHING = ("row_id", "sha", "fp", "size", "start", "n", "cls", "k_id", "k_text", "row", "key", "root", "block", "unit")


@pytest.fixture
def make(spark):
    """Documents from (doc_id, text, lang, source), with extra columns that clash with inner names."""
    def frame(rows):
        full = [(*r, len(r[1] or ""), *[f"x{i}" for i in range(len(CLASHING))]) for r in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)
        return spark.createDataFrame(full, schema).repartition(3)
    return frame


@pytest.fixture
def odd(make):
    """Null and empty texts, null ids, one character, white space, a long text without spaces, a long one, repeated rows."""
    long_text = " ".join(f"word{i % 977} other{i % 331}" for i in range(30_000))
    return make([(1, None, None, None), (2, "", "en", "a"), (3, " \t\n", "en", None), (4, "x", None, "a"), (5, "y" * 70_000, "en", "b"),
                 (6, long_text, "en", "b"), (7, long_text, "en", "b"), (7, long_text, "en", "b"), (8, "été 12 \U0001f600 ▁ z", "fr", "b"),
                 (None, "no id here at all", "en", "a"), (None, "no id here at all", "en", "a"), (9, "Same  text\there", "en", "a"),
                 (10, "Same text here", "en", "c")])
