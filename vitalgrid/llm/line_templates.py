"""Line deduplication with a log-template tree.

A line's tokens that hold a digit are variable fields, if enough other tokens are left; else, as in rows of figures, the
line is compared as it is. The tree has a fixed depth: lines go down by their number of tokens
and their leading tokens. A line of few tokens, as is any line of a script without blanks, is a leaf of its own and recurs
as a whole; only lines of very few bytes stay as they are. A token's support is how often its leaf has it at its place,
counted by distinct lines and their documents. Most of a line's tokens have at least the line's usual support; a token of
no more than a part of that varies and is generalised to a field, if enough different lines then share the template. As
supports are only compared with one another, results do not depend on the size of the leaf, and a template that shares its
leaf with a more frequent one is found as well. A template that recurs across documents is kept in its first document and
dropped from the others. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from vitalgrid.llm.common import row_key
from vitalgrid.session import stored

FIELD = "<*>"
#: Leading tokens that choose a branch; lines of under LEAST_TOKENS are whole templates, if they have LEAST_BYTES in UTF-8.
DEPTH, LEAST_TOKENS, LEAST_BYTES = 3, 5, 8
#: Documents in which a template must occur to recur.
LEAST_DOCS = 2
#: Only lines this long are generalised beyond their digits. This share of a line's tokens has its usual support or more and
#: stays constant; a token of at most FIELD_SHARE of the usual support is a field.
GENERAL_TOKENS, CONSTANT_SHARE, FIELD_SHARE = 8, 0.75, 0.5
#: What no field may take of any template: so many tokens, and this share of them, are words.
LEAST_WORDS, WORD_SHARE = 2, 0.5
#: Different lines that must share a template with word fields. Fewer are no evidence that the words vary by template: they
#: may state different facts, and each is compared as it is.
FIELD_LINES = 4
DIGIT_TOKEN = r"(?<!\S)[^\s0-9]*+[0-9]\S*+"

KEY, LINE = ["k_id", "k_text"], ["h1", "h2"]


def enough(words: Column, tokens: Column) -> Column:
    """Whether a template of so many words and tokens in all says more than that there are fields."""
    return (words >= LEAST_WORDS) & (words >= tokens * WORD_SHARE)


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once a row, even where ``use`` has it in a lambda."""
    return F.transform(F.array(value), use)[0]


def lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row a line: document key, line_no (from 0), masked line, its two hashes, leaf (null under LEAST_BYTES)."""
    cut = docs.select(*row_key(id_col, text_col), F.posexplode(F.split(text_col, "\n")).alias("line_no", "line"))
    # most lines have neither digits nor white space but single spaces: the replacements are spared them
    uneven = reduce(or_, [F.col("line").contains(c) for c in ("  ", "\t", "\r", "\x0b", "\f")])
    even = (cut.select(*KEY, "line_no", uneven.alias("uneven"), "line")
            .select(*KEY, "line_no", F.trim(F.when(F.col("uneven"), F.regexp_replace("line", r"\s+", " ")).otherwise(F.col("line")))
                    .alias("line")))
    fields = even.withColumn("fields", F.split(F.when(F.col("line").rlike("[0-9]"), F.regexp_replace("line", DIGIT_TOKEN, FIELD)), " "))
    masked = fields.select(*KEY, "line_no", F.when(enough(F.size(F.array_remove("fields", FIELD)), F.size("fields")),
                                                   F.array_join("fields", " ")).otherwise(F.col("line")).alias("masked"))
    tokens = masked.withColumn("tokens", F.split("masked", " "))
    return tokens.select(*KEY, "line_no", "masked", F.xxhash64("masked").alias("h1"), F.xxhash64(F.lit(1), "masked").alias("h2"),
                         F.when(F.size("tokens") >= LEAST_TOKENS, F.xxhash64(F.size("tokens"), F.slice("tokens", 1, DEPTH)))
                         .when(F.octet_length("masked") >= LEAST_BYTES, F.xxhash64(F.size("tokens"), "masked")).alias("leaf"))


def templates(known: DataFrame, field_lines: int = FIELD_LINES) -> DataFrame:
    """h1, h2, t1, t2 of distinct masked lines (leaf, h1, h2, masked, n_docs): the hashes of a line and of its template."""
    crowded = known.groupBy("leaf").agg(F.count("*").alias("n")).filter("n > 1").select("leaf")
    open_ = known.join(crowded, "leaf", "left_semi").filter(F.size(F.split("masked", " ")) >= GENERAL_TOKENS)
    placed = open_.select("leaf", *LINE, "n_docs", F.posexplode(F.split("masked", " ")).alias("place", "token"))
    # a token without a row here has support 1
    support = (placed.groupBy("leaf", "place", "token").agg(F.sum("n_docs").alias("n")).filter("n > 1")
               .select("leaf", "place", "token", "n"))
    marked = placed.join(support, ["leaf", "place", "token"], "left").withColumn("n", F.coalesce("n", F.lit(1)))
    parts = marked.groupBy("leaf", *LINE).agg(F.collect_list(F.struct("place", "token", "n")).alias("parts"))

    def usual(p: Column) -> Column:
        return F.element_at(F.sort_array(p["n"], asc=False), F.ceil(F.size(p) * CONSTANT_SHARE).cast("int"))

    def cut(p: Column, least: Column) -> Column:
        return F.transform(p, lambda x: F.when(x["n"] > least * FIELD_SHARE, x["token"]).otherwise(FIELD))

    general = once(F.sort_array("parts"), lambda p: once(usual(p), lambda least: once(cut(p, least), lambda c: F.when(
        enough(F.size(F.array_remove(c, FIELD)), F.size(c)), F.array_join(c, " ")))))
    hashed = (parts.select(*LINE, general.alias("general"))
              .select(*LINE, F.xxhash64("general").alias("t1"), F.xxhash64(F.lit(1), "general").alias("t2"), F.isnull("general").alias("none")))
    made = stored(hashed, "template-general").filter("not none").drop("none")
    wide = made.groupBy("t1", "t2").agg(F.count("*").alias("n")).filter(F.col("n") >= field_lines).select("t1", "t2")
    own = known.select(*LINE).join(made.join(wide, ["t1", "t2"], "left_semi"), LINE, "left")
    return own.select(*LINE, F.coalesce("t1", "h1").alias("t1"), F.coalesce("t2", "h2").alias("t2"))


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", field_lines: int = FIELD_LINES) -> DataFrame:
    """k_id, k_text, line_no of each line whose template has an earlier document; documents are ordered by id, null last."""
    # filtered once stored: a filter before that would be pushed down and mask every line twice
    every = stored(lines(docs, id_col, text_col), "template-lines", "zstd").filter("leaf is not null")
    # a leaf of one document cannot hold a recurring template
    busy = stored(every.groupBy("leaf").agg(F.count("*").alias("n"), F.min("k_text").alias("a"), F.max("k_text").alias("b"),
                                      F.min("k_id").alias("c"), F.max("k_id").alias("d"))
            .filter(~(F.col("a").eqNullSafe(F.col("b")) & F.col("c").eqNullSafe(F.col("d")))).select("leaf"), "template-busy")
    crowd = stored(every.join(busy, "leaf", "left_semi"), "template-crowd", "zstd")
    held = crowd.groupBy("leaf", *LINE, *KEY).agg(F.lit(1).alias("one"))
    known = stored(held.groupBy("leaf", *LINE).agg(F.count("*").alias("n_docs"))
                   .join(crowd.groupBy("leaf", *LINE).agg(F.min("masked").alias("masked")), ["leaf", *LINE]), "template-known", "zstd")
    where = stored(held.select(*LINE, *KEY).join(templates(known, field_lines), LINE), "template-where", "zstd")
    first = stored(where.groupBy("t1", "t2", *KEY).agg(F.lit(1).alias("one"))
             .groupBy("t1", "t2").agg(F.count("*").alias("n"), F.min(F.struct(F.col("k_id").isNull(), "k_id", "k_text")).alias("home"))
             .filter(F.col("n") >= LEAST_DOCS)
             .select("t1", "t2", F.col("home.k_id").alias("home_id"), F.col("home.k_text").alias("home_text")), "template-first")
    again = (where.join(first, ["t1", "t2"])
             .filter(~(F.col("k_id").eqNullSafe(F.col("home_id")) & F.col("k_text").eqNullSafe(F.col("home_text"))))
             .select(F.col("k_id").alias("d_id"), F.col("k_text").alias("d_text"), *LINE))
    return crowd.join(again, crowd["k_id"].eqNullSafe(again["d_id"]) & (crowd["k_text"] == again["d_text"])
                      & (crowd["h1"] == again["h1"]) & (crowd["h2"] == again["h2"]), "left_semi").select(*KEY, "line_no")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", field_lines: int = FIELD_LINES) -> DataFrame:
    """doc_id, n_lines, n_dropped, text (without the dropped lines) of each row.

    A template with word fields counts from ``field_lines`` different lines on; below that its lines only recur as they are.

    Null text stays null with 0 lines; a text of which every line is dropped becomes empty. Rows that repeat one another
    are one document and get the same answer. An empty table gives an empty result; other columns are not looked at.
    """
    gone = (dropped_lines(docs, id_col, text_col, field_lines).groupBy(*KEY).agg(F.collect_set("line_no").alias("gone"))
            .select(F.col("k_id").alias("g_id"), F.col("k_text").alias("g_text"), "gone"))
    own = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("k_text"), F.split(text_col, "\n").alias("lines"))
    both = own.join(gone, own["doc_id"].eqNullSafe(gone["g_id"]) & (own["k_text"] == gone["g_text"]), "left")
    count = F.coalesce(F.size("lines"), F.lit(0))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    text = (F.when(F.col("gone").isNull(), F.array_join("lines", "\n"))
            .when(F.size("gone") == F.size("lines"), F.lit(""))
            .otherwise(F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n")))
    return both.select("doc_id", F.greatest(count, F.lit(0)).alias("n_lines"),
                       F.coalesce(F.size("gone"), F.lit(0)).alias("n_dropped"), text.alias("text"))
