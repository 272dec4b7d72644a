"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

The words of a source form one stream, cut into equal blocks. A source's target becomes an exact quota of blocks. The root
of a binary tree over the output shards holds all quotas; every node splits its vector between its halves by a
multivariate hypergeometric draw, so quotas add up exactly at every level. A shard so gets, of each source, a range of
draw numbers; draw number d of a source is block pi(d), pi a keyed permutation of the block numbers, so draws are disjoint
without any sort. Each shard shuffles its own draws.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from vitalgrid.llm.common import WORD, text_or_empty
from vitalgrid.session import stored

#: Fixed by the contract: weights in turn, the share of all words to draw, and the most copies of a document.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
#: Words of a block at most; a small source is cut into about BLOCKS_LEAST blocks. All blocks number MOST_BLOCKS at most,
#: beyond that they grow with the corpus (numpy's hypergeometric draw needs counts under 1e9).
BLOCK_WORDS, BLOCKS_LEAST, MOST_BLOCKS = 256, 1024, 1 << 28
#: Words of an output shard, and rows of a bucket within which positions are summed.
SHARD_WORDS, BUCKET_ROWS = 1 << 22, 1 << 11


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target, block_words from (source, source_size); sources by code point, null last.

    Shares are reshared until none is above its cap. In order of cap by weight the capped sources come first, so the
    final share of one weight unit follows from running sums over the sources, of which there are few.
    """
    every = Window.partitionBy(F.lit(0))
    by_name = every.orderBy(F.col("source").isNull(), F.col("source"))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.row_number().over(by_name) - 1) % len(WEIGHTS) + 1)
    by_cap = every.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), F.col("source"))
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    d = (sizes.withColumn("w", weight).withColumn("cap", MOST * F.col("source_size"))
         .withColumn("total", F.sum("source_size").over(every)).withColumn("w_all", F.sum("w").over(every))
         .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
         .withColumn("w_before", F.coalesce(F.sum("w").over(before), F.lit(0))))
    unit = (SHARE * F.col("total") - F.col("cap_before")) / (F.col("w_all") - F.col("w_before"))
    d = d.withColumn("unit", unit).withColumn("place", F.row_number().over(by_cap))
    d = d.withColumn("unit", F.min(F.when(F.col("unit") * F.col("w") <= F.col("cap"), F.struct("place", "unit")))
                     .over(every)["unit"])
    block = F.least(F.lit(BLOCK_WORDS), F.floor(F.col("source_size") / BLOCKS_LEAST))
    floor = F.ceil(F.col("total") / MOST_BLOCKS)
    return d.select("source", "source_size",
                    F.least(F.coalesce(F.col("unit") * F.col("w"), F.col("cap")), F.col("cap")).cast("double").alias("target"),
                    F.greatest(F.lit(1), block, floor).cast("long").alias("block_words"))


def quotas(shares: DataFrame) -> DataFrame:
    """Adds blocks (of a source) and quota (draws from it, up to MOST times its blocks)."""
    blocks = F.ceil(F.col("source_size") / F.col("block_words")).cast("long")
    return shares.withColumn("blocks", blocks).withColumn(
        "quota", F.least(F.round(F.col("target") / F.col("block_words")).cast("long"), MOST * F.col("blocks")))


def shard_ranges(plan: DataFrame, shards: int, seed: int) -> DataFrame:
    """shard, source_no, lo, hi, factor: the draw numbers of each source that a shard gets.

    Every shard walks its own path down the tree. The draw at a node depends on the node and the seed alone, so all
    shards below it see the same split, on any executor and in any rerun.
    """
    known = plan.select("source_no", "quota", "blocks").orderBy("source_no").collect()  # one row a source
    quota = [int(r.quota) for r in known]
    factors = [multiplier(max(1, int(r.blocks))) for r in known]

    def walk(frames):
        for pdf in frames:
            out = []
            for shard in pdf["id"]:
                lo, hi, left, start = 0, shards, np.array(quota, np.int64), np.zeros(len(quota), np.int64)
                while hi - lo > 1:
                    mid = (lo + hi) // 2
                    draw = np.random.default_rng([seed, lo, hi]).multivariate_hypergeometric(
                        left, int(left.sum()) * (mid - lo) // (hi - lo), method="marginals")
                    if shard < mid:
                        hi, left = mid, draw
                    else:
                        lo, left, start = mid, left - draw, start + draw
                out += [(shard, i, start[i], start[i] + left[i], factors[i]) for i in range(len(quota)) if left[i]]
            yield pd.DataFrame(out, columns=["shard", "source_no", "lo", "hi", "factor"])

    return (plan.sparkSession.range(shards, numPartitions=min(shards, 256))
            .mapInPandas(walk, "shard long, source_no int, lo long, hi long, factor long"))


def multiplier(n: int) -> int:
    """The first number from n / golden ratio on that is coprime to n: multiples of it visit 0..n-1 evenly."""
    m = max(1, int(n * 0.6180339887))
    while math.gcd(m, n) > 1:
        m += 1
    return m


def permuted(x: Column, n: Column, factor: Column, key: Column) -> Column:
    """A keyed permutation of 0..n-1; ``factor`` is coprime to n."""
    return (x * factor + F.pmod(key, n)) % n


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        seed: int = 7) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, shares, draws) of the mix.

    rows: row_id, row (own columns), doc_id, source, size, start (place in the source's stream). shares: one row a
    source. draws: shard, place (order within the shard), row_id, copy (0 or 1), word_from, word_to. Null text has size 0,
    null is a source of its own, an empty table gives empty frames. Places follow hashes of the rows' content, so they do
    not depend on partitions; rows that repeat one another are interchangeable.
    """
    spark = docs.sparkSession
    spread = F.xxhash64(F.col(id_col), F.col(text_col))
    rows = stored(docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("doc_id"),
                              F.col(source_col).alias("source"), spread.alias("spread"),
                              F.regexp_count(text_or_empty(text_col), F.lit(WORD)).cast("long").alias("size"))
                  .withColumn("row_id", F.monotonically_increasing_id()), "mix-rows", "zstd")
    buckets = max(1, rows.count() // BUCKET_ROWS)
    narrow = rows.select("row_id", "doc_id", "source", "spread", "size", F.pmod("spread", F.lit(buckets)).alias("bucket"))
    sums = stored(narrow.groupBy("source", "bucket").agg(F.sum("size").alias("size")), "mix-buckets")
    plan = quotas(targets(sums.groupBy("source").agg(F.sum("size").alias("source_size"))))
    numbered = Window.partitionBy(F.lit(0)).orderBy(F.col("source").isNull(), F.col("source"))
    plan = stored(plan.withColumn("source_no", (F.row_number().over(numbered) - 1).cast("int")), "mix-plan")
    words = plan.agg(F.sum(F.col("quota") * F.col("block_words")).alias("n")).first().n or 0
    shards = max(1, round(words / SHARD_WORDS))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ahead = sums.select(F.col("source").alias("s_source"), F.col("bucket").alias("s_bucket"),
                        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("ahead"))
    within = (Window.partitionBy("source", "bucket").orderBy("spread", "doc_id", "row_id")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = (narrow.filter("size > 0").withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
              .join(ahead, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("bucket") == F.col("s_bucket")))
              .select("row_id", "source", "size", (F.col("ahead") + F.col("inside")).alias("start")))
    shares = plan.select(F.col("source").alias("p_source"), "source_no", "source_size", "target", "block_words", "blocks")
    first, last = (F.floor(x / F.col("block_words")) for x in (F.col("start"), F.col("start") + F.col("size") - 1))
    pieces = (placed.join(shares, F.col("source").eqNullSafe(F.col("p_source")))  # one row a source: Spark broadcasts it while it is small
              .withColumn("block", F.explode(F.sequence(first.cast("long"), last.cast("long")))))
    lo = F.greatest(F.col("block") * F.col("block_words") - F.col("start"), F.lit(0))
    hi = F.least((F.col("block") + 1) * F.col("block_words") - F.col("start"), F.col("size"))
    pieces = pieces.select("row_id", "source_no", "block", lo.alias("word_from"), hi.alias("word_to"))
    key = F.xxhash64(F.lit(seed), F.col("source_no"), F.col("copy"))
    drawn = (shard_ranges(plan, shards, seed)
             .withColumn("draw", F.explode(F.sequence(F.col("lo"), F.col("hi") - 1)))
             .join(plan.select("source_no", "blocks"), "source_no")
             .withColumn("copy", F.floor(F.col("draw") / F.col("blocks")).cast("int"))
             .withColumn("block", permuted(F.col("draw") % F.col("blocks"), F.col("blocks"), F.col("factor"), key)))
    drawn = drawn.select("shard", "source_no", "copy", "block").hint("merge")  # grows with the corpus: never broadcast
    draws = drawn.join(pieces, ["source_no", "block"])
    draws = draws.select("shard", F.xxhash64(F.lit(seed + 1), "source_no", "copy", "block", "word_from").alias("place"),
                         "row_id", "copy", "word_from", "word_to")
    return rows, plan, draws


def taken(docs: DataFrame, **names) -> DataFrame:
    """doc_id, size, source_size, target, taken of each row."""
    rows, plan, draws = mix(docs, **names)
    got = draws.groupBy("row_id").agg(F.sum(F.col("word_to") - F.col("word_from")).alias("taken"))
    shares = plan.select(F.col("source").alias("p_source"), "source_size", "target")
    return (rows.select("row_id", "doc_id", "source", "size").join(got, "row_id", "left")
            .join(shares, F.col("source").eqNullSafe(F.col("p_source")))
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken")))


def drawn_rows(docs: DataFrame, text_col: str = "text", **names) -> DataFrame:
    """shard, place, spread, copy, and ``row``: a row for each copy of a document of which words were drawn, with the columns
    of ``docs``.

    A document drawn whole keeps its text as it is; of one drawn in part, the drawn words stand in order, joined by spaces.
    It goes to the shard of its first drawn block, so that no document is torn; place and spread order a shard.
    """
    rows, _, draws = mix(docs, text_col=text_col, **names)
    first = F.min(F.struct("word_from", "shard", "place"))
    parts = (draws.groupBy("row_id", "copy")
             .agg(F.sort_array(F.collect_list(F.struct("word_from", "word_to"))).alias("parts"),
                  F.sum(F.col("word_to") - F.col("word_from")).alias("n"), first.alias("first")))
    all_words = F.regexp_extract_all(text_or_empty("text_"), F.lit(f"({WORD})"), F.lit(1))
    some = F.array_join(F.flatten(F.transform(
        "parts", lambda p: F.slice(F.col("words_"), (p["word_from"] + 1).cast("int"),
                                   (p["word_to"] - p["word_from"]).cast("int")))), " ")
    got = (rows.select("row_id", "size", "spread", "row").join(parts, "row_id").withColumn("text_", F.col(f"row.{text_col}"))
           .withColumn("words_", F.when(F.col("n") < F.col("size"), all_words))
           .withColumn("text_", F.when(F.col("n") == F.col("size"), F.col("text_")).otherwise(some)))
    own = F.struct(*[F.col("text_").alias(c) if c == text_col
                     else F.length("text_").cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
                     else F.col(f"row.{c}").alias(c) for c in docs.columns])
    # documents of one block share its place: their content's hash orders them
    place = F.xxhash64("first.place", "spread", "copy")
    return got.select("first.shard", place.alias("place"), "spread", "copy", own.alias("row"))


def mixed(docs: DataFrame, text_col: str = "text", **names) -> DataFrame:
    """The mix itself, with the columns of ``docs``, in no order: dealing the rows to their shards is left to ``sharded``, as
    it shuffles all texts once more."""
    return drawn_rows(docs, text_col, **names).select("row.*")


def sharded(docs: DataFrame, text_col: str = "text", **names) -> DataFrame:
    """shard, place, ``row`` of the mix: each shard in one partition, shuffled by itself."""
    dealt = drawn_rows(docs, text_col, **names).repartition("shard")
    return dealt.sortWithinPartitions("shard", "place", "spread", "copy").select("shard", "place", "row")


def write_shards(docs: DataFrame, path: str, text_col: str = "text", **names) -> None:
    """One folder a shard, ``number=...``, whose files hold its rows in shuffled order."""
    out = sharded(docs, text_col, **names).select(F.col("shard").alias("number"), "row")
    out.write.partitionBy("number").option("compression", "zstd").parquet(path)
