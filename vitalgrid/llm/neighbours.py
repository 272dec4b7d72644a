"""Nearest neighbours by a block matrix join.

Vectors are packed into blocks; a tile is a block of queries against a block of candidates. A tile multiplies int8 codes
and bounds each product's quantisation error; pairs whose upper bound reaches the query's 20th best lower bound survive
and are computed again in double precision on the original vectors. A task keeps one heap a query over its tiles, and
heaps are merged in two steps. The bounds are strict, so the result is exact.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from vitalgrid.session import stored

#: Vectors of a block. Candidates are sent once for every query block, queries once for every strip of candidate blocks.
QUERY_BLOCK, CANDIDATE_BLOCK, STRIP = 2048, 2048, 4
PACKED = "dims int, block long, n int, ids binary, vectors binary"


def codes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, their scale, the norm of what they restore, and the norm of what they miss, of each row."""
    scale = np.abs(x).max(1, initial=0) / 127
    q = np.rint(x / scale[:, None]).astype(np.int8)
    restored = q * scale[:, None]
    return q, scale, np.linalg.norm(restored, axis=1), np.linalg.norm(x - restored, axis=1)


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, summed from the first dimension to the last in double precision."""
    return np.cumsum(a * b, axis=1)[:, -1]


def tile(queries: tuple, candidates: tuple, heaps: dict[int, list], k: int) -> None:
    """Adds a tile's survivors to the heaps; a heap holds (score, -vec_id), the worst first."""
    (q_ids, q_x, (qc, qs, qn, qm)), (c_ids, c_x, (cc, cs, cn, cm)) = queries, candidates
    step = max(1, (1 << 22) // max(1, len(c_ids)))
    for at in range(0, len(q_ids), step):
        own = slice(at, at + step)
        # products of int8 codes are whole numbers under 2**24 for up to 1,040 dimensions: exact in float32
        kind = np.float32 if q_x.shape[1] <= 1040 else np.float64
        near = (qc[own].astype(kind) @ cc.astype(kind).T).astype(float) * qs[own, None] * cs
        # |<u,v> - <u',v'>| <= |u - u'| |v| + |u'| |v - v'|, and |v| <= |v'| + |v - v'|
        slack = (qm[own, None] * (cn + cm) + qn[own, None] * cm) * (1 + 1e-9) + 1e-12
        near[q_ids[own, None] == c_ids[None, :]] = -np.inf
        for i in range(len(near)):
            heap = heaps.setdefault(int(q_ids[at + i]), [])
            low = near[i] - slack[i]
            least = np.partition(low, -k)[-k] if len(low) > k else -np.inf
            if len(heap) == k:
                least = max(least, heap[0][0])
            some = np.flatnonzero((near[i] + slack[i] >= least) & (near[i] > -np.inf))
            scores = exact(np.broadcast_to(q_x[at + i], (len(some), q_x.shape[1])), c_x[some])
            for entry in zip(scores.tolist(), (-c_ids[some]).tolist()):
                if len(heap) < k:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)


def unpacked(row) -> tuple:
    x = np.frombuffer(row["vectors"], np.float64).reshape(row["n"], row["dims"])
    return np.frombuffer(row["ids"], np.int64), x, codes(x)


def pack(pdf: pd.DataFrame) -> pd.DataFrame:
    x = np.stack(pdf["v"].to_list()).astype(np.float64)
    return pd.DataFrame({"dims": [x.shape[1]], "block": pdf["block"].to_list()[:1], "n": [len(pdf)], "ids": [pdf["vec_id"].to_numpy(np.int64).tobytes()],
                         "vectors": [x.tobytes()]})


def usable(v: Column) -> Column:
    """A vector without null or non-finite components, and not zero."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0)


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k candidates of largest inner product of each query row, ties to smaller ids.

    Null, zero and non-finite vectors and null ids take no part. Vectors of different length are not compared with one
    another: each length is searched apart. A row
    that repeats a query's id is not its neighbour; repeated rows of one id count once (the first in vector order).
    A query with fewer candidates than k gets them all; an empty table gives an empty result.
    """
    named = vectors.withColumn("q_", is_query).select(F.col(id_col).cast("long").alias("vec_id"), F.col("q_"),
                                                      F.col(vector_col).cast("array<double>").alias("v"))
    rows = stored(named.filter(F.col("vec_id").isNotNull() & usable(F.col("v"))).groupBy("vec_id")
                  .agg(F.min("v").alias("v"), F.max("q_").alias("q")), "nearest-rows")
    # lengths are few or, if they differ from row to row, have few vectors each; they stay a table, joined to the rows
    sizes = stored(rows.groupBy(F.size("v").alias("dims")).agg(F.count("*").alias("n"), F.count_if("q").alias("n_q"))
                   .withColumns({"q_blocks": F.greatest(F.ceil(F.col("n_q") / QUERY_BLOCK), F.lit(1)),
                                 "c_blocks": F.greatest(F.ceil(F.col("n") / CANDIDATE_BLOCK), F.lit(1))})
                   .filter("n_q > 0").withColumn("strips", F.ceil(F.col("c_blocks") / STRIP)), "nearest-sizes")
    sized = rows.withColumn("dims", F.size("v")).join(sizes, "dims")

    def packed(df: DataFrame, blocks: str) -> DataFrame:
        block = F.pmod(F.xxhash64("vec_id"), F.col(blocks))
        blocked = df.select("dims", block.alias("block"), "vec_id", "v").groupBy("dims", "block").applyInPandas(pack, PACKED)
        return blocked.join(sizes.select("dims", "q_blocks", "strips"), "dims")

    # a tile strip is one query block with STRIP candidate blocks of its length; both sides know which strips they belong to
    left = (packed(sized.filter("q"), "q_blocks").withColumnRenamed("block", "q_block")
            .withColumn("strip", F.explode(F.sequence(F.lit(0).cast("long"), F.col("strips") - 1))))
    right = (packed(sized, "c_blocks").withColumn("strip", F.col("block") % F.col("strips")).drop("block")
             .withColumn("q_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("q_blocks") - 1))))

    def strip(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        heaps: dict[int, list] = {}
        if len(queries) and len(candidates):
            own = unpacked(queries.iloc[0])
            for i in range(len(candidates)):
                tile(own, unpacked(candidates.iloc[i]), heaps, k)
        found = [(q, -v, s) for q, heap in heaps.items() for s, v in heap]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    heaps = (left.groupBy("dims", "q_block", "strip").cogroup(right.groupBy("dims", "q_block", "strip"))
             .applyInPandas(strip, "query_id long, vec_id long, score double"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # Spark keeps the k best of each query in every task before it shuffles, then merges them
    return (heaps.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
