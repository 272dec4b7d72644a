"""Ranked lexical search over a length-stratified index.

Documents are cut into segments. In a segment, documents of one normaliser ``m`` form a stratum; the postings of a term
are grouped by stratum and, within it, by occurrences ``tf``, highest first. A posting's impact depends on ``m`` and
``tf`` alone, so it is computed once a group, however many documents and items share it. For an item, the greatest tf of
each of its terms bounds what any document of a stratum can score; strata are visited by falling bound until the next
bound is below the item's k-th score. Segments are searched apart, and their best are merged.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from vitalgrid.llm.common import byte_words
from vitalgrid.session import stored

TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
TERM_SQL = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
#: Words of a segment, and items searched together in a task.
SEGMENT_WORDS, ITEM_BLOCK = 2_000_000, 4_096
#: Share (percent) of the length in the normaliser, and the scale of impacts.
SLOPE, SCALE = 50, 1_000_000_000

INDEX = "segment long, term string, df long, m array<long>, tf array<int>, size array<int>, slot array<int>, docs array<long>"
ARROW = pa.schema([("segment", pa.int64()), ("term", pa.string()), ("df", pa.int64()), ("m", pa.list_(pa.int64())), ("tf", pa.list_(pa.int32())),
                   ("size", pa.list_(pa.int32())), ("slot", pa.list_(pa.int32())), ("docs", pa.list_(pa.int64()))])
#: Rows of the index sent to Spark at a time.
ROWS_AT_ONCE = 20_000


def lists(values: np.ndarray, starts: np.ndarray, kind) -> pa.ListArray:
    """One list for each stretch of ``values`` between neighbouring ``starts``."""
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values, kind))


class Segment:
    """Documents gathered by a task until they are inverted."""

    def __init__(self):
        self.vocabulary, self.ids, self.lengths, self.runs, self.words = {}, [], [], [], 0

    def add(self, doc_id, text: bytes) -> None:
        n, vocabulary = 0, self.vocabulary
        for run in byte_words(text, TERM):
            self.runs.append(np.fromiter((vocabulary.setdefault(w, len(vocabulary)) for w in run), np.int64, len(run)))
            n += len(run)
        if n:
            self.ids.append(doc_id)
            self.lengths.append(n)
            self.words += n

    def batches(self, number: int, docs: int, terms: int):
        """The segment's rows of the index: its documents by slot, then the postings of each term."""
        lengths, ids = np.array(self.lengths, np.int64), self.ids
        order = sorted(range(len(ids)), key=lambda k: (ids[k] is None, ids[k] or 0))  # slots ascend with ids, null ids last
        slot = np.empty(len(ids), np.int64)
        slot[order] = np.arange(len(ids))
        yield self.rows([number], [None], [0], *[pa.array([[]], pa.list_(k)) for k in (pa.int64(), pa.int32(), pa.int32(), pa.int32())],
                        pa.array([[ids[k] for k in order]], pa.list_(pa.int64())))
        keys = np.concatenate(self.runs) * len(ids) + np.repeat(slot, lengths)
        keys, tf = np.unique(keys, return_counts=True)
        term, slot = np.divmod(keys, len(ids))
        m = (100 - SLOPE + (SLOPE * lengths[order] * docs) // terms)[slot]
        order = np.lexsort((slot, -tf, m, term))
        term, m, tf, slot = term[order], m[order], tf[order], slot[order]
        new_term = np.r_[True, term[1:] != term[:-1]]
        group = np.flatnonzero(new_term | np.r_[True, (m[1:] != m[:-1]) | (tf[1:] != tf[:-1])])
        of_term = np.flatnonzero(new_term)
        first = np.searchsorted(group, of_term)
        size = np.diff(np.r_[group, len(term)])
        names = list(self.vocabulary)
        for lo in range(0, len(of_term), ROWS_AT_ONCE):
            t = of_term[lo : lo + ROWS_AT_ONCE]
            ends = np.r_[of_term, len(term)][lo : lo + len(t) + 1]
            cuts = np.r_[first, len(group)][lo : lo + len(t) + 1]
            g = slice(cuts[0], cuts[-1])
            yield self.rows(np.full(len(t), number), [names[k].decode() for k in term[t]], np.diff(ends),
                            lists(m[group[g]], cuts - cuts[0], pa.int64()), lists(tf[group[g]], cuts - cuts[0], pa.int32()),
                            lists(size[g], cuts - cuts[0], pa.int32()), lists(slot[ends[0] : ends[-1]], ends - ends[0], pa.int32()),
                            pa.nulls(len(t), pa.list_(pa.int64())))

    @staticmethod
    def rows(number, term, df, *rest) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(number, pa.int64()), pa.array(term, pa.string()), pa.array(df, pa.int64()), *rest], schema=ARROW)


def inverter(docs: int, terms: int, segment_words: int):
    def invert(batches):
        number, segment = TaskContext.get().partitionId() << 32, Segment()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                segment.add(doc_id, text or b"")
                if segment.words >= segment_words:
                    yield from segment.batches(number, docs, terms)
                    number, segment = number + 1, Segment()
        if segment.words:
            yield from segment.batches(number, docs, terms)
    return invert


def built(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_words: int = SEGMENT_WORDS) -> tuple[DataFrame, int]:
    """The stored index of all rows, and N, the number of rows with a term.

    Index: one row a segment and term (df, and postings grouped by m and tf: sizes and slots), and one row a segment
    without term that holds the ids of its slots. Null and empty texts, and texts without terms, are in no segment. Each
    repeated row is a document of its own. A text longer than a segment is a segment of its own.
    """
    counts = docs.select(F.regexp_count(F.col(text_col), F.lit(TERM_SQL)).alias("n"))
    totals = counts.agg(F.count(F.nullif(F.col("n"), F.lit(0))).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    index = slim.mapInArrow(inverter(totals.docs, max(1, totals.terms), segment_words), INDEX)
    return stored(index, "lexical-index", "zstd"), totals.docs


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the ranges that begin at ``starts``, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes - starts, sizes)


def best_slots(score: np.ndarray, k: int) -> np.ndarray:
    """Slots of the k highest scores above 0, equal ones by slot."""
    hit = np.flatnonzero(score > 0)
    if len(hit) > k:
        least = np.partition(score[hit], len(hit) - k)[len(hit) - k]
        hit = hit[score[hit] >= least]
    return hit[np.lexsort((hit, -score[hit]))][:k]


def searched(k: int):
    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        counts = np.array([len(x) for x in pdf["m"]])
        m, tf, size, slot = (np.concatenate(pdf[c].to_list()).astype(np.int64) for c in ("m", "tf", "size", "slot"))
        term = np.repeat(np.arange(len(pdf)), counts)
        start, slots = np.cumsum(size) - size, int(slot.max()) + 1
        impact = (SCALE * tf) // (1000 * tf + 20 * m)
        _, stratum = np.unique(m, return_inverse=True)
        strata = int(stratum.max()) + 1
        top = np.r_[True, (term[1:] != term[:-1]) | (stratum[1:] != stratum[:-1])]  # greatest tf of a term in a stratum
        begin, w = np.cumsum(counts) - counts, pdf["w"].to_numpy()
        own: dict = {}
        for t, items in enumerate(pdf["items"]):
            for item in items:
                own.setdefault(int(item), []).append(t)
        rows = []
        for item, terms in own.items():
            groups, weight = ranges(begin[terms], counts[terms]), np.repeat(w[terms], counts[terms])
            gain, at = impact[groups] * weight, stratum[groups]
            bound = np.zeros(strata, np.int64)
            head = top[groups]
            np.add.at(bound, at[head], gain[head])
            order = np.argsort(-bound, kind="stable")
            order = order[bound[order] > 0]
            score, done, step, least = np.zeros(slots, np.int64), 0, 1, 0
            while done < len(order) and bound[order[done]] >= max(least, 1):
                visit = np.zeros(strata, bool)
                visit[order[done : done + step]] = True
                g = np.flatnonzero(visit[at])
                np.add.at(score, slot[ranges(start[groups[g]], size[groups[g]])], np.repeat(gain[g], size[groups[g]]))
                done, step = done + step, step * 2
                found = best_slots(score, k)
                least = int(score[found[-1]]) if len(found) == k else 0
            found = best_slots(score, k)
            rows.append((np.full(len(found), item), found, score[found]))
        number, found, score = (np.concatenate(x) for x in zip(*rows))
        return pd.DataFrame({"segment": pdf["segment"].iloc[0], "number": number, "slot": found, "score": score})
    return search


def search(index: DataFrame, docs: int, items: DataFrame, k: int = 50, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the k highest-scoring rows of ``built`` for each item, above 0, ties by id.

    Items are rows by id: rows that share one (null is one) pool their terms, each counted once. Items without known
    terms have no rows. Null document ids come after all others of their score. Items are searched in blocks, so that a
    task holds one segment's postings of the terms of one block.
    """
    asked = items.select(F.col(item_col).alias("item_id"), F.explode(F.regexp_extract_all(lowered(text_col), F.lit(TERM_SQL), F.lit(0))).alias("term")).distinct()
    asked = stored(asked, "asked-terms")
    numbers = stored(asked.select("item_id").distinct().withColumn("number", F.monotonically_increasing_id()), "asked-items")
    postings = index.filter(F.col("term").isNotNull())
    df = postings.select("term", "df").join(asked.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    w = F.floor(1000 * F.log((2 * F.lit(docs) + 2) / (2 * F.col("df") + 1)))
    block = F.pmod(F.xxhash64("number"), F.lit(max(1, -(-numbers.count() // ITEM_BLOCK)))).cast("int")
    words = (asked.join(numbers.withColumnRenamed("item_id", "n_item"), F.col("item_id").eqNullSafe(F.col("n_item")))
             .groupBy("term", block.alias("block")).agg(F.collect_list("number").alias("items"))
             .join(df.select("term", w.alias("w")), "term"))
    found = (postings.join(stored(words, "asked-words"), "term").drop("docs", "df").groupBy("segment", "block")
             .applyInPandas(searched(k), "segment long, number long, slot long, score long"))
    ids = index.filter(F.col("term").isNull()).select("segment", F.posexplode("docs").alias("slot", "doc_id"))
    best = Window.partitionBy("number").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    named = stored(found, "lexical-found").join(ids, ["segment", "slot"])
    return (named.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).join(numbers, "number")
            .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))


def lowered(text_col: str):
    """The text with A-Z, and nothing else, as a-z."""
    return F.translate(F.col(text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ranked(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """``search`` over the index of ``docs``; empty tables give no rows, other columns are not looked at."""
    index, n = built(docs)
    return search(index, n, items, k)
