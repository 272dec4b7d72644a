"""Benchmark decontamination: Wu-Manber multi-pattern search over words.

Every window of ten consecutive words of a benchmark item is a test string; an item of fewer words is one shorter string.
Strings of one length share a shift table: for each block of two words, how far the search may move on when a document
shows that block at the end of the current position. Blocks that no string holds skip nearly a whole string. Where the
shift is zero, the strings that end in this block are looked up in its bucket by their first block, and compared word by
word. Documents are never shuffled for one block of strings: they stream past its tables.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vitalgrid.llm.common import byte_words, rows_without
from vitalgrid.session import stored

WINDOW, BLOCK = 10, 2
#: What one set of tables holds; more strings are searched block after block.
MOST_STRINGS, MOST_BYTES = 200_000, 16 << 20
#: Strings of one stored piece of an item.
PIECE = 1_000
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

PIECES = "item_id string, piece long, words array<binary>, strings long, bytes long"
SPANS = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
FOUND = "doc_id long, k_text long, n_words long, spans array<struct<lo:long,hi:long>>, items array<string>"


def cut_items(batches):
    """Items as pieces of at most PIECE strings; neighbours overlap so that no window is lost."""
    for batch in batches:
        rows = []
        for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()):
            words = [w for run in byte_words(text or b"", WORD) for w in run]
            for piece, lo in enumerate(range(0, max(1, len(words) - WINDOW + 1), PIECE)):
                own = words[lo : lo + PIECE + WINDOW - 1]
                if own:
                    rows.append((item, piece, own, max(1, len(own) - WINDOW + 1), sum(map(len, own))))
        names = ("item_id", "piece", "words", "strings", "bytes")
        types = (pa.string(), pa.int64(), pa.list_(pa.binary()), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)


def tables(pieces) -> list:
    """Shift table and buckets for each length of strings, from (item_id, words): plain lists and dictionaries.

    A bucket holds, by first block, the strings that end in a block, each with the items it comes from.
    """
    owners: dict = {}
    for item, words in pieces:
        words = [bytes(w) for w in words]
        for lo in range(max(1, len(words) - WINDOW + 1)):
            owners.setdefault(tuple(words[lo : lo + WINDOW]), set()).update(() if item is None else (item,))
    found = []
    for length in sorted({len(s) for s in owners}):
        b = min(BLOCK, length)
        shift: dict = {}
        buckets: dict = {}
        for string, items in owners.items():
            if len(string) != length:
                continue
            for end in range(b, length + 1):
                block = string[end - b : end]
                shift[block] = min(shift.get(block, length), length - end)
            buckets.setdefault(string[-b:], {}).setdefault(string[:b], []).append((string, sorted(items)))
        found.append((length, b, shift, buckets))
    return found


def occurrences(words: list, found: list):
    """(start, end, items) of each string of the tables in a list of words."""
    n = len(words)
    for length, b, shift, buckets in found:
        furthest, at = length - b + 1, length
        while at <= n:
            block = tuple(words[at - b : at])
            step = shift.get(block, furthest)
            if step:
                at += step
                continue
            lo = at - length
            for string, items in buckets[block].get(tuple(words[lo : lo + b]), ()):
                if tuple(words[lo:at]) == string:
                    yield lo, at, items
            at += 1


def merged(spans: list) -> list:
    """Union of half-open spans, ascending."""
    out: list = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return out


def hits_of(text: bytes, found: list) -> tuple[int, list, list]:
    """Number of words, merged spans of hit words and sorted items of one text; its words are held run by run."""
    n, carry, spans, items = 0, [], [], set()
    for run in byte_words(text, WORD):
        first, words = n - len(carry), carry + run
        for lo, hi, own in occurrences(words, found):
            spans.append((first + lo, first + hi))
            items.update(own)
        n += len(run)
        carry = words[max(0, len(words) - WINDOW + 1) :]
        if len(spans) > 1:
            spans = [tuple(s) for s in merged(spans)]
    return n, [{"lo": lo, "hi": hi} for lo, hi in merged(spans)], sorted(items)


def searcher(held):
    def search(batches):
        for batch in batches:
            told = [hits_of(t or b"", held.value) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("k_text"), pa.array([t[0] for t in told], pa.int64()),
                 pa.array([t[1] for t in told], SPANS), pa.array([t[2] for t in told], pa.list_(pa.string()))],
                ["doc_id", "k_text", "n_words", "spans", "items"])
    return search


def blocks_of(benchmark: DataFrame, item_col: str, text_col: str) -> tuple[DataFrame, int]:
    """Pieces of all items with the number of their ``block``; no block is far above MOST_STRINGS or MOST_BYTES."""
    pieces = stored(benchmark.select(F.col(item_col).cast("string").alias("item_id"), F.col(text_col).cast("binary").alias("text"))
                    .mapInArrow(cut_items, PIECES), "test-strings")
    total = pieces.agg(F.sum("strings").alias("s"), F.sum("bytes").alias("b"), F.count("*").alias("n")).first()
    blocks = max(1, math.ceil((total.s or 0) / MOST_STRINGS), math.ceil((total.b or 0) / MOST_BYTES))
    while True:
        dealt = pieces.withColumn("block", F.pmod(F.xxhash64("item_id", "piece"), F.lit(blocks)))
        most = dealt.groupBy("block").agg(F.sum("strings").alias("s"), F.sum("bytes").alias("b")).agg(F.max("s").alias("s"), F.max("b").alias("b")).first()
        if blocks == 1 or blocks >= total.n or ((most.s or 0) <= 1.5 * MOST_STRINGS and (most.b or 0) <= 1.5 * MOST_BYTES):
            return dealt, blocks
        blocks *= 2


def hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
         item_text: str = "text") -> DataFrame:
    """doc_id, k_text (hash of the text), n_words, spans (merged, of hit words), items (ids, sorted as strings) of each row.

    Words are found after A-Z became a-z: digits, a-z and everything beyond ASCII. Null and empty texts have no words; an
    item without words is no test string. Rows that share an item id are one item; strings of a null id hit, but name no
    item. Repeated rows stay, each with its result; null document ids stay null. Empty tables give no rows or no hits. Other
    columns are not looked at. A text's words are held a run of a megabyte at a time.

    Tables of more strings than MOST_STRINGS are searched block by block, so that neither driver nor tasks hold more.
    """
    spark = docs.sparkSession
    pieces, blocks = blocks_of(benchmark, item_col, item_text)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("k_text"),
                       F.col(text_col).cast("binary").alias("text"))
    passes = []
    for block in range(blocks):
        own = pieces.filter(F.col("block") == block).select("item_id", "words").collect()
        held = spark.sparkContext.broadcast(tables([(r.item_id, r.words) for r in own]))
        passes.append(slim.mapInArrow(searcher(held), FOUND))
    if blocks == 1:
        return passes[0]
    passes = [stored(p if k == 0 else p.filter(F.size("spans") > 0), "test-hits") for k, p in enumerate(passes)]
    some = passes[0].filter(F.size("spans") > 0)
    for p in passes[1:]:
        some = some.union(p)
    whole = (some.distinct().groupBy("doc_id", "k_text")
             .agg(F.first("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"),
                  F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
             .mapInArrow(settled, FOUND)
             .select(F.col("doc_id").alias("w_id"), F.col("k_text").alias("w_text"), F.col("spans").alias("w_spans"), F.col("items").alias("w_items")))
    return (passes[0].join(whole, F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("k_text") == F.col("w_text")), "left")
            .select("doc_id", "k_text", "n_words", F.coalesce("w_spans", "spans").alias("spans"), F.coalesce("w_items", "items").alias("items")))


def settled(batches):
    """Merges the spans that several blocks found in a text."""
    for batch in batches:
        spans = [[{"lo": lo, "hi": hi} for lo, hi in merged([(s["lo"], s["hi"]) for s in own])] for own in batch.column("spans").to_pylist()]
        at = batch.schema.get_field_index("spans")
        yield batch.set_column(at, "spans", pa.array(spans, SPANS))


def report(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated from ``hits``."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["hi"] - x["lo"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows without any hit, with their columns."""
    found = hits(docs, benchmark, id_col, text_col).filter(F.size("spans") > 0)
    return rows_without(docs, found.select(F.col("doc_id").alias("k_id"), "k_text").distinct(), id_col, text_col)
