"""N-gram Jaccard join by vertical partitioning.

The shingles of all documents have one global order: shingles that a count sketch finds frequent come last, by frequency,
all others by hash. The order is cut into fragments. A document's set so falls into segments; overlaps are counted segment
by segment, each fragment apart, and the partial counts of a pair are summed. Documents with equal sets are one class and
are joined once.

Which pairs to count follows from the same order: two sets of that similarity share a shingle among the first few of each
(prefix), with few enough before it (position), similar sizes, and parity bitmaps that differ in no more bits than the
sets may differ in shingles. These bounds lose no link. Within a prefix shingle, classes are first tried against the most
central one; of the rest only pairs are tried that are not yet in one component. What decides is always the exact count.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from vitalgrid.llm.common import rows_without
from vitalgrid.llm.components import components
from vitalgrid.session import stored

#: Fixed by the contract: words of a shingle, and the least similarity in percent.
WORDS, PERCENT = 4, 85
#: Counters of the frequency sketch and marks of the class filter, whatever the corpus: 4 MB and 8 MB. With very many
#: classes they tell less apart, which costs time and changes no result.
COUNTERS, MARKS = 1 << 20, 1 << 23
#: The sketch counts a shingle when a task meets it again among the last SEEN_FOR shingles, so that the many that occur
#: once do not drown the frequent ones; a task remembers them by slot.
SEEN_SLOTS, SEEN_FOR = 1 << 25, 1 << 22
CELL = 1 << 14
#: Parity bits of a set: a power of two, at least as many as it has shingles and at least LEAST_BITS.
FRAGMENTS, LEAST_BITS = 8, 1024
#: 64-bit words of the parity bitmaps that travel with the keys.
SHORT_LONGS = 8
KEY_BITS = 58
WORDS_KEPT = 150_000
_A = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    """Word hashes of a task, forgotten when they are many."""

    def __missing__(self, word):
        if len(self) > WORDS_KEPT:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def shingles(text: str | None, known: dict) -> np.ndarray:
    """Sorted distinct hashes of the word 4-grams of a text; of a shorter one, the hash of all its words."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    n = min(WORDS, len(words))
    if not n:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    h = np.full(len(w) - n + 1, n, np.uint64)
    for i in range(n):
        h = (h ^ w[i : len(w) - n + 1 + i]) * _A
        h ^= h >> np.uint64(32)
    return np.unique(h)


def least_overlap(a: Column, b: Column) -> Column:
    """Shingles that sets of sizes a and b must share."""
    return F.ceil(PERCENT * (a + b) / F.lit(100 + PERCENT))


def _cells(counts: np.ndarray) -> pd.DataFrame:
    rows = [(c // CELL, zlib.compress(counts[c : c + CELL].tobytes(), 1)) for c in range(0, len(counts), CELL)
            if counts[c : c + CELL].any()]
    return pd.DataFrame(rows, columns=["cell", "counts"])


def gathered(cells: DataFrame, size: int, kind: type) -> np.ndarray:
    """Sum of the tasks' counters, cell by cell; a fixed number of bytes reaches the driver."""
    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(CELL, np.int64)
        for c in pdf["counts"]:
            total += np.frombuffer(zlib.decompress(c), kind)
        total = np.minimum(total, np.iinfo(kind).max).astype(kind)
        return pd.DataFrame({"cell": pdf["cell"].iloc[:1], "counts": [zlib.compress(total.tobytes(), 1)]})

    out = np.zeros(size, kind)
    for r in cells.groupBy("cell").applyInPandas(add, "cell int, counts binary").toLocalIterator():
        out[r["cell"] * CELL : (r["cell"] + 1) * CELL] = np.frombuffer(zlib.decompress(r["counts"]), kind)
    return out


def described(docs: DataFrame) -> DataFrame:
    """Rows with n, cls (digest of the set, null if empty) and parity bits of each document, and cells of the sketch."""
    def read(frames):
        known, counts = _Words(), np.zeros(COUNTERS, np.uint32)
        seen, passed = np.zeros(SEEN_SLOTS, bool), 0
        for pdf in frames:
            rows = []
            for text in pdf["text"]:
                h = shingles(text, known)
                slot = (h & np.uint64(SEEN_SLOTS - 1)).astype(np.int64)
                np.add.at(counts, (h[seen[slot]] >> np.uint64(44)).astype(np.int64), 1)
                seen[slot], passed = True, passed + len(h)
                if passed > SEEN_FOR:
                    seen[:], passed = False, 0
                size = max(LEAST_BITS, 1 << max(0, len(h) - 1).bit_length())
                bits = np.bincount((h & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
                rows.append((len(h), hashlib.blake2b(h.tobytes(), digest_size=16).digest() if len(h) else None,
                             np.packbits(bits.astype(np.uint8)).view(np.int64)))
            out = pd.DataFrame(rows, columns=["n", "cls", "bits"])
            yield out.assign(doc_id=pdf["doc_id"].astype("Int64"), k_text=pdf["k_text"], cell=pd.array([None] * len(out), "Int32"), counts=None)
        cells = _cells(counts)
        yield cells.assign(doc_id=pd.array([None] * len(cells), "Int64"), k_text=pd.array([None] * len(cells), "Int64"),
                           n=pd.array([None] * len(cells), "Int64"), cls=None, bits=None)

    return docs.mapInPandas(read, "doc_id long, k_text long, n long, cls binary, bits array<long>, cell int, counts binary")


def levels_of(counts: np.ndarray) -> np.ndarray:
    """Rank of each counter in the order: 0 up to about the mean, then by powers of two of what exceeds it."""
    mean = counts.mean() if len(counts) else 0.0
    above = counts - (mean + 4 * np.sqrt(mean) + 2)
    return np.where(above > 0, 1 + np.log2(np.maximum(above, 1)), 0).astype(np.uint8)


def keys_of(h: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Places in the global order, ascending: frequent shingles last."""
    level = levels[(h >> np.uint64(44)).astype(np.int64)].astype(np.uint64)
    return np.sort((level << np.uint64(KEY_BITS)) | (h >> np.uint64(64 - KEY_BITS)))


def prefixes(docs: DataFrame, levels) -> DataFrame:
    """cls, n, prefix of each document with shingles."""
    def read(frames):
        known = _Words()
        for pdf in frames:
            rows = []
            for text in pdf["text"]:
                h = shingles(text, known)
                if len(h):
                    prefix = len(h) - -(-PERCENT * len(h) // 100) + 1
                    rows.append((hashlib.blake2b(h.tobytes(), digest_size=16).digest(), len(h),
                                 keys_of(h, levels.value)[:prefix].view(np.int64)))
            yield pd.DataFrame(rows, columns=["cls", "n", "prefix"])

    return docs.mapInPandas(read, "cls binary, n long, prefix array<long>")


def segments(docs: DataFrame, levels, wanted: DataFrame) -> DataFrame:
    """cid, fragment, keys of the classes ``wanted`` (cls, cid, doc_id of one document each).

    Other documents are passed over by a filter of fixed size; what it lets through in error is dropped by the join.
    """
    size = MARKS
    slot = lambda ids: (ids.to_numpy(np.int64).view(np.uint64) * _A >> np.uint64(64 - 23)).astype(np.int64)

    def mark(frames):
        marks = np.zeros(size, np.uint8)
        for pdf in frames:
            marks[slot(pdf["doc_id"])] = 1
        yield _cells(marks)

    cells = wanted.select("doc_id").filter("doc_id is not null").mapInPandas(mark, "cell int, counts binary")
    marks = docs.sparkSession.sparkContext.broadcast(np.packbits(gathered(cells, size, np.uint8) > 0))
    span = (1 << KEY_BITS) // (FRAGMENTS - 1) + 1

    def read(frames):
        known = _Words()
        for pdf in frames:
            rows = []
            ids = pdf["doc_id"].isna()
            at = slot(pdf["doc_id"].fillna(0).astype("int64"))
            take = ids.to_numpy() | ((marks.value[at >> 3] >> (7 - (at & 7)) & 1) > 0)
            for text in pdf["text"][take]:
                h = shingles(text, known)
                if not len(h):
                    continue
                cls, keys = hashlib.blake2b(h.tobytes(), digest_size=16).digest(), keys_of(h, levels.value)
                cuts = np.searchsorted(keys, np.arange(1, FRAGMENTS, dtype=np.uint64) * np.uint64(span))
                rows += [(cls, f, part.view(np.int64)) for f, part in enumerate(np.split(keys, cuts)) if len(part)]
            yield pd.DataFrame(rows, columns=["cls", "fragment", "keys"])

    found = docs.mapInPandas(read, "cls binary, fragment int, keys array<long>")
    once = found.repartition("cls").dropDuplicates(["cls", "fragment"])  # dealt once, for this and the join
    return once.join(wanted.select("cls", "cid"), "cls").drop("cls")


def possible(na: Column, nb: Column, ia: Column, ib: Column) -> Column:
    """Whether sets of these sizes whose first common shingle is at these places (from 0) can be similar enough."""
    return F.least(na - ia, nb - ib) >= least_overlap(na, nb)


def parity_distance() -> Column:
    """Bits in which bits_a and bits_b differ; the longer one is first folded to the other's length."""
    folded = lambda x, y: F.when(F.size(x) > F.size(y), F.zip_with(
        F.slice(x, 1, F.size(y)), F.slice(x, F.size(y) + 1, F.size(y)), lambda p, q: p.bitwiseXOR(q))).otherwise(F.col(x))
    apart = F.zip_with(folded("bits_a", "bits_b"), folded("bits_b", "bits_a"), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    return F.aggregate(apart, F.lit(0), lambda s, x: s + x)


def parity_close() -> Column:
    """Whether the sets a and b can be similar by their parity bitmaps, which differ in at most as many bits as the sets do."""
    return parity_distance() <= F.col("n_a") + F.col("n_b") - 2 * least_overlap(F.col("n_a"), F.col("n_b"))


def short(bits: Column) -> Column:
    """A bitmap folded to SHORT_LONGS at most; its distances are still bounds."""
    folded = F.transform(F.sequence(F.lit(0), F.lit(SHORT_LONGS - 1)), lambda i: F.aggregate(
        F.filter(bits, lambda x, j: j % SHORT_LONGS == i), F.lit(0).cast("long"), lambda s, x: s.bitwiseXOR(x)))
    return F.when(F.size(bits) > SHORT_LONGS, folded).otherwise(bits)


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, levels) -> DataFrame:
    """The links among candidate pairs (a, b), by exact overlaps summed over the fragments."""
    of = lambda s: classes.select(*[F.col(c).alias(f"{c}_{s}") for c in ("cid", "n", "bits")])
    near = (pairs.join(of("a"), F.col("a") == F.col("cid_a")).join(of("b"), F.col("b") == F.col("cid_b"))
            .filter(parity_close())
            .select("a", "b", "n_a", "n_b"))
    near = stored(near, "ngram-pairs")
    ends = near.select(F.col("a").alias("cid")).union(near.select(F.col("b").alias("cid"))).distinct()
    wanted = stored(classes.join(ends, "cid", "left_semi").select("cls", "cid", "doc_id"), "ngram-wanted")
    parts = stored(segments(docs, levels, wanted), "ngram-segments")
    one = parts.select(F.col("cid").alias("a"), F.col("fragment").alias("fragment"), F.col("keys").alias("keys_a"))
    two = parts.select(F.col("cid").alias("b"), F.col("fragment").alias("fragment"), F.col("keys").alias("keys_b"))
    counted = (near.join(one, "a").join(two, ["b", "fragment"])
               .select("a", "b", "n_a", "n_b", F.size(F.array_intersect("keys_a", "keys_b")).alias("common")))
    total = F.sum("common").cast("long")
    return (counted.groupBy("a", "b", "n_a", "n_b").agg(total.alias("common"))
            .filter(100 * F.col("common") >= PERCENT * (F.col("n_a") + F.col("n_b") - F.col("common"))).select("a", "b"))


def joined(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, k_text (hash of the text), n_shingles, component_id, stays of each row.

    Null and wordless texts have no shingles and are their own component. Ids are integers; the smallest one of a
    component names it, null ids last. The rows of that id stay (of several texts with it, the one of smallest hash).
    Rows that repeat one another are one document. Other columns are not looked at; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                        F.xxhash64(text_col).alias("k_text"))
    told = stored(described(texts), "ngram-documents")
    levels = spark.sparkContext.broadcast(levels_of(gathered(
        told.filter("cell is not null").select("cell", "counts"), COUNTERS, np.uint32)))
    rows = told.filter("cell is null").select("doc_id", "k_text", "n", "cls", "bits")
    # a class is known by a short number from here on
    classes = stored(rows.filter("n > 0").groupBy("cls").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"),
                                                             F.first("bits").alias("bits"))
                     .withColumn("cid", F.monotonically_increasing_id()), "ngram-classes")
    numbers = classes.select("cls", "cid")
    placed = (prefixes(texts, levels).groupBy("cls").agg(F.first("n").alias("n"), F.first("prefix").alias("prefix"))
              .join(numbers, "cls").select("cid", F.col("n").cast("int").alias("n"), F.posexplode("prefix").alias("place", "key")))
    at_key = Window.partitionBy("key")
    shared = stored(placed.withColumn("hub", F.min(F.struct("place", "n", "cid")).over(at_key))
                    .withColumn("m", F.count("*").over(at_key)).filter("m > 1").drop("m"), "ngram-shared")
    tried = stored(shared.filter((F.col("cid") != F.col("hub.cid"))
                                 & possible(F.col("n"), F.col("hub.n"), F.col("place"), F.col("hub.place")))
                   .select(F.least("cid", "hub.cid").alias("a"), F.greatest("cid", "hub.cid").alias("b")).distinct(), "ngram-tried")
    links = stored(confirmed(tried, classes, texts, levels), "ngram-links")
    roots = components(links)
    marked = stored(shared.drop("hub").join(roots, F.col("cid") == F.col("node"), "left")
                    .select("key", "cid", "n", "place", F.coalesce("root", "cid").alias("root")), "ngram-marked")
    mixed = marked.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x != y").select("key")
    # what shares a passage meets under many keys: the parity bound is part of the join, so that such pairs are never made
    open_ = marked.join(mixed, "key", "left_semi").join(classes.select("cid", short(F.col("bits")).alias("bits")), "cid")
    a, b = (open_.select("key", *[F.col(c).alias(f"{c}_{s}") for c in ("cid", "n", "place", "root", "bits")]) for s in "ab")
    more = (a.join(b, (a["key"] == b["key"]) & (F.col("cid_a") < F.col("cid_b")) & (F.col("root_a") != F.col("root_b"))
                   & possible(F.col("n_a"), F.col("n_b"), F.col("place_a"), F.col("place_b")) & parity_close())
            .select(F.col("cid_a").alias("a"), F.col("cid_b").alias("b")).distinct().join(tried, ["a", "b"], "left_anti"))
    links = stored(links.union(confirmed(stored(more, "ngram-more"), classes, texts, levels)), "ngram-links")
    roots = components(links)
    some = rows.filter("n > 0").select("doc_id", "k_text", "n", "cls").join(numbers, "cls")
    rooted = stored(some.join(roots, F.col("cid") == F.col("node"), "left")
                    .select("doc_id", "k_text", "n", F.coalesce("root", "cid").alias("root")), "ngram-rooted")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "k_text")
    homes = stored(rooted.groupBy("root").agg(F.min(place).alias("home")), "ngram-homes")
    known = rooted.join(homes, "root").select("doc_id", "k_text", F.col("n").alias("n_shingles"),
                                              F.col("home.doc_id").alias("component_id"), (place == F.col("home")).alias("stays"))
    return known.union(rows.filter("n = 0").select("doc_id", "k_text", "n", "doc_id", F.lit(True)))


def similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of each row; see ``joined``."""
    return joined(docs, id_col, text_col).select("doc_id", "n_shingles", "component_id")


def first_of_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with their columns."""
    gone = joined(docs, id_col, text_col).filter(~F.col("stays")).select(F.col("doc_id").alias("k_id"), "k_text").distinct()
    return rows_without(docs, gone, id_col, text_col)
