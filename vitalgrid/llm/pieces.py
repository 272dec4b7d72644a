"""SentencePiece encoding and decoding by a relational lattice.

A text is cut where no piece of the model spans two characters, which loses nothing: such units are encoded on their own.
Blocks of documents keep their texts as codes of their distinct units; the units of all blocks meet once. Their substrings
of bounded length are exploded and equi-joined to the piece table, the edges of a unit are grouped, and a higher-order
aggregate folds them to the unit's segmentation, a bit mask of piece starts. Masks go back to the blocks that asked.

Unigram models fold Viterbi: the path of the greatest sum of scores. Byte-pair models order merges by score and their
segmentation is in general not the path of the greatest sum, so the same lattice is folded by merge rank instead: edges
come best first, and an edge is taken if its two parts are whole at that moment. One pass is exact if no piece needs a
merge that comes after it and every piece encodes to itself; both are checked when a model is loaded.
"""

from __future__ import annotations

import atexit
import heapq
from array import array
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vitalgrid.session import run_dir, scratch_path

SPACE = "▁"
#: Characters of a unit that a 64-bit mask can hold; longer units are merged in the task that holds them.
MASK_CHARS = 60
#: Characters of a block of documents, and of a stretch of text that is cut at once.
BLOCK_CHARS, STRETCH = 14 << 20, 1 << 20
#: Texts a task is handed at once while it cuts them; the rest of its memory is the block.
BATCH, TEXTS_AT_ONCE = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000
#: What an unknown character costs a unigram path below the worst piece.
UNKNOWN_PENALTY = 10.0


class Model:
    """Pieces of a SentencePiece model: rank or score and id, byte pieces, and which characters meet inside a piece."""

    def __init__(self, pieces: dict[str, tuple[int, float]], kind: str, byte_ids: list[int], unknown_id: int, texts: list[str]):
        self.ids = {p: i for p, (i, _) in pieces.items()}
        self.scores = {p: s for p, (_, s) in pieces.items()}
        self.kind, self.byte_ids, self.unknown_id = kind, byte_ids, unknown_id
        #: Of each id, the hex of the bytes it stands for.
        self.texts = texts
        self.longest = max(map(len, pieces), default=1)
        self.chars = {c: i + 1 for i, c in enumerate(sorted({c for p in pieces for c in p}))}
        self.pairs = sorted({p[i : i + 2] for p in pieces for i in range(len(p) - 1)})
        if kind == "bpe":
            order = sorted((p for p in pieces if len(p) > 1), key=lambda p: -self.scores[p])
            self.ranks = {p: r for r, p in enumerate(order)}
            for p in order:
                parts, steps = merged(p, self.ranks)
                if parts != [p] or steps != sorted(steps):
                    raise ValueError(f"merges of piece {p!r} are not in order of score")

    @classmethod
    def of(cls, fields: dict) -> Model:
        """The model of these fields: what travels to workers is plain, as an instance would need this package there."""
        model = object.__new__(cls)
        model.__dict__ = fields
        return model

    @classmethod
    def load(cls, path: str) -> Model:
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        n, special = m.get_piece_size(), lambda i: m.is_control(i) or m.is_unknown(i) or m.is_byte(i)
        names = [m.id_to_piece(i) for i in range(n)]
        pieces = {names[i]: (i, m.get_score(i)) for i in range(n) if not special(i)}
        texts = [names[i][3:5] if m.is_byte(i) else "" if special(i) else names[i].replace(SPACE, " ").encode().hex()
                 for i in range(n)]
        # byte-pair scores are whole numbers, unigram scores are log probabilities
        kind = "bpe" if all(float(s).is_integer() for _, s in pieces.values()) else "unigram"
        return cls(pieces, kind, [i for i in range(n) if m.is_byte(i)], m.unk_id(), texts)

    def ids_of(self, part: str) -> list[int]:
        found = self.ids.get(part)
        if found is not None:
            return [found]
        return [self.byte_ids[b] for b in part.encode("utf-8", "surrogatepass")] if self.byte_ids else [self.unknown_id]


def merged(text: str, ranks: dict[str, int]) -> tuple[list[str], list[int]]:
    """Byte-pair segmentation, best rank first and leftmost among equals, and the ranks merged, in n log n steps."""
    parts, steps = list(text), []
    after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    heap = [(ranks[a + b], i, a + b) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
    heapq.heapify(heap)
    while heap:
        rank, i, both = heapq.heappop(heap)
        j = after[i]
        if not parts[i] or j >= len(parts) or parts[i] + parts[j] != both:
            continue
        steps.append(rank)
        parts[i], parts[j], after[i] = both, "", after[j]
        if after[i] < len(parts):
            before[after[i]] = i
        for x, y in ((before[i], i), (i, after[i])):
            if 0 <= x and y < len(parts) and (joined := parts[x] + parts[y]) in ranks:
                heapq.heappush(heap, (ranks[joined], x, joined))
    return [p for p in parts if p], steps


def best_path(text: str, model: Model) -> list[str]:
    """Unigram segmentation of a text of any length, longer pieces first among equals."""
    worst = min(model.scores.values()) - UNKNOWN_PENALTY
    best = [(0.0, 0)] + [(-np.inf, 0)] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - model.longest), end):
            score = model.scores.get(text[start:end], worst if end - start == 1 else -np.inf)
            if best[start][0] + score > best[end][0]:
                best[end] = (best[start][0] + score, start)
    out, end = [], len(text)
    while end:
        out.append(text[best[end][1] : end])
        end = best[end][1]
    return out[::-1]


class Cutter:
    """Cuts texts into units; lives in a task."""

    def __init__(self, chars: dict[str, int], pairs: list[str]):
        self.place, self.row = np.zeros(0x110000, np.int32), len(chars) + 1
        for c, i in chars.items():
            self.place[ord(c)] = i
        self.apart = np.ones(self.row * self.row, bool)
        for p in pairs:
            self.apart[chars[p[0]] * self.row + chars[p[1]]] = False

    def units(self, text: str | None) -> list[str]:
        if not text:
            return []
        s, cuts = SPACE + text.replace(" ", SPACE), [0]
        for at in range(0, len(s) - 1, STRETCH):
            place = self.place.take(np.frombuffer(s[at : at + STRETCH + 1].encode("utf-32-le", "surrogatepass"), np.uint32))
            pair = place[:-1] * self.row + place[1:]
            cuts += (np.flatnonzero(self.apart.take(pair)) + (at + 1)).tolist()
        cuts.append(len(s))
        return [s[a:b] for a, b in zip(cuts, cuts[1:])]


class _Codes(dict):
    def __missing__(self, unit):
        code = self[unit] = len(self)
        return code


BLOCK = "block long, doc_ids array<long>, lengths array<int>, codes binary, units array<string>"
#: A block's number: the task that made it above this bit, its count below.
TASK_BIT = 20


def packed(codes: np.ndarray) -> bytes:
    """uint32 codes, compressed plane by plane of bytes: most high bytes are 0."""
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(codes.view(np.uint8).reshape(-1, 4).T).tobytes())


def unpacked(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view(np.uint32).ravel()


def ranked(codes: np.ndarray, units: list[str]) -> tuple[np.ndarray, list[str]]:
    """Codes and units renumbered, frequent ones first by powers of two, in the order of their text within."""
    often = np.log2(np.bincount(codes, minlength=len(units))).astype(int)
    order = sorted(range(len(units)), key=lambda i: (-often[i], units[i]))
    place = np.empty(len(units), np.uint32)
    place[order] = np.arange(len(units), dtype=np.uint32)
    return place[codes], [units[i] for i in order]


def blocked(docs: DataFrame, model) -> DataFrame:
    """Blocks of documents: ids, units of each, all codes (uint32, compressed) and the distinct units in order of code.

    A text that the block already holds at place i is kept as the length -1 - i.
    """
    def read(frames):
        from pyspark import TaskContext

        cutter, task = Cutter(model.value["chars"], model.value["pairs"]), TaskContext.get().partitionId()
        number, codes, ids, lengths, parts, size, places = 0, _Codes(), [], [], [], 0, {}

        def block():
            flat, units = ranked(np.concatenate(parts), list(codes))
            return pd.DataFrame({"block": [task << TASK_BIT | number], "doc_ids": [ids],
                                 "lengths": [np.array(lengths, np.int32)], "codes": [packed(flat)], "units": [units]})

        for pdf in frames:
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                ids.append(None if pd.isna(doc_id) else int(doc_id))
                place = places.setdefault(blake2b((text or "").encode("utf-8", "surrogatepass"), digest_size=16).digest(),
                                          len(lengths))
                if place < len(lengths):
                    lengths.append(-1 - place)
                else:
                    units = cutter.units(text)
                    parts.append(np.fromiter(map(codes.__getitem__, units), np.uint32, len(units)))
                    lengths.append(len(units))
                size += len(text or "")
                if size >= BLOCK_CHARS:
                    yield block()
                    number, codes, ids, lengths, parts, size, places = number + 1, _Codes(), [], [], [], 0, {}
        if ids:
            yield block()

    return docs.mapInPandas(read, BLOCK)


def lattice(units: DataFrame, model: Model) -> DataFrame:
    """unit, n, edges of distinct units: substrings that are pieces, each edge a number that sorts as the fold needs.

    The piece table and the table of first characters are of the model's size, whatever the corpus.
    """
    spark, bpe = units.sparkSession, model.kind == "bpe"
    shortest = 2 if bpe else 1
    known = [p for p in model.scores if shortest <= len(p) <= MASK_CHARS]
    longest: dict[str, int] = {}
    for p in known:
        longest[p[:shortest]] = max(longest.get(p[:shortest], 0), len(p))
    rows = [(p, model.ranks[p] if bpe else 0, model.scores[p]) for p in known]
    table = F.broadcast(spark.createDataFrame(pd.DataFrame(rows, columns=["piece", "rank", "score"])))
    heads = F.broadcast(spark.createDataFrame(pd.DataFrame(list(longest.items()), columns=["head", "longest"])))
    sized = units.select("unit", F.length("unit").alias("n"))
    starts = (sized.withColumn("start", F.explode(F.sequence(F.lit(0), F.col("n") - shortest)))
              .withColumn("head", F.col("unit").substr(F.col("start") + 1, F.lit(shortest))).join(heads, "head"))
    spans = (starts.withColumn("size", F.explode(F.sequence(F.lit(shortest), F.least(F.col("longest").cast("int"), F.col("n") - F.col("start")))))
             .select("unit", "n", "start", "size", F.col("unit").substr(F.col("start") + 1, F.col("size")).alias("piece")))
    found = spans.join(table, "piece")
    if bpe:
        edge = F.col("rank") * 4096 + F.col("start") * 64 + F.col("size")
    else:
        edge = F.struct((F.col("start") + F.col("size")).alias("stop"), F.col("start"), F.col("score"))
    return found.groupBy("unit", "n").agg(F.sort_array(F.collect_list(edge)).alias("edges"))


#: Bits are places in the unit; all are set at first, n stands for its end. An edge is taken if its ends are set and one
#: place between them is: its two parts are whole. Taking it clears that place.
MERGE_FOLD = """aggregate(edges, shiftleft(1L, n + 1) - 1L, (m, e) -> if(
    (m & shiftleft(shiftleft(1L, cast(e & 63 as int)) + 1L, cast(shiftright(e, 6) & 63 as int)))
        = shiftleft(shiftleft(1L, cast(e & 63 as int)) + 1L, cast(shiftright(e, 6) & 63 as int))
    and bit_count(m & shiftleft(shiftleft(1L, cast(e & 63 as int)) - 2L, cast(shiftright(e, 6) & 63 as int))) = 1,
    m & ~shiftleft(shiftleft(1L, cast(e & 63 as int)) - 2L, cast(shiftright(e, 6) & 63 as int)), m))"""


def viterbi_fold(model: Model) -> Column:
    """Best score and path mask of every place, edges by their end; characters without an edge cost the penalty."""
    worst = min(model.scores.values()) - UNKNOWN_PENALTY
    return F.expr(f"""aggregate(
        array_sort(concat(edges, transform(sequence(0, n - 1), i -> named_struct('stop', i + 1, 'start', i, 'score', {worst!r}D)))),
        named_struct('s', transform(sequence(0, n), i -> if(i = 0, 0D, -1e300D)), 'm', array_repeat(1L, n + 1)),
        (a, e) -> if(a.s[e.start] + e.score > a.s[e.stop],
            named_struct('s', transform(a.s, (x, i) -> if(i = e.stop, a.s[e.start] + e.score, x)),
                         'm', transform(a.m, (x, i) -> if(i = e.stop, a.m[e.start] | shiftleft(1L, e.stop), x))), a),
        a -> a.m[n])""")


def segmented(units: DataFrame, model: Model) -> DataFrame:
    """unit, mask of distinct units of 2 to MASK_CHARS characters; a unit without edges has no row."""
    fold = F.expr(MERGE_FOLD) if model.kind == "bpe" else viterbi_fold(model)
    return lattice(units, model).select("unit", fold.alias("mask"))


def encode(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (array<int>) of each row; ids are integers.

    As the model encodes: a space before the text, no other normalisation, bytes for unknown characters. Null and empty
    texts give no ids; repeated rows get the same answer; other columns are not looked at.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vars(model))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "blocks")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    # written in buckets by block: the texts' codes are not shuffled again to meet their masks
    cut = blocked(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), shared)
    rows_at_once = spark.conf.get(BATCH)
    spark.conf.set(BATCH, min(int(rows_at_once), TEXTS_AT_ONCE))
    try:
        cut.write.bucketBy(partitions, "block").option("path", path).option("compression", "zstd").saveAsTable(name)
    finally:
        spark.conf.set(BATCH, rows_at_once)
    blocks = spark.table(name)
    atexit.register(forget, spark, name)
    # dealt by unit once, for their segmentation and for the answers; the unused maxima keep both readings alike,
    # so that Spark reuses the exchange
    asked = (blocks.select(F.col("block").alias("asker"), F.posexplode("units").alias("code", "unit"))
             .filter((F.length("unit") > 1) & (F.length("unit") <= MASK_CHARS)).repartition(partitions, "unit"))
    distinct = asked.groupBy("unit").agg(F.max("asker").alias("a"), F.max("code").alias("c")).filter("a is not null and c is not null")
    masks = segmented(distinct, model)
    answers = asked.join(masks, "unit").select("asker", "code", "mask")

    def spell(own: pa.Table, masks: pa.Table) -> pa.Table:
        m, units = Model.of(shared.value), own["units"][0].as_py()
        mask = np.zeros(len(units), np.int64)
        mask[masks["code"].to_numpy()] = masks["mask"].to_numpy()
        flat, ends, get = array("i"), [], m.ids.get
        for unit, bits in zip(units, mask.tolist()):
            if bits:
                rest, at = bits >> 1, 0
                while at < len(unit):  # to the next place that is set, or to the end
                    step = (rest & -rest).bit_length() or len(unit) - at
                    part = unit[at : at + step]
                    i = get(part)
                    if i is None:
                        flat.extend(m.ids_of(part))
                    else:
                        flat.append(i)
                    at, rest = at + step, rest >> step
            else:
                if len(unit) > MASK_CHARS:
                    parts = merged(unit, m.ranks)[0] if m.kind == "bpe" else best_path(unit, m)
                else:
                    parts = unit
                for p in parts:
                    flat.extend(m.ids_of(p))
            ends.append(len(flat))
        counts = np.diff(np.array(ends, np.int64), prepend=0)
        flat, begin = np.array(flat, np.int32), np.cumsum(counts) - counts
        del units, mask, ends
        codes, lengths = unpacked(own["codes"][0].as_py()), own["lengths"][0].values.to_numpy()
        # of each text its first code, or that of the text it repeats, and its number of ids
        first, sizes, at = np.zeros(len(lengths), np.int64), lengths.copy(), 0
        for i, size in enumerate(lengths.tolist()):
            if size < 0:
                first[i], sizes[i] = first[-1 - size], sizes[-1 - size]
            else:
                first[i], at = at, at + size
        total = np.array([counts[codes[a : a + n]].sum() for a, n in zip(first.tolist(), sizes.tolist())], np.int64)
        offsets = np.concatenate([[0], np.cumsum(total)])
        values = np.empty(int(offsets[-1]), np.int32)
        for a, n, to, end in zip(first.tolist(), sizes.tolist(), offsets[:-1].tolist(), offsets[1:].tolist()):
            mine = codes[a : a + n]
            take = counts[mine]
            inside = np.arange(end - to) - np.repeat(np.cumsum(take) - take, take)
            values[to:end] = flat[np.repeat(begin[mine], take) + inside]
        return pa.table({"doc_id": own["doc_ids"][0].values, "n_tokens": total,
                         "ids": pa.ListArray.from_arrays(offsets.astype(np.int32), values)})

    return blocks.groupBy("block").cogroup(answers.groupBy("asker")).applyInArrow(
        spell, "doc_id long, n_tokens long, ids array<int>")


def forget(spark: SparkSession, name: str) -> None:
    """Takes a blocks table out of the catalog when the application ends, as its files go then."""
    if spark.sparkContext._jsc is not None:
        spark.sql(f"drop table if exists {name}")


def decoded(ids: Column, model: Model) -> Column:
    """The text of an array of ids: pieces and bytes joined, invalid bytes replaced, the space before the text taken off."""
    texts = F.split(F.lit(",".join(model.texts)), ",")
    joined = F.make_valid_utf8(F.unhex(F.array_join(F.transform(ids, lambda i: F.get(texts, i)), "")).cast("string"))
    return F.when(joined.startswith(" "), joined.substr(F.lit(2), F.length(joined))).otherwise(joined)
