"""Exact deduplication by an exchange of Golomb-coded fingerprints.

Each input partition (a sender) sorts the 64-bit fingerprints of its texts and sends every owner the distinct ones of its
range, Golomb-Rice coded. An owner answers each sender with a bitmap of the fingerprints that another sender holds too.
Only rows marked there, or repeated within their own sender, are suspects; their texts are shuffled and compared byte by
byte. Clean texts never leave the partition they were read in, as long as the bitmaps (one bit a row) are small enough
for Spark to broadcast them; beyond its threshold Spark joins them by sender.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from vitalgrid.llm.common import SPACE, text_or_empty
from vitalgrid.session import stored

#: Fingerprints an owner receives, and the most owners there are: messages number senders times owners.
PER_OWNER, MOST_OWNERS = 1 << 16, 4096
#: monotonically_increasing_id keeps the partition above this bit and the position below.
SENDER_BIT = 33


def golomb_encode(values: np.ndarray) -> tuple[int, bytes]:
    """Rice parameter and code of strictly ascending uint64 values: all unary quotients, then all remainders."""
    gaps = np.diff(values, prepend=np.uint64(0))
    k = max(0, int(math.log2(max(1.0, float(values[-1] - values[0]) / len(values)))))
    quotients = (gaps[1:] >> np.uint64(k)).astype(np.int64)
    unary = np.ones(int(quotients.sum()) + len(quotients), np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 0
    shifts = np.arange(k - 1, -1, -1, dtype=np.uint64)
    rest = ((gaps[1:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel()
    return k, int(values[0]).to_bytes(8, "big") + np.packbits(np.concatenate([unary, rest])).tobytes()


def golomb_decode(n: int, k: int, code: bytes) -> np.ndarray:
    first, bits = int.from_bytes(code[:8], "big"), np.unpackbits(np.frombuffer(code, np.uint8, offset=8))
    if n == 1:
        return np.array([first], np.uint64)
    ends = np.flatnonzero(bits == 0)[: n - 1]
    quotients = np.diff(ends, prepend=-1) - 1
    rest = bits[ends[-1] + 1 : ends[-1] + 1 + (n - 1) * k].reshape(n - 1, k).astype(np.uint64)
    gaps = (quotients.astype(np.uint64) << np.uint64(k)) + rest @ (np.uint64(1) << np.arange(k - 1, -1, -1, dtype=np.uint64))
    return np.cumsum(np.concatenate([np.array([first], np.uint64), gaps]), dtype=np.uint64)


def _by_owner(fingerprints: pd.Series, owners: int):
    """Distinct sorted fingerprints, their multiplicity, each row's place among them, and where owners' ranges begin."""
    values, place, count = np.unique(fingerprints.to_numpy().astype(np.int64).view(np.uint64), return_inverse=True,
                                     return_counts=True)
    owner = (values >> np.uint64(32)) * np.uint64(owners) >> np.uint64(32)
    return values, place, count, np.searchsorted(owner, np.arange(owners + 1, dtype=np.uint64))


def _messages(owners: int):
    def send(pdf: pd.DataFrame) -> pd.DataFrame:
        values, _, _, at = _by_owner(pdf["fp"], owners)
        rows = [(pdf["sender"].iloc[0], o, int(at[o + 1] - at[o]), *golomb_encode(values[at[o] : at[o + 1]]))
                for o in range(owners) if at[o + 1] > at[o]]
        return pd.DataFrame(rows, columns=["sender", "owner", "n", "k", "code"])
    return send


def _answers(pdf: pd.DataFrame) -> pd.DataFrame:
    got = [golomb_decode(n, k, code) for n, k, code in zip(pdf["n"], pdf["k"], pdf["code"])]
    _, place, count = np.unique(np.concatenate(got), return_inverse=True, return_counts=True)
    cuts = np.cumsum([len(x) for x in got])[:-1]
    bitmaps = [np.packbits(part > 1).tobytes() for part in np.split(count[place], cuts)]
    return pd.DataFrame({"sender": pdf["sender"], "owner": pdf["owner"], "bitmap": bitmaps})


def _suspects(owners: int):
    def mark(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        values, place, count, at = _by_owner(rows["fp"], owners)
        shared = count > 1
        for owner, bitmap in zip(answers["owner"], answers["bitmap"]):
            lo, hi = at[owner], at[owner + 1]
            shared[lo:hi] |= np.unpackbits(np.frombuffer(bitmap, np.uint8))[: hi - lo].astype(bool)
        marks = np.zeros(int(rows["pos"].max()) + 1, np.uint8)
        marks[rows["pos"].to_numpy()[shared[place]]] = 1
        return pd.DataFrame({"sender": rows["sender"].iloc[:1], "marks": [np.packbits(marks).tobytes()]})
    return mark


def verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The rows as stored, with ``row_id``, and a verdict for each of them.

    Verdict: row_id, doc_id, keep_id, group_size, kept, text_sha256. Texts are equal if they are after each run of
    white space became one space. Null text counts as empty. The smallest id of a group stays, null ids last; among
    rows that repeat id and text one stays. An empty table gives an empty result; other columns are not looked at.
    """
    spark = docs.sparkSession
    names = {c: f"c_{i}" for i, c in enumerate(docs.columns)}
    norm = F.regexp_replace(text_or_empty("text_"), SPACE, " ")
    rows = stored(docs.select(F.col(id_col).alias("id_"), F.col(text_col).alias("text_"),
                              F.struct(*[F.col(c).alias(n) for c, n in names.items() if c not in (id_col, text_col)],
                                       F.lit(0).alias("z_")).alias("rest_"))
                  .withColumns({"row_id": F.monotonically_increasing_id(), "sha": F.sha2(norm, 256),
                                "fp": F.xxhash64(norm)}), "dedup-rows", "zstd")
    sent = rows.select(F.shiftright("row_id", SENDER_BIT).alias("sender"),
                       F.col("row_id").bitwiseAND((1 << SENDER_BIT) - 1).alias("pos"), "fp")
    owners = max(1, min(MOST_OWNERS, math.ceil(rows.count() / PER_OWNER)))
    answers = (sent.groupBy("sender").applyInPandas(_messages(owners), "sender long, owner long, n long, k long, code binary")
               .groupBy("owner").applyInPandas(_answers, "sender long, owner long, bitmap binary"))
    marks = stored(sent.groupBy("sender").cogroup(answers.groupBy("sender"))
                   .applyInPandas(_suspects(owners), "sender long, marks binary"), "dedup-marks")
    bit = F.expr(f"shiftright(cast(conv(hex(substring(marks, cast((row_id & {(1 << SENDER_BIT) - 1}) div 8 as int) + 1, 1)),"
                 f" 16, 10) as int), 7 - cast(row_id & 7 as int)) & 1")
    suspects = (rows.select("row_id", "id_", "text_", "sha")
                .join(marks, F.shiftright("row_id", SENDER_BIT) == F.col("sender")).filter(bit == 1))
    groups = (suspects.groupBy("sha", norm.alias("norm"))
              .agg(F.min(F.struct(F.col("id_").isNull(), "id_", "row_id")).alias("first"), F.count("*").alias("n"))
              .select("sha", F.col("first.id_").alias("first_id"), F.col("first.row_id").alias("first_row"), "n"))
    found = rows.select("row_id", "id_", "sha").join(groups, "sha", "left")
    alone = F.col("n").isNull()
    verdict = found.select("row_id", F.col("id_").alias("doc_id"),
                           F.when(alone, F.col("id_")).otherwise(F.col("first_id")).alias("keep_id"),
                           F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
                           (alone | (F.col("row_id") == F.col("first_row"))).alias("kept"), F.col("sha").alias("text_sha256"))
    own = [F.col("id_").alias(c) if c == id_col else F.col("text_").alias(c) if c == text_col
           else F.col(f"rest_.{names[c]}").alias(c) for c in docs.columns]
    return rows.select("row_id", F.struct(*own).alias("row")), verdict


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of each row; see ``verdicts``."""
    return verdicts(docs, id_col, text_col)[1].drop("row_id")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with their columns."""
    rows, verdict = verdicts(docs, id_col, text_col)
    return rows.join(verdict.filter(~F.col("kept")).select("row_id"), "row_id", "left_anti").select("row.*")
