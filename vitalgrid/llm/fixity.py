"""Merkle fixity audit of WARC replicas.

An archive is a set of shards; a shard is an ordered run of records with their byte offsets. Leaves hash a record with its
offset range, a node hashes its offset range and its up to FAN children in order, shards are joined under one root. The
audit compares the replicas' roots and goes down only below nodes that differ, level by level, to the damaged records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from vitalgrid.session import stored

FAN_BITS = 4
SHARD_BIT = 33
CRLF = "\r\n"


def record(url: Column, body: Column) -> Column:
    """A WARC resource record as text; nulls count as empty."""
    body, url = F.coalesce(body, F.lit("")), F.coalesce(url, F.lit(""))
    return F.concat(F.lit(f"WARC/1.0{CRLF}WARC-Type: resource{CRLF}WARC-Target-URI: "), url,
                    F.lit(f"{CRLF}Content-Type: text/html{CRLF}Content-Length: "), F.octet_length(body).cast("string"),
                    F.lit(CRLF + CRLF), body, F.lit(CRLF + CRLF))


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """shard, seq, page_id, offset, length, record: written once; a shard is what one task wrote."""
    rows = stored(pages.select(F.col(id_col).alias("page_id"), record(F.col(url_col), F.col(body_col)).alias("record"),
                               F.monotonically_increasing_id().alias("place")), "warc-archive", "zstd")
    placed = rows.select("page_id", "record", F.shiftright("place", SHARD_BIT).alias("shard"),
                         F.col("place").bitwiseAND((1 << SHARD_BIT) - 1).alias("seq"),
                         F.octet_length("record").cast("long").alias("length"))
    return placed


def leaves(records: DataFrame, ranges: DataFrame, replica: int) -> DataFrame:
    """replica, shard, node, lo, hi, hash, sha, page_id of each record; lo and hi bound its bytes in the manifest.

    Records are hashed where they are read; only digests are joined to the manifest.
    """
    own = records.select("shard", "seq", "page_id", F.sha2("record", 256).alias("sha"))
    return own.join(ranges, ["shard", "seq"], "left").select(
        F.lit(replica).alias("replica"), "shard", F.col("seq").alias("node"), "lo", "hi",
        F.sha2(F.concat_ws(":", "lo", "hi", "sha"), 256).alias("hash"), "sha", "page_id")


def manifest(records: DataFrame) -> DataFrame:
    """shard, seq, lo, hi: offset ranges of an archive's records, from running sums of lengths within a shard."""
    upto = Window.partitionBy("shard").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    return (records.select("shard", "seq", "length").withColumn("hi", F.sum("length").over(upto))
            .select("shard", "seq", (F.col("hi") - F.col("length")).alias("lo"), "hi"))


def parents(level: DataFrame, over_shards: bool) -> DataFrame:
    """The next level up: FAN children to a node, within shards or, above the shards' roots, over shards."""
    shard = F.shiftright("shard", FAN_BITS) if over_shards else F.col("shard")
    node = F.lit(0).cast("long") if over_shards else F.shiftright("node", FAN_BITS)
    child = F.col("shard") if over_shards else F.col("node")
    return (level.select("replica", shard.alias("shard"), node.alias("node"), "lo", "hi", F.struct(child.alias("at"), "hash").alias("c"))
            .groupBy("replica", "shard", "node")
            .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sort_array(F.collect_list("c")).alias("c"))
            .select("replica", "shard", "node", "lo", "hi",
                    F.sha2(F.concat_ws(":", "lo", "hi", F.concat_ws(":", "c.hash")), 256).alias("hash")))


def tree(leaf: DataFrame) -> list[tuple[DataFrame, bool]]:
    """Levels from the leaves to the root, each with whether its parents join shards."""
    top = leaf.agg(F.max("node").alias("node"), F.max("shard").alias("shard")).first()
    levels, node, shard = [], top.node or 0, top.shard or 0
    while node or shard:
        levels.append((leaf, not node))
        leaf = stored(parents(leaf, over_shards=not node), "warc-level")
        node, shard = (node >> FAN_BITS, shard) if node else (0, shard >> FAN_BITS)
    return [*levels, (leaf, True)]


def differing(level: DataFrame) -> DataFrame:
    """Nodes whose hash is not the same in both replicas, or that one lacks."""
    of = [F.max(F.when(F.col("replica") == r, F.col("hash"))).alias(f"hash{r}") for r in (0, 1)]
    return level.groupBy("shard", "node").agg(*of).filter(~F.col("hash0").eqNullSafe(F.col("hash1"))).select("shard", "node")


def audit(reference: DataFrame, replica: DataFrame, ranges: DataFrame) -> DataFrame:
    """page_id, shard, seq, lo, hi, status (changed, missing, extra), sha256_expected, sha256_found of damaged records.

    Both have shard, seq, record, page_id; ranges is the manifest. seq is unique in a shard. Equal replicas, and empty
    ones, give no rows.
    """
    ranges = stored(ranges, "warc-manifest")
    leaf = stored(leaves(reference, ranges, 0).unionByName(leaves(replica, ranges, 1)), "warc-leaves")
    levels = tree(leaf)
    bad = differing(levels[-1][0])
    for level, over_shards in reversed(levels[:-1]):
        shard = F.shiftright("shard", FAN_BITS) if over_shards else F.col("shard")
        node = F.lit(0).cast("long") if over_shards else F.shiftright("node", FAN_BITS)
        above = stored(bad.select(F.col("shard").alias("p_shard"), F.col("node").alias("p_node")), "warc-differing")
        below = level.withColumn("s_", shard).withColumn("n_", node)
        bad = differing(below.join(above, (F.col("s_") == F.col("p_shard")) & (F.col("n_") == F.col("p_node")), "left_semi"))
    rows = leaf.join(bad, ["shard", "node"], "left_semi")
    first = lambda c: F.coalesce(*[F.max(F.when(F.col("replica") == r, F.col(c))) for r in (0, 1)]).alias(c)
    sha = [F.max(F.when(F.col("replica") == r, F.col("sha"))).alias(n) for r, n in ((0, "sha256_expected"), (1, "sha256_found"))]
    status = (F.when(F.col("sha256_found").isNull(), "missing").when(F.col("sha256_expected").isNull(), "extra").otherwise("changed"))
    return (rows.groupBy("shard", "node").agg(first("page_id"), first("lo"), first("hi"), *sha)
            .select("page_id", "shard", F.col("node").alias("seq"), "lo", "hi", status.alias("status"), "sha256_expected", "sha256_found"))


def decayed(records: DataFrame) -> DataFrame:
    """A second replica with damage that depends on the page's id: a byte overwritten, the end cut off, or no record."""
    fate = F.coalesce(F.substring(F.sha2(F.col("page_id").cast("string"), 256), 1, 2), F.lit(""))
    middle = F.floor(F.length("record") / 2).cast("int")
    mark = F.when(F.col("record").substr(middle + 1, F.lit(1)) == "#", "$").otherwise("#")
    flipped = F.concat(F.col("record").substr(F.lit(1), middle), mark, F.col("record").substr(middle + 2, F.length("record")))
    changed = F.when(fate == "00", flipped).when(fate == "01", F.col("record").substr(F.lit(1), middle)).otherwise(F.col("record"))
    return records.filter(fate != "02").withColumn("record", changed)


def audited(pages: DataFrame, **names) -> DataFrame:
    """Audit of an archive of the pages against its decayed replica."""
    records = archive(pages, **names)
    return audit(records, decayed(records), manifest(records))
