"""Extendible hashing: a directory over hash-prefix bits whose oversized buckets split on the next bit.

A bucket is a prefix of the hash of a document's id. Only a bucket above the byte limit splits, until every
shard fits. The bytes per full hash are summed once; all levels follow from these sums. The directory
addresses shards by their prefix; its size follows the data volume over the limit.

Defined cases: a null text has 0 bytes, a null id hashes as the word null; rows with one id share a hash and
cannot be parted, so a shard that holds a single hash may exceed the limit and says so in `oversize`; an
empty table has one empty directory; columns named like a result column are replaced, all others stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakloom.llm.common import set_aside
from peakloom.session import materialise

BITS = 32
LIMIT_BYTES = 4 << 20
OUT = ["hash", "n_bytes", "shard", "depth", "shard_bytes", "oversize"]


def hashed(docs: DataFrame) -> DataFrame:
    """Adds `hash` (32 bits) and `n_bytes`."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in OUT]
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    return docs.select(*rest, F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("bigint").alias("hash"),
                       F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"))


def directory(sizes: DataFrame, limit_bytes: int = LIMIT_BYTES) -> DataFrame:
    """From (hash, n_bytes): the shards as (depth, prefix, shard_bytes, oversize).

    Level by level, only the hashes of buckets that are too large are read again, one bit longer.
    """
    live = materialise(sizes.groupBy("hash").agg(F.sum("n_bytes").alias("n_bytes")), "hashes")
    done = []
    for depth in range(BITS + 1):
        prefix = F.shiftrightunsigned("hash", BITS - depth)
        buckets = materialise(live.groupBy(prefix.alias("prefix")).agg(
            F.sum("n_bytes").alias("shard_bytes"), F.count("*").alias("_hashes")), "buckets")
        final = (F.col("shard_bytes") <= limit_bytes) | (F.col("_hashes") == 1)
        done.append(buckets.where(final).select(
            F.lit(depth).alias("depth"), "prefix", "shard_bytes",
            (F.col("shard_bytes") > limit_bytes).alias("oversize")))
        large = buckets.where(~final).select(F.col("prefix").alias("_large"))
        if large.isEmpty():
            break
        live = live.join(large, prefix == F.col("_large"), "left_semi")
    shards = done[0]
    for level in done[1:]:
        shards = shards.unionByName(level)
    return materialise(shards, "directory")


def assign(docs: DataFrame, limit_bytes: int = LIMIT_BYTES) -> DataFrame:
    """All rows and columns of `docs` with their shard: its prefix as a bit string, depth and bytes."""
    aside, kept = set_aside(docs, ["doc_id", "text"], OUT)
    rows = hashed(aside)
    shards = directory(materialise(rows.select("hash", "n_bytes"), "sizes"), limit_bytes)
    # a row looks itself up once per depth in use; few depths occur, as hashes spread evenly
    depths = sorted(r["depth"] for r in shards.select("depth").distinct().collect())
    keyed = rows.withColumn("_depth", F.explode(F.array(*[F.lit(d) for d in depths] or [F.lit(0)])))
    keyed = keyed.withColumn("_prefix", F.expr(f"shiftrightunsigned(hash, {BITS} - _depth)"))
    return keyed.join(shards, (keyed["_depth"] == shards["depth"]) & (keyed["_prefix"] == shards["prefix"])).select(
        *kept, "hash", "n_bytes",
        F.expr("substring(lpad(bin(prefix), 64, '0'), 65 - depth, depth)").alias("shard"),
        "depth", "shard_bytes", "oversize")


def write_shards(docs: DataFrame, path: str, limit_bytes: int = LIMIT_BYTES) -> None:
    """One folder per shard; a shard is written by few tasks, none holds more than its shards."""
    rows = assign(docs, limit_bytes)
    rows.repartition("shard").write.mode("overwrite").partitionBy("shard").parquet(path)
