"""Sharding by extendible hashing, in DataFrame functions only."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, cut, sized

BITS = 60


@dataclass(frozen=True)
class ShardParams:
    """``limit_bytes`` of text a shard; ``step`` bits are looked at in one pass beyond the expected depth."""

    limit_bytes: int = 1 << 20
    step: int = 4


def hash_bits(key: Column) -> Column:
    """The first 60 bits of the md5 of the key's text, as a number; null counts as the empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def prefix(h: Column, depth: Column | int) -> Column:
    return F.shiftright(h, BITS - depth) if isinstance(depth, int) else F.call_function("shiftright", h, F.lit(BITS) - depth)


def _rollup(counts: DataFrame, low: int, high: int) -> DataFrame:
    """Sizes of all buckets of depths ``low``..``high`` from those of depth ``high``: ``depth, bucket, ...``."""
    ups = counts.withColumn("depth", F.explode(F.sequence(F.lit(low), F.lit(high))))
    up = F.call_function("shiftright", F.col("at"), F.lit(high) - F.col("depth"))
    return ups.groupBy("depth", up.alias("bucket")).agg(F.sum("bytes").alias("bytes"), F.sum("docs").alias("docs"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def directory(sizes: DataFrame, params: ShardParams = ShardParams()) -> DataFrame:
    """The leaves ``depth, bucket, bytes, docs, oversized`` for ``sizes(h, bytes)``, a written table.

    A bucket is split on its next bit only if it is over the limit; one whose rows have a single hash cannot be split
    and is marked oversized. Sizes are summed once at the expected depth and rolled up from there; only buckets still
    over the limit are looked at again, ``step`` bits deeper.
    """
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    low, high = 0, min(BITS, max(0, math.ceil(math.log2(max(1, total / params.limit_bytes)))) + params.step)
    rows, leaves = sizes, None
    while True:
        at = prefix(F.col("h"), high)
        counts = rows.groupBy(at.alias("at")).agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("docs"), F.min("h").alias("lo"), F.max("h").alias("hi"))
        fits = (F.col("bytes") <= params.limit_bytes) | (F.col("lo") == F.col("hi"))
        marked = _rollup(cut(counts), low, high).withColumn("fits", fits)
        # a leaf fits and its parent does not; what lies under a leaf fits too
        parents = marked.where("not fits").select((F.col("depth") + 1).alias("depth"), F.explode(F.array(F.col("bucket") * 2, F.col("bucket") * 2 + 1)).alias("bucket"))
        new = marked.where("fits").join(parents, ["depth", "bucket"], "left_semi")
        if leaves is None:
            new = new.unionByName(marked.where("fits and depth = 0"))
        else:
            new = new.unionByName(marked.where(F.col("fits") & (F.col("depth") == low)))
        new = new.withColumn("oversized", F.col("bytes") > params.limit_bytes).select("depth", "bucket", "bytes", "docs", "oversized")
        leaves = cut(new if leaves is None else leaves.unionByName(new))
        left = cut(marked.where(~F.col("fits") & (F.col("depth") == high)).select("bucket"))
        if left.isEmpty():
            return leaves
        rows = rows.withColumn("bucket", at).join(sized(left), "bucket", "left_semi").select("h", "bytes")
        low, high = high + 1, min(BITS, high + params.step)


def shard(docs: DataFrame, key: str = "doc_id", params: ShardParams = ShardParams()) -> DataFrame:
    """``docs`` with ``n_bytes`` of text, ``shard`` (its hash prefix in bits), ``depth``, ``shard_docs``, ``shard_bytes``, ``oversized``.

    Null text has no bytes. Rows of one key, and all rows of a null or empty key, share a hash and so a shard; it is
    marked oversized if they exceed the limit, and so is a single larger document. An empty table gives no rows. Input
    columns named as the new ones are replaced. A row meets the few leaves of its prefix once, with all its columns; the
    directory is broadcast up to 16 MB, and beyond that rows are dealt by prefix.
    """
    docs = docs.drop("n_bytes", "shard", "depth", "shard_docs", "shard_bytes", "oversized", "__h", "__at", "__lo", "__hi")
    rows = docs.withColumn("__h", hash_bits(F.col(key))).withColumn("n_bytes", F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("long"))
    with Scratch(docs.sparkSession, "sharding") as scratch:
        leaves = directory(scratch.save(rows.select(F.col("__h").alias("h"), F.col("n_bytes").alias("bytes")), "sizes"), params)
        level = max(0, leaves.count() - 1).bit_length()
    # a leaf is a range of hashes, and it is met by the prefixes of ``level`` bits that lie in it: one for most leaves, and
    # all together at most twice as many as there are leaves
    lo = F.call_function("shiftleft", F.col("bucket"), F.lit(BITS) - F.col("depth"))
    ranges = leaves.withColumn("__lo", lo).withColumn("__hi", F.col("__lo") + F.call_function("shiftleft", F.lit(1).cast("long"), F.lit(BITS) - F.col("depth")) - 1)
    at = F.explode(F.sequence(prefix(F.col("__lo"), level), prefix(F.col("__hi"), level)))
    bits = F.when(F.col("depth") == 0, "").otherwise(F.lpad(F.bin(F.col("bucket")), F.col("depth"), "0"))
    named = ranges.select(at.alias("__at"), "__lo", "__hi", bits.alias("shard"), F.col("depth").cast("int").alias("depth"), F.col("docs").alias("shard_docs"), F.col("bytes").alias("shard_bytes"), "oversized")
    found = rows.withColumn("__at", prefix(F.col("__h"), level)).join(sized(named), "__at").where("__h >= __lo and __h <= __hi")
    return found.select(*docs.columns, "n_bytes", "shard", "depth", "shard_docs", "shard_bytes", "oversized")


def write_shards(docs: DataFrame, path: str, key: str = "doc_id", params: ShardParams = ShardParams()) -> None:
    """Writes each shard to a folder ``shard=<bits>`` of Parquet files under ``path``."""
    out = shard(docs, key, params).drop("n_bytes", "depth", "shard_docs", "shard_bytes", "oversized")
    out.repartition("shard").write.partitionBy("shard").parquet(path)
