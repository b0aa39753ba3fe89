"""Shards by extendible hashing.

A directory is indexed by the first bits of each document's hash. A bucket that holds more bytes than a shard
may have is split on its next bit, and only such buckets are, until every one fits. Only byte counts per hash
prefix are shuffled and held; documents meet the directory in one join on a prefix.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewarden.llm.common import named
from lakewarden.session import stage

SHARD_BYTES = 1_000_000
HASH_BITS = 60
# Of these, the last come from the row's number, so that rows of one id can be parted too.
ROW_BITS = 20
# Bits by which one round can deepen a bucket; a round sums at most 2^bits cells per open bucket.
ROUND_BITS = 3


def hash_bits(key: Column, row: Column) -> Column:
    """40 bits of the key's MD5 digest (NULL counts as empty), then 20 of the row number's hash."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    first = F.conv(F.substring(digest, 1, (HASH_BITS - ROW_BITS) // 4), 16, 10).cast("bigint")
    return first * F.lit(1 << ROW_BITS) + F.pmod(F.xxhash64(row), F.lit(1 << ROW_BITS))


def prefix(bits: Column, depth: int | Column) -> Column:
    """The first ``depth`` of the hash's bits."""
    return F.call_function("shiftright", bits, (F.lit(HASH_BITS) - depth).cast("int"))


def directory(sizes: DataFrame, limit: int, bits: int = HASH_BITS) -> DataFrame:
    """(depth, bucket, bytes): the buckets that fit or hold one row, or that no bit is left for.

    Each round sums the bytes of the open buckets at the next ``ROUND_BITS`` depths, takes each document's
    first depth that fits, and goes on with what does not fit at the last of them.
    """
    spark = sizes.sparkSession
    done, low, left = [], 0, sizes
    while True:
        high = min(low + ROUND_BITS, bits)
        # Sums at the deepest prefix first: everything above follows from those.
        cells = stage(left.groupBy(prefix(F.col("hash"), high).alias("cell")).agg(
            F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n")), "cells")
        at = F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth")
        by_depth = cells.select("cell", "bytes", "n", at).groupBy("depth", F.call_function(
            "shiftright", F.col("cell"), (F.lit(high) - F.col("depth")).cast("int")).alias("bucket")).agg(
                F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
        by_depth = by_depth.withColumn("fits", (F.col("bytes") <= limit) | (F.col("n") == 1) | (F.col("depth") == bits))
        # A bucket is a leaf where it fits and its parent does not; at the round's first depth that is known.
        parents = by_depth.filter(~F.col("fits")).select((F.col("depth") + 1).alias("depth"), F.col("bucket").alias("_parent"))
        leaves = by_depth.filter("fits").withColumn("_parent", F.call_function("shiftright", F.col("bucket"), F.lit(1)))
        own = leaves.join(parents, ["depth", "_parent"], "left_semi").unionByName(leaves.filter(F.col("depth") == low))
        done.append(stage(own.select("depth", "bucket", F.col("bytes").cast("bigint").alias("bytes")), "leaves"))
        open_ = stage(by_depth.filter((F.col("depth") == high) & ~F.col("fits")).select(F.col("bucket").alias("_open")), "open")
        if high == bits or open_.isEmpty():
            break
        left = sizes.withColumn("_open", prefix(F.col("hash"), high)).join(open_, "_open").drop("_open")
        low = high
    return reduce(DataFrame.unionByName, done, spark.createDataFrame([], "depth int, bucket bigint, bytes bigint"))


def shard_documents(df: DataFrame, limit: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text",
                    carry: list[str] | None = None) -> DataFrame:
    """``_row`` (the columns of ``df``, or those to ``carry``) with ``bytes``, ``shard`` and ``depth``.

    ``shard`` is the bucket's prefix as text of 0s and 1s, ``''`` if all fits one shard. A document longer
    than ``limit`` ends alone in its shard, at the first depth where it is alone. Rows of one id stay together until their bucket is too large, then
    bits of the row's number part them. A NULL text has 0 bytes, NULL ids hash like an empty one, an empty
    table gives no rows, names cannot clash as columns stay inside ``_row``.
    """
    kept = df.columns if carry is None else carry
    rid = F.monotonically_increasing_id()
    sized = stage(df.select(
        rid.alias("rid"), F.struct(*[named(df, c) for c in kept]).alias("_row"),
        hash_bits(named(df, id_col), rid).alias("hash"),
        F.coalesce(F.octet_length(named(df, text_col)), F.lit(0)).cast("bigint").alias("bytes")), "hashed")
    book = stage(directory(sized.select("hash", "bytes"), limit), "directory")
    depths = sorted(r["depth"] for r in book.select("depth").distinct().collect())  # at most 61
    # A document is looked for at every depth that the directory has; exactly one of them holds its prefix.
    levels = F.array(*[F.lit(d) for d in depths]).cast("array<int>")
    tries = sized.select("rid", "hash", "bytes", F.explode(levels).alias("depth")).withColumn(
        "bucket", prefix(F.col("hash"), F.col("depth")))
    bits = F.lpad(F.bin("hash"), HASH_BITS, "0")
    met = tries.join(book.select("depth", "bucket"), ["depth", "bucket"]).select(
        "rid", "bytes", "depth", F.substring(bits, F.lit(1), F.col("depth")).alias("shard"))
    return sized.select("rid", "_row").join(met, "rid").select("_row", "bytes", "shard", "depth")


def write_shards(sharded: DataFrame, path: str, columns: list[str]) -> None:
    """One folder per shard below ``path``, each holding the rows' own columns."""
    rows = sharded.select(*[F.col("_row").getField(c).alias(c) for c in columns], "shard")
    rows.repartition("shard").write.partitionBy("shard").parquet(path)
