"""Immutable table versions: a ``version`` partition column over plain Parquet."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewarden.operators.lineage import FILTER_BITS, held_in
from lakewarden.session import stage

# Key ranges summed together on the upper level of a hash tree, and rows to expect in one range of the lower.
FAN = 256
LEAF_ROWS = 8


def commit(df: DataFrame, path: str, version: int) -> None:
    """Write one snapshot. A version is written once; an existing one raises."""
    df.write.mode("error").parquet(f"{path}/version={version}")


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def as_of(versions: DataFrame, version: int) -> DataFrame:
    """The rows of one version; only its folder is read."""
    return versions.filter(F.col("version") == version).drop("version")


def version_at(log: DataFrame, at: datetime) -> int:
    """The version that was current at a time: the newest entry of (version, at) not after it."""
    found = log.filter(F.col("at") <= F.lit(at)).agg(F.max_by("version", F.struct("at", "version"))).first()[0]
    if found is None:
        raise ValueError(f"there was no version yet at {at}")
    return found


def as_of_time(versions: DataFrame, log: DataFrame, at: datetime) -> DataFrame:
    """The rows as they were at a time."""
    return as_of(versions, version_at(log, at))


def update_rows(df: DataFrame, cond: Column, sets: dict[str, Column]) -> DataFrame:
    """UPDATE ... SET ... WHERE as a projection: rows outside the condition keep their values."""
    types = dict(df.dtypes)
    hit = F.coalesce(cond, F.lit(False))
    return df.withColumns({c: F.when(hit, v.cast(types[c])).otherwise(F.col(c)) for c, v in sets.items()})


def update_version(spark: SparkSession, path: str, version: int, cond: Column, sets: dict[str, Column]) -> int:
    """Apply an update to ``version`` and commit the result as the next one."""
    versions = read_versions(spark, path)
    commit(update_rows(as_of(versions, version), cond, sets), path, version + 1)
    return version + 1


def restore(spark: SparkSession, path: str, version: int, latest: int) -> int:
    """Copy an old version forward as a new one; the history keeps all of them."""
    commit(as_of(read_versions(spark, path), version), path, latest + 1)
    return latest + 1


def history(log: DataFrame, k: int, order: list[Column]) -> DataFrame:
    """The newest ``k`` entries."""
    return log.orderBy(*order).limit(k)


def version_diff(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Row-level difference of two versions as bags, per key.

    Equal rows cancel out by counting, so duplicate keys are exact. Of what is left, a key that
    only lost rows is a delete, one that only gained rows an insert, the others are updates.
    """
    cols = a.columns
    both = a.withColumn("_n", F.lit(-1).cast("bigint")).unionByName(b.withColumn("_n", F.lit(1).cast("bigint")))
    changed = both.groupBy(*cols).agg(F.sum("_n").alias("_n")).filter(F.col("_n") != 0)
    removed = F.sum(F.greatest(-F.col("_n"), F.lit(0)))
    added = F.sum(F.greatest(F.col("_n"), F.lit(0)))
    per_key = changed.groupBy(*keys).agg(removed.alias("rows_removed"), added.alias("rows_added"))
    kind = (F.when(F.col("rows_added") == 0, "delete").when(F.col("rows_removed") == 0, "insert")
            .otherwise("update"))
    return per_key.select(*keys, kind.alias("change"), "rows_removed", "rows_added")


def _gaps(cols: list[str]) -> Column:
    """Which columns are NULL; a hash alone passes them over."""
    return F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in cols])


def _leaf(keys: list[str], leaves: int) -> Column:
    return F.pmod(F.xxhash64(*keys, _gaps(keys)), F.lit(leaves))


def leaves_for(rows: int) -> int:
    """Ranges for a table of so many rows: a power of two, about ``LEAF_ROWS`` rows in each, and no more than a filter has bits."""
    return min(FILTER_BITS, 1 << max(12, (rows // LEAF_ROWS).bit_length()))


def _digests(df: DataFrame, keys: list[str], leaves: int, sign: int = 1) -> DataFrame:
    """(leaf, n, s1, s2) of each row alone."""
    cols = df.columns
    digests = [F.xxhash64(F.lit(1), _gaps(cols), *cols), F.xxhash64(F.lit(2), *cols, _gaps(cols))]
    return df.select(_leaf(keys, leaves).alias("leaf"), F.lit(sign).cast("bigint").alias("n"),
                     *[(h.cast("decimal(20,0)") * sign).cast("decimal(38,0)").alias(f"s{i}") for i, h in enumerate(digests, 1)])


def _summed(df: DataFrame, by: str) -> DataFrame:
    return df.groupBy(by).agg(*[F.sum(c).alias(c) for c in ("n", "s1", "s2")])


def _differing(df: DataFrame, by: str) -> DataFrame:
    return _summed(df, by).filter("n <> 0 or s1 <> 0 or s2 <> 0").select(by)


def hash_tree(df: DataFrame, keys: list[str], leaves: int) -> DataFrame:
    """(leaf, n, s1, s2): number and summed digests of the rows of each range of hashed keys.

    Sums do not depend on the order of rows and count duplicates. A version's tree may be kept beside it.
    """
    return _summed(_digests(df, keys, leaves), "leaf")


def changed_leaves(a: DataFrame, b: DataFrame, fan: int = FAN) -> DataFrame:
    """(leaf): ranges in which two trees differ, looked for only below nodes of the upper level that do."""
    def signed(tree: DataFrame, sign: int) -> DataFrame:
        return tree.select("leaf", F.floor(F.col("leaf") / fan).alias("top"), *[(F.col(c) * sign).alias(c) for c in ("n", "s1", "s2")])

    both = signed(a, -1).unionByName(signed(b, 1))
    tops = stage(_differing(both, "top"), "tops")
    return _differing(both.join(tops, "top", "left_semi"), "leaf")


def tree_diff(a: DataFrame, b: DataFrame, keys: list[str], trees: tuple[DataFrame, DataFrame] | None = None,
              leaves: int | None = None) -> DataFrame:
    """As ``version_diff``, but rows are compared only in the ranges whose summed digests differ.

    ``trees`` are those of ``hash_tree`` for both with the same ``leaves``, if they were kept; otherwise both versions are summed
    in one narrow pass. Both have the same columns, none of them a map. The differing ranges are kept as one bit each,
    8 MB at most, so rows of all others are dropped where they are read, and the rest is shuffled once.
    """
    b = b.select(a.columns)
    leaves = leaves or leaves_for(a.count())
    if trees is None:
        differ = _differing(_digests(a, keys, leaves, -1).unionByName(_digests(b, keys, leaves)), "leaf")
    else:
        differ = changed_leaves(*trees)
    place = F.col("leaf") + 1
    bits = stage(differ.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bitmap")), "leaves")

    def cut(df: DataFrame) -> DataFrame:
        place = _leaf(keys, leaves) + 1
        return held_in(df, F.bitmap_bucket_number(place), F.bitmap_bit_position(place), bits)

    return version_diff(cut(a), cut(b), keys)
