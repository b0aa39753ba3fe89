"""Writing: replace, checked append, CSV, clustered layout."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewarden.operators.integrity import fk_orphan_keys
from lakewarden.session import stage


def publish(df: DataFrame, path: str) -> DataFrame:
    """Replace the table at ``path``; running it again gives the same table."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def append_checked(batch: DataFrame, path: str, parent: DataFrame, keys: dict[str, str]) -> int:
    """Append the whole batch, or nothing if any row refers to a missing parent.

    ``keys`` maps child columns to parent columns. Returns the number of rejected rows. The batch is written
    aside first, so the rows appended are the rows checked.
    """
    batch = stage(batch, "batch")
    orphans = fk_orphan_keys(batch, parent, keys)
    rejected = orphans.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]
    if rejected == 0:
        batch.write.mode("append").parquet(path)
    return rejected


def cluster_layout(df: DataFrame, cols: list[str], path: str, rows_per_file: int = 5_000_000) -> DataFrame:
    """Lay a table out by ``cols`` so that readers skip files and row groups; on small files it compacts them.

    The number of files follows from the number of rows. Range partitioning samples its input, so
    a computed table is written once before. The row hash behind the keys lets one frequent value
    spread over several neighbouring files instead of filling a single one.
    """
    stored = stage(df, "unclustered")
    files = max(1, math.ceil(stored.count() / rows_per_file))
    laid = stored.repartitionByRange(files, *cols, F.xxhash64(*df.columns)).sortWithinPartitions(*cols)
    laid.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Ranks that a column is scaled to by a sample of so many rows.
RANKS = 64
SAMPLE_ROWS = 10_000


def curve_bounds(df: DataFrame, cols: list[str], ranks: int = RANKS, sample_rows: int = SAMPLE_ROWS) -> dict[str, list]:
    """Per column at most ``ranks`` - 1 values that part a bounded sample of the rows, picked by hash, into equal shares."""
    sample = df.select(*cols).orderBy(F.xxhash64(*df.columns)).limit(sample_rows).collect()
    bounds = {}
    for c in cols:
        values = sorted(r[c] for r in sample if r[c] is not None)
        marks = {values[i * len(values) // ranks] for i in range(1, ranks)} if values else set()
        bounds[c] = sorted(marks - {values[0]}) if values else []
    return bounds


def curve_place(bounds: dict[str, list]) -> Column:
    """Place of a row on a Z curve: the bits of its columns' ranks in turn, the highest first. NULL has rank 0."""
    bits = max([len(v).bit_length() for v in bounds.values()], default=0)
    ranks = [F.shiftleft(sum((F.coalesce(F.col(c) >= F.lit(v), F.lit(False)).cast("bigint") for v in values), F.lit(0).cast("bigint")),
                         bits - len(values).bit_length()) for c, values in bounds.items()]
    place = F.lit(0).cast("bigint")
    for bit in range(bits):
        for i, rank in enumerate(reversed(ranks)):
            place = place + F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("bigint")), bit * len(ranks) + i)
    return place


def curve_layout(df: DataFrame, cols: list[str], path: str, rows_per_file: int = 5_000_000) -> DataFrame:
    """Lay a table out along a curve through ``cols``, so that a filter on any one of them skips files.

    ``cluster_layout`` serves filters on the first column; after it the others are spread over all files. The
    columns are scaled to ranks by a bounded sample, which decides how well files are cut, not what is in them.
    """
    stored = stage(df, "unclustered")
    files = max(1, math.ceil(stored.count() / rows_per_file))
    placed = stored.withColumn("_place", curve_place(curve_bounds(stored, cols)))
    laid = placed.repartitionByRange(files, "_place", F.xxhash64(*df.columns)).sortWithinPartitions("_place", *cols).drop("_place")
    laid.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
