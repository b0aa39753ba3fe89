"""Shares: named sets of tables, each with an optional alias, row filter, columns and version."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewarden.operators.versions import as_of


@dataclass(frozen=True)
class ShareItem:
    share: str
    table: str
    alias: str | None = None
    partition_filter: str | None = None
    columns: tuple[str, ...] | None = None
    version: int | None = None

    @property
    def shared_as(self) -> str:
        return self.alias or self.table


def share_view(item: ShareItem, tables: dict[str, DataFrame]) -> DataFrame:
    """The rows and columns a recipient gets. Pass secured tables to share them secured."""
    df = tables[item.table]
    if item.version is not None:
        df = as_of(df, item.version)
    if item.partition_filter:
        df = df.filter(item.partition_filter)
    return df.select(*item.columns) if item.columns else df


def share_contents(items: list[ShareItem], tables: dict[str, DataFrame]) -> DataFrame:
    """What a share holds, with row counts, in one job."""
    out = None
    for item in items:
        row = share_view(item, tables).agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(item.share).alias("share"),
            F.lit(item.table).alias("table_name"),
            F.lit(item.shared_as).alias("shared_as"),
            F.lit(item.partition_filter).cast("string").alias("partition_filter"),
            F.lit(item.version).cast("int").alias("version"),
            "n_rows",
        )
        out = row if out is None else out.unionByName(row)
    return out


def share_extract(items: list[ShareItem], tables: dict[str, DataFrame], out: str) -> dict[str, str]:
    """Write every item of a share as a Parquet table; returns {name: path}."""
    paths = {}
    for item in items:
        paths[item.shared_as] = f"{out}/{item.share}/{item.shared_as}"
        share_view(item, tables).write.mode("overwrite").parquet(paths[item.shared_as])
    return paths
