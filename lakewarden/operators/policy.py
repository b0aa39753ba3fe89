"""Row filters and column masks.

These compute what a principal should see. They are not a security boundary: whoever can read the
files can pass them by. The principal's membership is resolved before planning, so a policy is a
plain filter and projection that Catalyst folds and pushes into the scan.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewarden.session import stage


@dataclass(frozen=True)
class MaskPolicy:
    """Members of ``exempt`` see the value, others its first ``keep`` characters and ``fill``."""

    exempt: str
    keep: int = 2
    fill: str = "****"

    def apply(self, col: Column, is_exempt: bool) -> Column:
        if is_exempt:
            return col
        return F.concat(F.left(col.cast("string"), F.lit(self.keep)), F.lit(self.fill))


@dataclass(frozen=True)
class RowPolicy:
    """Members of ``exempt`` see every row, others those with an allowed value; NULL is not one."""

    exempt: str
    allowed: tuple[str, ...]

    def apply(self, col: Column, is_exempt: bool) -> Column:
        if is_exempt:
            return F.lit(True)
        return col == self.allowed[0] if len(self.allowed) == 1 else col.isin(*self.allowed)


@dataclass
class PolicyRegistry:
    """Which policy is attached to which table and column; a policy is defined once and reused."""

    masks: dict[str, dict[str, MaskPolicy]] = field(default_factory=dict)
    filters: dict[str, tuple[str, RowPolicy]] = field(default_factory=dict)

    def attach_mask(self, table: str, column: str, policy: MaskPolicy) -> PolicyRegistry:
        self.masks.setdefault(table, {})[column] = policy
        return self

    def detach_mask(self, table: str, column: str) -> PolicyRegistry:
        self.masks.get(table, {}).pop(column, None)
        return self

    def attach_filter(self, table: str, column: str, policy: RowPolicy) -> PolicyRegistry:
        self.filters[table] = (column, policy)
        return self

    def detach_filter(self, table: str) -> PolicyRegistry:
        self.filters.pop(table, None)
        return self

    def groups(self, table: str) -> set[str]:
        """The exempt groups that decide what this table shows."""
        found = {p.exempt for p in self.masks.get(table, {}).values()}
        if table in self.filters:
            found.add(self.filters[table][1].exempt)
        return found


def principal_groups(members: DataFrame, principal: str, groups: set[str]) -> set[str]:
    """Those of the asked groups that hold the principal: at most ``len(groups)`` names."""
    if not groups:
        return set()
    rows = members.filter((F.col("principal") == principal) & F.col("grp").isin(*groups)).select("grp").distinct()
    return {r["grp"] for r in rows.collect()}


def mask_columns(df: DataFrame, cols: list[str], is_admin: bool, policy: MaskPolicy = MaskPolicy("admins")) -> DataFrame:
    return df.withColumns({c: policy.apply(F.col(c), is_admin) for c in cols})


def row_filter(df: DataFrame, col: str, allowed: list[str], is_admin: bool) -> DataFrame:
    return df.filter(RowPolicy("admins", tuple(allowed)).apply(F.col(col), is_admin))


def secure(df: DataFrame, table: str, registry: PolicyRegistry, principal: str, members: DataFrame) -> DataFrame:
    """The table as the principal sees it. Later predicates meet the masked values, not the raw ones.

    ``members`` is every (principal, grp) that holds, also through nested groups: ``access.expand_members``.
    """
    held = principal_groups(members, principal, registry.groups(table))
    if table in registry.filters:
        column, policy = registry.filters[table]
        df = df.filter(policy.apply(F.col(column), policy.exempt in held))
    masks = registry.masks.get(table, {})
    return df.withColumns({c: p.apply(F.col(c), p.exempt in held) for c, p in masks.items()}) if masks else df


def secure_by_tags(df: DataFrame, tags: dict[str, dict[str, str]], keep: dict[str, int], is_admin: bool) -> DataFrame:
    """Mask every column tagged pii=true; its sensitivity_level sets how many characters stay.

    ``tags`` is {column: {tag: value}} of this one table, ``keep`` {level: characters}.
    """
    masks = {
        c: MaskPolicy("admins", keep=keep.get(t.get("sensitivity_level", ""), 0)).apply(F.col(c), is_admin)
        for c, t in tags.items() if t.get("pii") == "true" and c in df.columns
    }
    return df.withColumns(masks) if masks else df


def tags_of_table(tags: DataFrame, catalog: str, schema: str, table: str) -> dict[str, dict[str, str]]:
    """{column: {tag: value}} of one table from the table of current tags: as many rows as its columns carry tags."""
    mine = tags.filter((F.col("catalog") == catalog) & (F.col("schema") == schema) & (F.col("object") == table))
    found: dict[str, dict[str, str]] = {}
    for r in mine.select("column_name", "tag_name", "tag_value").collect():
        found.setdefault(r["column_name"], {})[r["tag_name"]] = r["tag_value"]
    return found


def policy_visibility(
    df: DataFrame, col: str, principals: DataFrame, members: DataFrame, rules: DataFrame,
    admins: str, masked_columns: int,
) -> DataFrame:
    """What each principal sees: visible rows and number of masked columns, all principals at once.

    ``rules`` maps a group to an allowed value of ``col``. Rows are counted per value first, so the
    job joins principals with values and never with rows.
    """
    per_value = stage(df.groupBy(F.col(col).alias("allowed")).agg(F.count(F.lit(1)).alias("n")), "per_value")
    n_total = per_value.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    is_admin = members.filter(F.col("grp") == admins).select("principal").distinct().withColumn("is_admin", F.lit(True))
    seen = (
        members.join(rules, "grp").select("principal", "allowed").distinct()
        .join(per_value, "allowed").groupBy("principal").agg(F.sum("n").alias("n"))
    )
    return (
        principals.select("principal").distinct().join(seen, "principal", "left").join(is_admin, "principal", "left")
        .select(
            "principal",
            F.when(F.col("is_admin"), F.lit(n_total)).otherwise(F.coalesce("n", F.lit(0))).cast("bigint")
            .alias("visible_rows"),
            F.when(F.col("is_admin"), 0).otherwise(masked_columns).cast("bigint").alias("masked_columns"),
        )
    )
