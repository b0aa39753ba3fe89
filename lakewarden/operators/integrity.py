"""References, expectations, structural checks, duplicates."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from lakewarden.functions.scalars import all_present


def fk_orphan_keys(child: DataFrame, parent: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Child keys without a parent and their row counts. A NULL key is no violation.

    Keys are counted before the join, so a key that holds a third of the rows is one row here.
    """
    found = child.filter(all_present(*keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return found.join(_as_child_keys(parent, keys), list(keys), "left_anti")


def fk_violations(child: DataFrame, parent: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Child rows whose parent is missing. The child is read once; a frequent key is split by AQE."""
    return child.filter(all_present(*keys)).join(_as_child_keys(parent, keys), list(keys), "left_anti")


def fk_valid_rows(child: DataFrame, parent: DataFrame, keys: dict[str, str]) -> DataFrame:
    return child.join(_as_child_keys(parent, keys), list(keys), "left_semi")


def _as_child_keys(parent: DataFrame, keys: dict[str, str]) -> DataFrame:
    return parent.select(*[F.col(p).alias(c) for c, p in keys.items()])


def tag_failures(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Adds ``failed``: the names of the rules a row breaks. A rule that yields NULL is broken."""
    marks = F.array(*[F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()])
    return df.withColumn("failed", F.array_compact(marks))


def expect(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(rows that meet every rule, quarantined rows with their reasons)."""
    tagged = tag_failures(df, rules)
    return tagged.filter(F.size("failed") == 0).drop("failed"), tagged.filter(F.size("failed") > 0)


def quarantine_write(df: DataFrame, rules: dict[str, Column], path: str) -> tuple[DataFrame, DataFrame]:
    """The two parts of ``expect``, written in one pass over ``df`` as folders of one table."""
    tagged = tag_failures(df, rules).withColumn("_good", F.size("failed") == 0)
    tagged.write.partitionBy("_good").parquet(path)
    back = df.sparkSession.read.schema(tagged.schema).parquet(path)
    return (back.filter(F.col("_good")).drop("_good", "failed"), back.filter(~F.col("_good")).drop("_good"))


DROP, QUARANTINE, FAIL = "drop", "quarantine", "fail"


class ExpectationFailed(ValueError):
    """Rows broke a rule whose action is to fail; ``broken`` has the number of rows per rule."""

    def __init__(self, broken: dict[str, int]):
        super().__init__(f"nothing was published, rows broke: {broken}")
        self.broken = broken


def write_expected(df: DataFrame, rules: dict[str, tuple[Column, str]], path: str) -> dict[str, int]:
    """Write ``df`` to ``path`` by rules of (condition, action); returns the number of rows that broke each rule.

    A row that breaks a quarantine rule is written beside the others with its reasons; one that breaks a drop rule
    only is left out. If any row breaks a fail rule nothing is published and ``ExpectationFailed`` is raised. One
    pass: rules are counted by the write itself, which goes to a folder aside and is renamed to ``path``, where
    nothing may be yet. A rule that yields NULL is broken.
    """
    unknown = {a for _, a in rules.values()} - {DROP, QUARANTINE, FAIL}
    if unknown:
        raise ValueError(f"unknown actions {sorted(unknown)}")
    spark, pending, seen = df.sparkSession, f"{path.rstrip('/')}.pending-{uuid.uuid4().hex}", Observation()
    tagged = tag_failures(df, {n: rule for n, (rule, _) in rules.items()})

    def breaks(action: str) -> Column:
        names = [n for n, (_, a) in rules.items() if a == action]
        return F.exists("failed", lambda f: f.isin(*names)) if names else F.lit(False)

    counts = [F.count_if(F.array_contains("failed", n)).alias(f"r{i}") for i, n in enumerate(rules)]
    counted = tagged.observe(seen, F.count(F.lit(1)).alias("n"), *counts)
    part = F.when(breaks(QUARANTINE), QUARANTINE).when(breaks(DROP), DROP).otherwise("good")
    counted.withColumn("part", part).filter(F.col("part") != DROP).write.partitionBy("part").parquet(pending)
    found = {n: int(seen.get[f"r{i}"]) for i, n in enumerate(rules)}
    broken = {n: found[n] for n, (_, a) in rules.items() if a == FAIL and found[n]}
    files = spark._jvm.org.apache.hadoop.fs
    aside, place = files.Path(pending), files.Path(path)
    system = aside.getFileSystem(spark._jsc.hadoopConfiguration())
    if broken:
        system.delete(aside, True)
        raise ExpectationFailed(broken)
    if system.exists(place) or not system.rename(aside, place):
        system.delete(aside, True)
        raise FileExistsError(f"{path} is there already")
    return found


def read_expected(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows with ``failed``) of what ``write_expected`` wrote; ``schema`` is that of the rows."""
    back = spark.read.schema(f"{schema}, failed array<string>, part string").option("basePath", path).parquet(path)
    return back.filter("part = 'good'").drop("part", "failed"), back.filter(F.col("part") == QUARANTINE).drop("part")


def expectation_stats(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Passed and failed rows per rule, from one aggregate."""
    ok = {name: F.coalesce(rule, F.lit(False)) for name, rule in rules.items()}
    totals = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(f"ok_{i}") for i, c in enumerate(ok.values())])
    rows = [F.struct(F.lit(name).alias("rule"), F.col(f"ok_{i}").alias("passed"),
                     (F.col("n") - F.col(f"ok_{i}")).alias("failed")) for i, name in enumerate(ok)]
    return totals.select(F.inline(F.array(*rows)))


def verify(name: str, df: DataFrame, columns: list[str], pk: list[str]) -> DataFrame:
    """Row count, exact column list, and rows whose key is NULL or blank."""
    empty = reduce(lambda a, b: a | b, [F.col(k).isNull() | (F.trim(F.col(k).cast("string")) == "") for k in pk])
    return df.agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(empty).alias("empty_keys"),
    ).select(F.lit(name).alias("table_name"), "row_count",
             F.lit(df.columns == columns).alias("columns_match"), "empty_keys")


def pk_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def dedup_latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first by ``order``, which must be total.

    Spark limits each key to one row per task before the shuffle, so a frequent key stays small.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= 1).drop("_rank")


def latest_version(df: DataFrame, name: str, version: str) -> DataFrame:
    """Highest version number per name."""
    return df.groupBy(name).agg(F.max(version).alias("latest_version"), F.count(F.lit(1)).alias("n_versions"))
