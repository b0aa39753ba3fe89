"""Profiles, drift, thresholds, usage."""

from __future__ import annotations

import math
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewarden.functions.scalars import exact_sum
from lakewarden.operators.lineage import trailing
from lakewarden.session import stage


def profile(df: DataFrame, table: str, columns: list[str] | None = None, distinct: str = "approx") -> DataFrame:
    """One row per column from a single aggregate over the table.

    Distinct values are approximate by default; "exact" counts them in a second pass over (column, value)
    pairs, each made distinct within its task before the shuffle; "none" leaves them out.
    """
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    aggs: list[Column] = [F.count(F.lit(1)).alias("n_rows")]
    rows = []
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        number = isinstance(f.dataType, T.NumericType)
        aggs += [F.count(c).alias(f"n{i}"), F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}")]
        if distinct == "approx":
            aggs.append(F.approx_count_distinct(c).alias(f"d{i}"))
        if number:
            aggs += [F.avg(c.cast("double")).alias(f"m{i}"), F.stddev(c.cast("double")).alias(f"s{i}")]
        none, text = F.lit(None).cast("double"), F.lit(None).cast("string")
        filled = F.col(f"n{i}")
        rows.append(F.struct(
            F.lit(table).alias("table_name"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col("n_rows"),
            (F.col("n_rows") - filled).alias("nulls"),
            F.round(F.try_divide((F.col("n_rows") - filled).cast("double"), F.col("n_rows").cast("double")), 6)
            .alias("null_rate"),
            (F.col(f"d{i}") if distinct == "approx" else F.lit(None).cast("bigint")).alias("distinct_values"),
            (F.col(f"lo{i}").cast("double") if number else none).alias("min_number"),
            (F.col(f"hi{i}").cast("double") if number else none).alias("max_number"),
            (text if number else F.col(f"lo{i}").cast("string")).alias("min_text"),
            (text if number else F.col(f"hi{i}").cast("string")).alias("max_text"),
            (F.round(F.col(f"m{i}"), 4) if number else none).alias("mean"),
            (F.round(F.col(f"s{i}"), 4) if number else none).alias("stddev"),
        ))
    found = df.agg(*aggs).select(F.inline(F.array(*rows)))
    if distinct != "exact" or not fields:
        return found

    def text_of(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")  # adding 0 makes the negative zero the same as the other
        return (c + 0.0 if isinstance(f.dataType, (T.FloatType, T.DoubleType)) else c).cast("string")

    pairs = F.array(*[F.struct(F.lit(f.name).alias("column_name"), text_of(f).alias("value")) for f in fields])
    counts = df.select(F.inline(pairs)).filter(F.col("value").isNotNull()).distinct().groupBy("column_name").agg(
        F.count(F.lit(1)).alias("_distinct"))
    return found.join(counts, "column_name", "left").withColumn(
        "distinct_values", F.coalesce("_distinct", F.lit(0))).select(*found.columns)


def drift(df: DataFrame, col: str, current: Column, edges: list[float], epsilon: float = 1e-6) -> DataFrame:
    """Population stability index and null-rate change of ``col`` between two windows of one table.

    ``current`` marks the rows of the later window; the bins lie between ``edges``, open at both
    ends. All bins of both windows are counted in one aggregate.
    """
    value = F.col(col)
    limits = [-math.inf, *edges, math.inf]
    windows = {"b": ~current, "c": current}
    aggs = []
    for w, inside in windows.items():
        aggs += [F.count_if(inside).alias(f"{w}_rows"), F.count_if(inside & value.isNotNull()).alias(f"{w}_n")]
        for i, (lo, hi) in enumerate(zip(limits, limits[1:])):
            aggs.append(F.count_if(inside & (value >= lo) & (value < hi)).alias(f"{w}_{i}"))

    def share(w: str, i: int) -> Column:
        return F.greatest(F.try_divide(F.col(f"{w}_{i}").cast("double"), F.col(f"{w}_n").cast("double")),
                          F.lit(epsilon))

    def null_rate(w: str) -> Column:
        rows = F.col(f"{w}_rows").cast("double")
        return F.try_divide(rows - F.col(f"{w}_n"), rows)

    psi = F.lit(0.0)
    for i in range(len(limits) - 1):
        p, q = share("b", i), share("c", i)
        psi = psi + (p - q) * F.ln(p / q)
    return df.agg(*aggs).select(
        F.lit(col).alias("column_name"),
        F.col("b_rows").alias("base_rows"),
        F.col("c_rows").alias("current_rows"),
        F.round(psi, 6).alias("psi"),
        F.round(null_rate("c") - null_rate("b"), 6).alias("null_rate_delta"),
    )


def unpivot_metrics(profiled: DataFrame, metrics: list[str]) -> DataFrame:
    """(table_name, column_name, metric, value) rows of a profile."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
    return profiled.select("table_name", "column_name", F.inline(pairs))


def evaluate(metrics: DataFrame, thresholds: list[tuple[str, float, float]]) -> DataFrame:
    """pass or warn per metric with a threshold (metric, lowest, highest)."""
    limits = metrics.sparkSession.createDataFrame(thresholds, "metric string, lowest double, highest double")
    inside = F.col("value").between(F.col("lowest"), F.col("highest"))
    return metrics.join(limits, "metric").select(
        "table_name", "column_name", "metric", "value",
        F.when(F.coalesce(inside, F.lit(False)), "pass").otherwise("warn").alias("status"),
    )


def usage_summary(usage: DataFrame, as_of: date, days: int = 7, scale: int | None = None) -> DataFrame:
    """Usage per sku and unit in the trailing window, largest first; ``scale`` as in ``exact_sum``."""
    quantity = exact_sum("usage_quantity", scale)
    return (
        usage.filter(trailing("usage_date", as_of, days))
        .groupBy("sku_name", "usage_unit").agg(quantity.alias("total_usage"))
        .orderBy(F.col("total_usage").desc(), "sku_name", "usage_unit")
    )


def daily_profile(df: DataFrame, table: str, day: str, columns: list[str]) -> DataFrame:
    """One row per column and day, to be kept: counts, range, a quantile sketch of numbers and a sketch of distinct values.

    Days can be merged for any window by ``merge_profiles`` without reading the table again. Texts have no quantiles.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    aggs, rows = [F.count(F.lit(1)).alias("n_rows")], []
    for i, c in enumerate(columns):
        number = isinstance(kinds[c], T.NumericType)
        value = F.col(c).cast("double") if number else F.lit(None).cast("double")
        aggs += [F.count(c).alias(f"n{i}"), F.min(value).alias(f"lo{i}"), F.max(value).alias(f"hi{i}"),
                 F.hll_sketch_agg(F.col(c).cast("string")).alias(f"d{i}")]
        if number:
            aggs.append(F.kll_sketch_agg_double(value).alias(f"q{i}"))
        rows.append(F.struct(
            F.lit(table).alias("table_name"), F.lit(c).alias("column_name"), F.col(day).alias("day"), F.col("n_rows"),
            F.col(f"n{i}").alias("filled"), F.col(f"lo{i}").alias("low"), F.col(f"hi{i}").alias("high"), F.col(f"d{i}").alias("distinct"),
            (F.when(F.col(f"n{i}") > 0, F.col(f"q{i}")) if number else F.lit(None).cast("binary")).alias("quantiles")))
    return df.groupBy(day).agg(*aggs).select(F.inline(F.array(*rows)))


def merge_profiles(days: DataFrame) -> DataFrame:
    """One row per column over all given days: exact counts and range, estimated distinct values and quartiles.

    ``quantiles`` is the merged sketch, for ``quantile_edges`` and further merging.
    """
    merged = days.groupBy("table_name", "column_name").agg(
        F.sum("n_rows").alias("n_rows"), (F.sum("n_rows") - F.sum("filled")).alias("nulls"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("distinct_values"),
        F.count("quantiles").alias("_n"), F.kll_merge_agg_double("quantiles").alias("quantiles"))
    held = F.when(F.col("_n") > 0, F.col("quantiles"))
    return merged.withColumn("quantiles", held).select(
        "*", *[F.when(F.col("_n") > 0, F.kll_sketch_get_quantile_double("quantiles", F.lit(p))).alias(n)
               for p, n in ((0.25, "lower_quartile"), (0.5, "median"), (0.75, "upper_quartile"))]).drop("_n")


def quantile_edges(merged: DataFrame, column: str, bins: int = 10) -> list[float]:
    """Edges of bins that hold equal shares of a merged profile's column, for ``drift``; equal edges fall together."""
    row = merged.filter((F.col("column_name") == column) & F.col("quantiles").isNotNull()).select(
        *[F.kll_sketch_get_quantile_double("quantiles", F.lit(i / bins)).alias(f"e{i}") for i in range(1, bins)]).first()
    return sorted(set(row)) if row else []


def ks_drift(df: DataFrame, col: str, current: Column) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance of ``col`` between the rows of the later window and the others.

    Rows are counted per value, values dealt to tasks by range, and added up within each; only one sum per task
    runs over all of them. NULL and NaN take no part; the distance is NULL if a window has no values.
    """
    value = F.col(col).cast("double")
    counts = df.filter(value.isNotNull() & ~F.isnan(value)).select((value + 0.0).alias("value"), current.alias("late")).groupBy("value").agg(
        F.count_if(~F.col("late")).alias("b"), F.count_if("late").alias("c"))
    laid = stage(stage(counts, "values").repartitionByRange("value").sortWithinPartitions("value").select(
        F.monotonically_increasing_id().alias("place"), "b", "c").withColumn("part", F.call_function("shiftright", F.col("place"), F.lit(33))), "ordered")
    # One row per task.
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = laid.groupBy("part").agg(F.sum("b").alias("b"), F.sum("c").alias("c"))
    starts = stage(parts.select("part", *[F.coalesce(F.sum(x).over(ahead), F.lit(0)).alias(f"{x}0") for x in "bc"],
                                *[F.sum(x).over(Window.partitionBy()).alias(f"{x}n") for x in "bc"]), "starts")
    upto = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    run = laid.select("part", *[F.sum(x).over(upto).alias(x) for x in "bc"]).join(starts, "part")
    share = [(F.col(x) + F.col(f"{x}0")).cast("double") / F.col(f"{x}n").cast("double") for x in "bc"]
    gap = F.when((F.col("bn") > 0) & (F.col("cn") > 0), F.abs(share[0] - share[1]))
    return run.agg(F.coalesce(F.max("bn"), F.lit(0)).alias("base_rows"), F.coalesce(F.max("cn"), F.lit(0)).alias("current_rows"),
                   F.round(F.max(gap), 9).alias("ks")).select(F.lit(col).alias("column_name"), "*")
