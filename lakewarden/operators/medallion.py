"""Cleaned tables, per-customer totals and the gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewarden.functions.scalars import MONEY, all_present, exact_avg, exact_sum, health_score, month_of

# The columns of a cleaned customer and the features of the churn model.
FEATURES = ["transaction_count", "total_amount", "interaction_count", "avg_sentiment"]
CUSTOMER_COLUMNS = ["customer_id", "first_name", "last_name", "email", "phone", "street_address", "city",
                    "state", "country", "region"]


def clean_customers(df: DataFrame, strict: bool = True) -> DataFrame:
    """Rows with an id; the strict form also asks for an e-mail address."""
    kept = df.filter(all_present("customer_id", "email") if strict else all_present("customer_id"))
    return kept.select(*CUSTOMER_COLUMNS, F.col("created_date").cast("date").alias("created_date"))


def clean_transactions(df: DataFrame, strict: bool = True) -> DataFrame:
    """Rows with ids and an amount; the strict form also drops negative amounts.

    Text amounts become DOUBLE; a numeric amount keeps its type.
    """
    amount = F.col("amount")
    if dict(df.dtypes)["amount"] == "string":
        amount = amount.try_cast("double")
    typed = df.withColumns({"amount": amount, "transaction_date": F.col("transaction_date").cast("date")})
    kept = typed.filter(all_present("transaction_id", "customer_id", "amount"))
    return kept.filter(F.col("amount") >= 0) if strict else kept


def clean_interactions(df: DataFrame, strict: bool = True) -> DataFrame:
    """Rows with ids; the strict form also asks for an interaction type."""
    keys = ["interaction_id", "customer_id"] + (["interaction_type"] if strict else [])
    return df.filter(all_present(*keys)).select(
        "interaction_id", "customer_id", "channel", "interaction_type",
        F.col("sentiment_score").cast("double").alias("sentiment_score"),
        F.col("interaction_date").cast("date").alias("interaction_date"),
    )


def transaction_totals(t: DataFrame) -> DataFrame:
    return t.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_transactions"), exact_sum("amount").alias("total_amount"))


def totals_by_parent(t: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """transaction_totals for transactions that reach their customer through a parent record.

    ``parents`` has (key, customer_id). Transactions are added up per parent before that join, on
    the join's own partitioning: fewer rows travel, and a parent with very many rows is one row.
    """
    per_parent = t.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("amount").cast(MONEY)).alias("amount"))
    return (
        per_parent.join(parents.select(key, "customer_id").filter(all_present("customer_id")), key)
        .groupBy("customer_id")
        .agg(F.sum("n").alias("total_transactions"), F.sum("amount").cast("double").alias("total_amount"))
    )


def interaction_totals(i: DataFrame, scale: int | None = None) -> DataFrame:
    """Count and mean sentiment per customer; ``scale`` rounds the scores to so many places, see ``exact_avg``."""
    return i.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("interaction_count"), exact_avg("sentiment_score", scale).alias("avg_sentiment"))


def customer_health(c: DataFrame, totals: DataFrame, i: DataFrame, scale: int | None = None) -> DataFrame:
    """Customers with their activity; both sides are aggregated before the join, so nothing fans out."""
    joined = c.join(totals, "customer_id", "left").join(interaction_totals(i, scale), "customer_id", "left")
    return joined.select(
        "customer_id", "first_name", "last_name", "region", "created_date",
        F.coalesce("total_transactions", F.lit(0)).alias("transaction_count"),
        F.coalesce("total_amount", F.lit(0.0)).alias("total_amount"),
        F.coalesce("interaction_count", F.lit(0)).alias("interaction_count"),
        F.coalesce("avg_sentiment", F.lit(0.0)).alias("avg_sentiment"),
        health_score("customer_id").alias("health_score"),
    )


def customer_health_v2(c: DataFrame, totals: DataFrame, i: DataFrame, scale: int | None = None) -> DataFrame:
    """The later definition: other names, no date, no interaction count."""
    return customer_health(c, totals, i, scale).select(
        "customer_id", "first_name", "last_name", "region",
        F.col("transaction_count").alias("total_transactions"),
        F.col("total_amount").alias("total_spend"),
        "avg_sentiment", "health_score",
    )


def revenue_summary(t: DataFrame, c: DataFrame | None = None, only_purchases: bool = True) -> DataFrame:
    """Count, sum and mean by region, category and month.

    The setup variant counts purchases only; the later one counts all types and names the mean
    avg_transaction_value. Without ``c`` the transactions carry their region already.
    """
    if only_purchases:
        t = t.filter(F.col("transaction_type") == "purchase")
    if c is not None:
        t = t.join(c.select("customer_id", "region"), "customer_id")
    mean = "avg_revenue" if only_purchases else "avg_transaction_value"
    return t.groupBy("region", "product_category", month_of("transaction_date").alias("month")).agg(
        F.count(F.lit(1)).alias("transaction_count"),
        exact_sum("amount").alias("total_revenue"),
        exact_avg("amount").alias(mean),
    )


def segment(df: DataFrame, name: str, n: int, key: str = "customer_id") -> DataFrame:
    """The first ``n`` rows by key under a constant label."""
    return df.orderBy(key).limit(n).select("customer_id", "email", "region", F.lit(name).alias("segment"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """COUNT(*) per table, all in one job."""
    counts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
              for n, df in tables.items()]
    out = counts[0]
    for one in counts[1:]:
        out = out.unionByName(one)
    return out


def distribution(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(F.col(col).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(col).alias("column_name"), "value", "n_rows")


def churn_features(health: DataFrame) -> DataFrame:
    """Four features with NULL as 0, and the label health_score < 50."""
    return health.fillna(0, subset=FEATURES).select(
        "customer_id", *FEATURES, (F.col("health_score") < 50).cast("int").alias("churned"))
