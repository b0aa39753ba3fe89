"""Deterministic synthetic entities: every value is a function of (row number, salt).

The input is any DataFrame with a BIGINT column ``i``; rows are drawn in parallel and a lost
task redraws the same values. FK columns need the number of parents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewarden.functions.scalars import draw, pick, uuid_text

# Fixed values of the source data model.
REGIONS = ["NORTH", "SOUTH", "EAST", "WEST"]
CURRENCIES = ["USD", "EUR", "GBP", "CAD", "AUD"]
TRANSACTION_TYPES = ["purchase", "refund", "subscription"]
PRODUCT_CATEGORIES = [
    "Cloud Platform", "Data Analytics", "Security", "API Services",
    "Support", "Storage", "Compute", "ML Platform",
]
CHANNELS = ["email", "phone", "chat", "web"]
INTERACTION_TYPES = ["support", "marketing", "sales"]
TRANSACTION_OFFSET = 1_000_000
INTERACTION_OFFSET = 10_000_000
DATE_SPAN = 731

# Our own small name lists.
GIVEN = ["Ada", "Bo", "Cleo", "Dag", "Elif", "Femi", "Gita", "Hugo", "Ines", "Jun"]
FAMILY = ["Abe", "Brook", "Castro", "Dahl", "Eze", "Ford", "Gupta", "Holm", "Ito", "Jansen"]
SEPARATORS = [".", "_", ""]
TOWNS = ["Alder", "Birch", "Cedar", "Dune", "Elm", "Fern"]
LANDS = ["Freedonia", "Ruritania", "Sylvania"]


def _date(i: Column, salt: str) -> Column:
    return F.date_add(F.lit("2022-01-01").cast("date"), (draw(i, salt) % DATE_SPAN).cast("int"))


def _digits(i: Column, salt: str, width: int) -> Column:
    return F.lpad((draw(i, salt) % 10**width).cast("string"), width, "0")


def synth_customers(ids: DataFrame) -> DataFrame:
    i = F.col("i")
    first, last = pick(draw(i, "given"), GIVEN), pick(draw(i, "family"), FAMILY)
    suffix = F.when(draw(i, "has_suffix") % 10 < 4, (draw(i, "suffix") % 999 + 1).cast("string")).otherwise("")
    return ids.select(
        uuid_text(i + 1).alias("customer_id"),
        first.alias("first_name"),
        last.alias("last_name"),
        F.concat(F.lower(first), pick(draw(i, "sep"), SEPARATORS), F.lower(last), suffix,
                 F.lit("@example.com")).alias("email"),
        F.concat(F.lit("("), (draw(i, "area") % 800 + 200).cast("string"), F.lit(") "),
                 _digits(i, "mid", 3), F.lit("-"), _digits(i, "end", 4)).alias("phone"),
        F.concat((draw(i, "house") % 9999 + 1).cast("string"), F.lit(" "), pick(draw(i, "street"), TOWNS),
                 F.lit(" Street")).alias("street_address"),
        pick(draw(i, "town"), TOWNS).alias("city"),
        pick(draw(i, "state"), FAMILY).alias("state"),
        pick(draw(i, "land"), LANDS).alias("country"),
        pick(draw(i, "region"), REGIONS).alias("region"),
        _date(i, "created").alias("created_date"),
    )


def synth_transactions(ids: DataFrame, n_customers: int) -> DataFrame:
    i = F.col("i")
    return ids.select(
        uuid_text(i + TRANSACTION_OFFSET).alias("transaction_id"),
        uuid_text(draw(i, "customer") % n_customers + 1).alias("customer_id"),
        ((draw(i, "amount") % 499_901 + 100).cast("double") / 100.0).alias("amount"),
        pick(draw(i, "currency"), CURRENCIES).alias("currency"),
        pick(draw(i, "type"), TRANSACTION_TYPES).alias("transaction_type"),
        pick(draw(i, "category"), PRODUCT_CATEGORIES).alias("product_category"),
        _date(i, "date").alias("transaction_date"),
    )


def synth_interactions(ids: DataFrame, n_customers: int) -> DataFrame:
    i = F.col("i")
    return ids.select(
        uuid_text(i + INTERACTION_OFFSET).alias("interaction_id"),
        uuid_text(draw(i, "customer") % n_customers + 1).alias("customer_id"),
        pick(draw(i, "channel"), CHANNELS).alias("channel"),
        pick(draw(i, "type"), INTERACTION_TYPES).alias("interaction_type"),
        ((draw(i, "sentiment") % 10_001).cast("double") / 10_000.0).alias("sentiment_score"),
        _date(i, "date").alias("interaction_date"),
    )
