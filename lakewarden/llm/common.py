"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What parts words, and what is part of one.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def named(df: DataFrame, name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the given columns, under the operator's own names; others, however named, are left out."""
    return df.select(*[named(df, source).alias(own) for own, source in columns.items()])


def free_name(df: DataFrame, base: str) -> str:
    """``base``, or the first ``base_N`` that no column of ``df`` has in any case."""
    taken = {c.lower() for c in df.columns}
    name, n = base, 0
    while name.lower() in taken:
        n += 1
        name = f"{base}_{n}"
    return name


def word_count(text: Column) -> Column:
    """Words of a text; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas in the order given."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
