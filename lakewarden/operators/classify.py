"""Personal data: by column name, by value, in free text; re-identification risk; column notes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakewarden.session import stage

# Labels and patterns.
NAME_RULES = [
    (r"(email|phone|street|address|first_name|last_name|c_name|s_name)", "PII"),
    (r"(region|nation|city|state|country|segment|date|birth|gender|zip)", "quasi-identifier"),
]
OTHER_LABEL = "non-PII"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE = r"(\+[0-9]{1,3} )?\([0-9]{3}\) [0-9]{3}-[0-9]{4}"
# The same addresses, tried only where a run of such characters begins or the last match ended, and without
# giving characters back: a long run without an at-sign costs one pass, not one from each of its characters.
EMAIL_IN_TEXT = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
VALUE_PATTERNS = {
    "EMAIL_ADDRESS": f"^{EMAIL}$",
    "PHONE_NUMBER": f"^{PHONE}$",
    "PERSON_NAME": r"^[A-Z][a-z]+$",
}
TEXT_PATTERNS = {"EMAIL_ADDRESS": EMAIL_IN_TEXT, "PHONE_NUMBER": PHONE}
# For engines whose matching is linear in any form.
PLAIN_PATTERNS = {"EMAIL_ADDRESS": EMAIL, "PHONE_NUMBER": PHONE}
# A character every match holds; texts without it skip the pattern.
TEXT_MARKERS = {"EMAIL_ADDRESS": "@", "PHONE_NUMBER": "("}


def classify_names(columns: DataFrame, rules: list[tuple[str, str]] = NAME_RULES) -> DataFrame:
    """Label by the first rule that matches the lower-case column name."""
    label = F.lit(OTHER_LABEL)
    for pattern, value in reversed(rules):
        label = F.when(F.lower("column_name").rlike(pattern), value).otherwise(label)
    return columns.withColumn("classification", label)


def classify_values(df: DataFrame, cols: list[str], patterns: dict[str, str] = VALUE_PATTERNS,
                    threshold: float = 0.8) -> DataFrame:
    """Share of values that match each pattern, for every column in one pass; kept at the threshold."""
    pairs = [(c, p) for c in cols for p in patterns]
    hits = [F.count_if(F.col(c).rlike(patterns[p])).alias(f"h_{i}") for i, (c, p) in enumerate(pairs)]
    filled = [F.count(F.col(c)).alias(f"n_{c}") for c in cols]
    one = df.agg(*filled, *hits)
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.lit(p).alias("label"),
                 F.try_divide(F.col(f"h_{i}").cast("double"), F.col(f"n_{c}").cast("double")).alias("share"))
        for i, (c, p) in enumerate(pairs)
    ]
    return one.select(F.inline(F.array(*rows))).filter(F.col("share") >= threshold)


def _count(text: Column, label: str) -> Column:
    found = F.regexp_count(text, F.lit(TEXT_PATTERNS[label]))
    return F.when(F.contains(text, F.lit(TEXT_MARKERS[label])), found).otherwise(0).cast("bigint")


def redact(text: Column) -> Column:
    """The whole text with every match replaced by [LABEL]."""
    out = text
    for label, pattern in TEXT_PATTERNS.items():
        masked = F.regexp_replace(out, pattern, f"[{label}]")
        out = F.when(F.contains(out, F.lit(TEXT_MARKERS[label])), masked).otherwise(out)
    return out


def pii_findings(df: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """One row per text and kind of personal data found, with the number of matches."""
    counts = F.array(*[
        F.struct(F.lit(label).alias("label"), _count(F.col(text_col), label).alias("matches"))
        for label in TEXT_PATTERNS
    ])
    return df.select(*keys, F.inline(counts)).filter(F.col("matches") > 0)


def pii_redact(df: DataFrame, text_col: str) -> DataFrame:
    return df.withColumn(text_col, redact(F.col(text_col)))


def qi_groups(df: DataFrame, qi_cols: list[str]) -> DataFrame:
    return df.groupBy(*qi_cols).agg(F.count(F.lit(1)).alias("group_size"))


def k_anonymity(df: DataFrame, qi_cols: list[str], k: int) -> DataFrame:
    """Smallest group, and rows whose combination is shared by fewer than ``k`` rows."""
    size = F.col("group_size")
    return qi_groups(df, qi_cols).agg(
        F.min(size).alias("min_k"),
        F.count(F.lit(1)).alias("n_groups"),
        F.sum(size).alias("n_rows"),
        F.coalesce(F.sum(F.when(size < k, size)), F.lit(0)).alias("rows_at_risk"),
    ).withColumn("share_at_risk", F.round(F.col("rows_at_risk").cast("double") / F.col("n_rows"), 6))


def describe_columns(columns: DataFrame) -> DataFrame:
    """A sentence per column from (table_name, column_name, data_type, n_rows, filled_rows)."""
    text = F.concat(
        F.lit("Column "), "column_name", F.lit(" of table "), "table_name", F.lit(" holds "), "data_type",
        F.lit(" values in "), F.col("filled_rows").cast("string"),
        F.lit(" of "), F.col("n_rows").cast("string"), F.lit(" rows."),
    )
    return columns.select("table_name", "column_name", text.alias("description"))


# Distinct values that stand for a column.
SKETCH_VALUES = 4096


def containment(df: DataFrame, columns: list[str], known: DataFrame, known_col: str, k: int | None = SKETCH_VALUES) -> DataFrame:
    """Share of each column's distinct values that are known ones, such as the names of people.

    A column is stood for by the ``k`` of its distinct values with the smallest hashes, a fair sample of them, which are
    looked up in the reference exactly. ``bound`` is 0 where these are all values, else 3 standard deviations of
    the share at most, 1.5 / sqrt(k). With ``k`` None every distinct value is looked up. Case and outer blanks are passed
    over; NULL and blank values do not count.
    """
    def normal(column: Column) -> Column:
        return F.lower(F.trim(column.cast("string")))

    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), normal(F.col(c)).alias("value")) for c in columns])
    values = df.select(F.inline(pairs)).filter("value <> ''").distinct()
    reference = known.select(normal(F.col(known_col)).alias("value"))
    if k is None:
        met = values.join(reference.distinct().withColumn("_hit", F.lit(True)), "value", "left").groupBy("column_name").agg(
            F.count(F.lit(1)).alias("_n"), F.count("_hit").alias("_hits"))
        share = F.col("_hits").cast("double") / F.col("_n").cast("double")
        return met.select("column_name", F.round(share, 6).alias("share"), F.lit(0.0).alias("bound"))
    place = F.row_number().over(Window.partitionBy("column_name").orderBy(F.xxhash64("value"), "value"))
    sketch = stage(values.withColumn("_place", place).filter(F.col("_place") <= k + 1), "sketch")
    picked = sketch.filter(F.col("_place") <= k).drop("_place")
    hits = reference.join(picked, "value").distinct().groupBy("column_name").agg(
        F.count(F.lit(1)).alias("_hits"))
    sizes = sketch.groupBy("column_name").agg(F.count(F.lit(1)).alias("_n"))
    share = F.coalesce("_hits", F.lit(0)).cast("double") / F.least("_n", F.lit(k)).cast("double")
    return sizes.join(hits, "column_name", "left").select(
        "column_name", F.round(share, 6).alias("share"), F.when(F.col("_n") > k, 1.5 / k ** 0.5).otherwise(0.0).alias("bound"))
