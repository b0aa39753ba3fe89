"""The scoring, masking and row-filter functions under names that SQL text can call.

They are SQL functions, which the optimizer inlines: a filter through one still reaches the scan.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def register_sql_functions(spark: SparkSession, is_admin: bool, allowed: str, keep: int = 2) -> None:
    """Temporary functions of this session for one caller, whose membership is already known.

    Calling it again replaces them everywhere at once.
    """
    admin = "TRUE" if is_admin else "FALSE"
    value = "'" + allowed.replace("\\", "\\\\").replace("'", "\\'") + "'"
    bucket = " + ".join(
        f"CAST(conv(substr(md5(id), {start}, {length}), 16, 10) AS BIGINT) % 1000 * {factor}"
        for start, length, factor in ((1, 12, 176), (13, 10, 776), (23, 10, 1)))
    definitions = {
        "score_customer_health(id STRING) RETURNS DOUBLE":
            f"round(CAST(({bucket}) % 1000 AS DOUBLE) / 10, 1)",
        "mask_pii(plain STRING) RETURNS STRING":
            f"CASE WHEN {admin} THEN plain ELSE concat(left(plain, {int(keep)}), '****') END",
        "filter_by_region(found STRING) RETURNS BOOLEAN":
            f"CASE WHEN {admin} THEN TRUE ELSE found = {value} END",
    }
    for signature, body in definitions.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
