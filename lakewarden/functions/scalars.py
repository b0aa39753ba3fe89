"""Column expressions. All are built-ins, so they stay inside code generation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_SCALE = 4
MONEY = f"decimal(18,{MONEY_SCALE})"


def exact_sum(col: str | Column, scale: int | None = MONEY_SCALE) -> Column:
    """SUM as DOUBLE, added up in decimals of that many places so that the order of rows cannot change it.

    Values with more places are rounded to ``scale`` first; None adds them up as they are.
    """
    if scale is None:
        return F.sum(_col(col).cast("double"))
    return F.sum(_col(col).cast(f"decimal({14 + scale},{scale})")).cast("double")


def exact_avg(col: str | Column, scale: int | None = MONEY_SCALE) -> Column:
    """AVG over the non-null values, from the same sum; NULL when there are none."""
    return F.try_divide(exact_sum(col, scale), F.count(_col(col)).cast("double"))


def health_score(col: str | Column) -> Column:
    """round((md5(id) as a 128-bit integer mod 1000) / 10, 1).

    The 32 hex digits are read as three numbers that fit a BIGINT (12, 10 and 10 digits);
    2^40 and 2^80 leave 776 and 176 modulo 1000.
    """
    digest = F.md5(_col(col).cast("string"))

    def part(start: int, length: int) -> Column:
        return F.conv(F.substring(digest, start, length), 16, 10).cast("bigint") % 1000

    bucket = (part(1, 12) * 176 + part(13, 10) * 776 + part(23, 10)) % 1000
    return F.round(bucket.cast("double") / 10.0, 1)


def uuid_text(col: str | Column) -> Column:
    """UUID text of a non-negative BIGINT: its 16 hex digits end the 32 of the UUID."""
    digits = F.lpad(F.lower(F.hex(_col(col))), 16, "0")
    return F.concat(F.lit("00000000-0000-0000-"), F.substring(digits, 1, 4), F.lit("-"), F.substring(digits, 5, 12))


def month_of(col: str | Column) -> Column:
    return F.date_trunc("month", _col(col))


def draw(col: str | Column, salt: str) -> Column:
    """A 60-bit number fixed by (value, salt): the generator's random draw."""
    digest = F.md5(F.concat(_col(col).cast("string"), F.lit(":" + salt)))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def pick(index: Column, values: list[str]) -> Column:
    """The list entry at ``index`` modulo the list length."""
    return F.element_at(F.array(*map(F.lit, values)), (index % len(values) + 1).cast("int"))


def all_present(*cols: str) -> Column:
    """None of the columns is NULL; unlike dropna this reaches the scan."""
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in cols])


def _col(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col
