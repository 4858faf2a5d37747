"""Column expressions the layer transforms share."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,2)"


def money(column: str | Column) -> Column:
    """Exact amount with two decimals, so that sums do not depend on the order of rows."""
    return F.col(column).cast(MONEY) if isinstance(column, str) else column.cast(MONEY)


def clean_text(column: str | Column) -> Column:
    """Trimmed text with runs of white space folded to one blank; empty text becomes null."""
    value = F.col(column) if isinstance(column, str) else column
    return F.nullif(F.trim(F.regexp_replace(value, r"\s+", " ")), F.lit(""))


def day_string(column: str | Column) -> Column:
    """Day of a time as ``yyyy-MM-dd``, the form of the ``dt`` partition key."""
    value = F.col(column) if isinstance(column, str) else column
    return value.cast("date").cast("string")
