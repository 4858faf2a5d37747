"""Aggregates of the curated layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stratalake.functions import MONEY, money


def daily_summary(df: DataFrame, time_column: str, amount_column: str) -> DataFrame:
    """``(date, total_amount, total_count)``; a day sends one partial row per task."""
    return df.groupBy(F.col(time_column).cast("date").alias("date")).agg(
        F.sum(money(amount_column)).cast(MONEY).alias("total_amount"),
        F.count(F.lit(1)).alias("total_count"),
    )
