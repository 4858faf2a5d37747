"""Cleaning: rows without a key, untidy text, superseded versions of a row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from stratalake.functions import clean_text


def drop_missing_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    # Unlike dropna, these conditions are pushed into the scan.
    return df.where(reduce(lambda a, b: a & b, [F.col(key).isNotNull() for key in keys]))


def normalise_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({name: clean_text(name) for name in columns})


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]
) -> DataFrame:
    """The first row of every key in the given order, which should be total.

    The filter on ``row_number`` lets Spark keep one row per key in each task before the shuffle,
    so a key with very many versions sends only one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return df.withColumn("_version", rank).where("_version = 1").drop("_version")


def clean(
    df: DataFrame,
    keys: Sequence[str],
    newest_first: Sequence[Column],
    text_columns: Sequence[str] = (),
) -> DataFrame:
    """Rows with a key, tidy text, newest version of each key."""
    tidy = normalise_text(df, text_columns) if text_columns else df
    return latest_per_key(drop_missing_keys(tidy, keys), keys, newest_first)
