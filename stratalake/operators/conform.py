"""Conforming: differently shaped sources under one schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame


def conform(df: DataFrame, mapping: Mapping[str, Column]) -> DataFrame:
    """``df`` with the columns of ``mapping`` (common name → expression)."""
    return df.select(*[expression.alias(name) for name, expression in mapping.items()])


def conform_union(sources: Sequence[tuple[DataFrame, Mapping[str, Column]]]) -> DataFrame:
    """All rows of all sources; a common column that a source lacks is null."""
    frames = [conform(df, mapping) for df, mapping in sources]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
