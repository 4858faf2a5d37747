"""Wide rows for consumption."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F


class Dimension(NamedTuple):
    """A table with one row per ``key``, looked up through ``foreign_key``."""

    frame: DataFrame
    key: str
    foreign_key: str


class RepeatedKeyError(ValueError):
    """A dimension holds a key more than once."""


def _check_key(dimension: Dimension) -> None:
    keys = dimension.frame.select(F.col(dimension.key).alias("key")).where("key is not null")
    repeated = keys.groupBy("key").count().where("count > 1").head(1)
    if repeated:
        raise RepeatedKeyError(f"dimension repeats {dimension.key} = {repeated[0]['key']!r}")


def denormalise(facts: DataFrame, dimensions: Sequence[Dimension]) -> DataFrame:
    """Every row of ``facts`` once, widened by its dimensions (null where one is missing).

    A later dimension may be looked up through a column of an earlier one. A dimension that
    repeats a key would multiply facts, and one that repeats a column name would hide it: both are
    errors. The keys are counted when this is called, with partial results.

    No join strategy is forced: Spark broadcasts a dimension whose size is within
    ``spark.sql.autoBroadcastJoinThreshold``, so that the facts stay where they are, and joins
    bigger ones by shuffle, where AQE splits foreign keys that hold very many facts. Give the
    dimensions one by one instead of joining them beforehand: Spark knows the size of a table,
    but takes the result of a join for big.
    """
    wide = facts
    for number, dimension in enumerate(dimensions):
        clash = (set(dimension.frame.columns) - {dimension.key}) & set(wide.columns)
        if clash:
            raise ValueError(f"columns of a dimension that are there already: {sorted(clash)}")
        _check_key(dimension)
        alias = f"_key{number}"
        side = dimension.frame.withColumnRenamed(dimension.key, alias)
        wide = wide.join(side, wide[dimension.foreign_key] == side[alias], "left").drop(alias)
    return wide
