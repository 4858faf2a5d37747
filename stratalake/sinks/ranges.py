"""Ranges of a key in the folders of a lake table: what a commit notes, and who may hold a key."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from decimal import Decimal
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    IntegralType,
    StringType,
    StructType,
    TimestampNTZType,
)

from stratalake import ledger


def reader_of(kind: DataType) -> Callable[[str], Any] | None:
    """What makes comparable values of the texts of a type; None if ranges of it are not kept.

    Times as texts compare as they do themselves, and texts by code points, as Spark does.
    """
    if isinstance(kind, IntegralType):
        return int
    if isinstance(kind, DecimalType):
        return Decimal
    if isinstance(kind, (DateType, TimestampNTZType)) or kind == StringType():
        return str
    return None


def folder_ranges(
    spark: SparkSession, location: str, dirs: Sequence[str], schema: StructType, column: str
) -> dict[str, tuple[str | None, str | None]]:
    """The least and the largest value of ``column`` in each of the folders; reads that column."""
    if not dirs or column not in schema.names or reader_of(schema[column].dataType) is None:
        return {}
    if column in ledger.partition_values(dirs[0]):
        return {}  # the folder's name says it
    rows = ledger.rows_in(spark, location, list(dirs), schema)
    path = ledger.decoded(F.col("_metadata.file_path"))
    value = F.col(f"`{column}`")
    found = (
        rows.select(ledger.dir_of(path).alias("_dir"), value.alias("_value"))
        .groupBy("_dir")
        .agg(F.min("_value").cast("string").alias("low"), F.max("_value").cast("string").alias("high"))
    )
    return {row["_dir"]: (row["low"], row["high"]) for row in found.collect()}


def folders_around(source: DataFrame, snapshot: ledger.Snapshot, column: str) -> list[str]:
    """Folders of a snapshot that may hold a value of ``column`` that occurs in ``source``: those
    with such a value within their range, and those whose range is not known.

    Tasks compare sorted batches of values with all ranges; each hands on every folder once.
    """
    known = snapshot.ranges
    read = reader_of(snapshot.schema[column].dataType)
    if known is None or known.column != column or read is None:
        return list(snapshot.dirs)
    unknown = [name for name in snapshot.dirs if name not in known.folders]
    bounds = [(name, *known.folders[name]) for name in snapshot.dirs if name in known.folders]
    bounds = [(name, read(low), read(high)) for name, low, high in bounds if low is not None]
    if not bounds:
        return unknown
    lows = np.array([low for _, low, _ in bounds] + [None], object)[:-1]
    highs = np.array([high for _, _, high in bounds] + [None], object)[:-1]

    def compare(batches):
        left = np.arange(len(lows))
        for batch in batches:
            values = np.array(sorted({read(v) for v in batch.column("value").to_pylist()}) + [None], object)[:-1]
            next_ = np.searchsorted(values, lows[left])
            there = next_ < len(values)
            there[there] = (values[next_[there]] <= highs[left[there]]).astype(bool)
            if there.any():
                yield pa.RecordBatch.from_arrays([pa.array(left[there], pa.int32())], names=["place"])
                left = left[~there]
            if not len(left):
                break

    values = source.select(F.col(f"`{column}`").cast("string").alias("value")).where("value is not null")
    hit = values.mapInArrow(compare, "place int").distinct().collect()
    return unknown + [bounds[row["place"]][0] for row in hit]
