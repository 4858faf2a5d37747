"""Deliveries into a standard table, each of which can be landed again.

The rows of a landing go to a folder of their own, ``_landed/<delivery>/<run>/<partition>``. Only
when all of them stand do the catalog's partitions turn to the new folders, and the old folders go
last. So a landing that dies, wherever it does, leaves the rows of the one before it readable.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import batched

from pyspark.sql import DataFrame, SparkSession

from stratalake import catalog, files
from stratalake.catalog import Column
from stratalake.sinks.raw import write_raw

LANDED = "_landed"
PARTITIONS_A_STATEMENT = 500


def _new_run() -> str:
    return f"run-{int(time.time() * 1000):014d}-{uuid.uuid4().hex[:12]}"


def _finished_runs(spark: SparkSession, folder: str) -> list[str]:
    """Runs below the folder of a delivery whose write came to its end, the newest last."""
    runs = files.children(spark, folder, directories=True)
    return [run for run in runs if files.exists(spark, f"{folder}/{run}/_SUCCESS")]


def _partitions_in(spark: SparkSession, run: str, depth: int) -> dict[tuple[tuple[str, str | None], ...], str]:
    """Location by partition values, of one run."""
    found = files.partition_dirs(spark, run, depth)
    return {tuple(catalog.values_of(name).items()): f"{run}/{name}" for name in found}


def _register(
    spark: SparkSession,
    table: str,
    columns: Sequence[Column],
    location: str,
    keys: Sequence[Column],
    delivery: Column,
    comment: str,
) -> None:
    """The table in the catalog. A catalog that has lost it gets the partitions from the folders:
    those of the standard layout, and of each delivery the newest run that was finished."""
    if spark.catalog.tableExists(table):
        return
    catalog.create_external_table(
        spark, table, columns, location=location, partition_by=[*keys, delivery], comment=comment
    )
    for name in files.children(spark, f"{location}/{LANDED}", directories=True):
        folder = f"{location}/{LANDED}/{name}"
        for run in _finished_runs(spark, folder)[-1:]:
            there = _partitions_in(spark, f"{folder}/{run}", len(keys))
            _turn(spark, table, catalog.values_of(name), there)


def _turn(
    spark: SparkSession,
    table: str,
    delivery: Mapping[str, str | None],
    wanted: Mapping[tuple[tuple[str, str | None], ...], str],
) -> list[dict[str, str | None]]:
    """Make ``wanted`` (location by values) the partitions of a delivery; returns those it had.

    A partition that stays turns from its old folder to the new one in one step, never without
    rows. Partitions the delivery no longer has go last.
    """
    before = catalog.partitions(spark, table, delivery)
    new = {tuple((dict(values) | dict(delivery)).items()): place for values, place in wanted.items()}
    known = {frozenset(values.items()) for values in before}
    moved = {values: place for values, place in new.items() if frozenset(values) in known}
    with ThreadPoolExecutor(max_workers=files.REQUESTS) as pool:
        list(pool.map(lambda x: catalog.move_partition(spark, table, dict(x[0]), x[1]), moved.items()))
    added = [(dict(values), place) for values, place in new.items() if values not in moved]
    for some in batched(added, PARTITIONS_A_STATEMENT):
        catalog.add_partitions(spark, table, some)
    live = {frozenset(values) for values in new}
    gone = [values for values in before if frozenset(values.items()) not in live]
    for some in batched(gone, PARTITIONS_A_STATEMENT):
        catalog.drop_partitions(spark, table, some)
    spark.catalog.refreshTable(table)
    return before


def land_delivery(
    df: DataFrame,
    table: str,
    columns: Sequence[Column],
    *,
    location: str,
    partition_by: Sequence[Column],
    delivery: Column,
    value: str,
    comment: str = "",
) -> DataFrame:
    """Make ``df`` the rows of one delivery of a standard table; returns the table.

    ``delivery`` is the table's last partition column, ``value`` the name of this one. Rows of
    other deliveries are left alone. One landing of a delivery at a time.
    """
    spark = df.sparkSession
    keys = [key.name for key in partition_by]
    name = f"{delivery.name}={catalog.path_value(value)}"
    folder, run = f"{location}/{LANDED}/{name}", _new_run()
    write_raw(df, f"{folder}/{run}", partition_by=keys)
    _register(spark, table, columns, location, partition_by, delivery, comment)
    there = _partitions_in(spark, f"{folder}/{run}", len(keys))
    before = _turn(spark, table, {delivery.name: value}, there)
    # Folders of earlier landings, of such as died, and of the standard layout.
    old = [f"{folder}/{r}" for r in files.children(spark, folder, directories=True) if r != run]
    for values in before:
        below = [f"{key}={_folder_value(values[key])}" for key in keys]
        old.append("/".join([location, *below, name]))
    files.delete(spark, *old)
    return spark.table(table)


def _folder_value(value: str | None) -> str:
    return catalog.NULL_PARTITION if value is None else catalog.path_value(value)
