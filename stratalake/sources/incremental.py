"""Incremental reads of lake tables.

The target of a job notes how far the job has read its source, in the same ledger line that
publishes the rows. So a run that dies is repeated as a whole, and one that has finished is not.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from stratalake import files, iceberg, ledger
from stratalake.layers import resolve

# Operations after which a table holds the same rows as before.
SAME_ROWS = ("create", "alter", "compact")


class HistoryExpiredError(ValueError):
    """Snapshots since the bookmark are gone; the source has to be read as a whole."""


class Increment(NamedTuple):
    """Rows to process, the bookmark to write with the result, and how to write it."""

    rows: DataFrame
    bookmark: ledger.Bookmark
    mode: str


def _positions(spark: SparkSession, source: str, target: str) -> tuple[str, int, list[int]]:
    for table in (source, target):
        iceberg.refuse(spark, table, "an incremental read")
    location = files.qualify(spark, resolve(spark, source))
    ids = ledger.snapshot_ids(spark, location)
    if not ids:
        raise ValueError(f"no such table: {source}")
    written = ledger.latest(spark, resolve(spark, target))
    done = written.bookmarks.get(location, 0) if written else 0
    return location, done, ids


def _whole(spark: SparkSession, location: str, snapshot_id: int, mode: str) -> Increment:
    snapshot = ledger.load(spark, location, snapshot_id)
    rows = ledger.rows_in(spark, location, snapshot.dirs, snapshot.schema)
    return Increment(rows, ledger.Bookmark(location, snapshot_id), mode)


def bookmark_of(spark: SparkSession, target: str, source: str) -> int:
    """How far ``target`` has read what is called ``source``; 0 if not at all."""
    written = ledger.latest(spark, resolve(spark, target))
    return written.bookmarks.get(source, 0) if written else 0


def read_new(
    spark: SparkSession, source: str, target: str, *, on_expired: str = "error"
) -> Increment | None:
    """Rows appended to ``source`` since the last run that wrote ``target``; None without any.

    Only appends have new rows that can be told from old ones. After an upsert or an overwrite of
    the source this raises ``ValueError``; ``read_changed`` goes by partitions instead.
    If snapshots since the bookmark have expired, this raises ``HistoryExpiredError``, or with
    ``on_expired="whole"`` gives all rows of the source with the mode ``overwrite``. Rows the target
    has already are among them, so replace it, or upsert.
    """
    if on_expired not in ("error", "whole"):
        raise ValueError(f"on_expired must be error or whole, not {on_expired!r}")
    location, done, ids = _positions(spark, source, target)
    if done == 0:
        return _whole(spark, location, ids[-1], "append")
    if ids[-1] == done:
        return None
    expected = range(done, ids[-1] + 1)
    missing = sorted(set(expected) - set(ids))
    if missing and on_expired == "whole":
        return _whole(spark, location, ids[-1], "overwrite")
    if missing:
        raise HistoryExpiredError(f"{source} has no snapshot {missing[0]} any more")
    added: list[str] = []
    before = ledger.load(spark, location, done)
    for number in (i for i in ids if i > done):
        after = ledger.load(spark, location, number)
        if after.operation == "append":
            added += set(after.dirs) - set(before.dirs)
        elif after.operation not in SAME_ROWS:
            raise ValueError(f"snapshot {number} of {source} is no append: {after.operation}")
        before = after
    if not added:
        return None
    rows = ledger.rows_in(spark, location, sorted(added), before.schema)
    return Increment(rows, ledger.Bookmark(location, ids[-1]), "append")


def read_changed(spark: SparkSession, source: str, target: str) -> Increment | None:
    """All current rows of the partitions of ``source`` that changed since the last run.

    For results per partition, written with the increment's mode: partitions in the result are
    replaced, or the whole target where the source is read for the first time, has lost a
    partition, or no longer has the snapshot of the bookmark.
    """
    location, done, ids = _positions(spark, source, target)
    if ids[-1] == done:
        return None
    if done not in ids:
        return _whole(spark, location, ids[-1], "overwrite")
    before = ledger.load(spark, location, done)
    after = ledger.load(spark, location, ids[-1])
    touched = {ledger.partition_of(d) for d in set(before.dirs) ^ set(after.dirs)}
    if not touched:
        return None
    dirs = [d for d in after.dirs if ledger.partition_of(d) in touched]
    lost = touched - {ledger.partition_of(d) for d in dirs}
    if lost or not after.partition_by:
        return _whole(spark, location, ids[-1], "overwrite")
    rows = ledger.rows_in(spark, location, dirs, after.schema)
    return Increment(rows, ledger.Bookmark(location, ids[-1]), "overwrite_partitions")
