"""Table maintenance as DataFrame operators: what to merge, expire and delete.

They return lists and delete nothing; ``lake_maintenance`` applies them to lake tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# The defaults of the maintenance jobs.
SNAPSHOT_RETENTION_DAYS = 7
SNAPSHOTS_TO_RETAIN = 3
ORPHAN_RETENTION_DAYS = 7


def list_files(spark: SparkSession, *paths: str) -> DataFrame:
    """``(path, length, modified)`` of all files below the paths, times in UTC; none is opened."""
    listing = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    )
    in_utc = F.convert_timezone(
        F.current_timezone(), F.lit("UTC"), F.col("modificationTime").cast("timestamp_ntz")
    )
    return listing.select("path", "length", in_utc.alias("modified"))


def compaction_plan(
    files: DataFrame, group_by: Sequence[str | Column], size: str, target_bytes: int
) -> DataFrame:
    """Per group: number of files, their bytes and how many files of the target size would do."""
    total = F.sum(F.col(size)).cast("bigint")
    return files.groupBy(*group_by).agg(
        F.count(F.lit(1)).alias("n_files"),
        total.alias("bytes"),
        F.ceil(total / F.lit(target_bytes)).cast("bigint").alias("target_files"),
    )


def cut_of(as_of: datetime, days: int) -> Column:
    # As text, which no time zone changes on its way.
    return F.lit((as_of - timedelta(days=days)).isoformat(sep=" ")).cast("timestamp_ntz")


def _newest(
    snapshots: DataFrame, table: str, snapshot: str, committed_at: str, keep: int
) -> DataFrame:
    """The ``keep`` newest snapshots of every table.

    Spark keeps only that many rows per table in each task before the shuffle, so a table with
    very many snapshots is no burden.
    """
    newest_first = Window.partitionBy(table).orderBy(F.desc(committed_at), F.desc(snapshot))
    return (
        snapshots.select(table, snapshot, committed_at)
        .withColumn("_rank", F.row_number().over(newest_first))
        .where(F.col("_rank") <= keep)
        .drop("_rank")
    )


def expired_snapshots(
    snapshots: DataFrame,
    *,
    table: str,
    snapshot: str,
    committed_at: str,
    as_of: datetime,
    days: int = SNAPSHOT_RETENTION_DAYS,
    keep: int = SNAPSHOTS_TO_RETAIN,
) -> DataFrame:
    """Snapshots older than ``days`` that are not among the ``keep`` newest of their table.

    Ranking every snapshot would put a whole table into one task. Instead the old snapshots are
    compared with the newest few by (table, snapshot), a key that cannot be hot.
    """
    old = F.col(committed_at) < cut_of(as_of, days)
    newest = _newest(snapshots, table, snapshot, committed_at, keep).where(old)
    candidates = snapshots.where(old)
    kept = newest.select(table, snapshot)
    return candidates.join(kept, [table, snapshot], "left_anti").select(*snapshots.columns)


def with_expiry(
    snapshots: DataFrame,
    *,
    table: str,
    snapshot: str,
    committed_at: str,
    as_of: datetime,
    days: int = SNAPSHOT_RETENTION_DAYS,
    keep: int = SNAPSHOTS_TO_RETAIN,
) -> DataFrame:
    """Every snapshot with a flag ``expired``, by the rule of ``expired_snapshots``."""
    newest = _newest(snapshots, table, snapshot, committed_at, keep)
    kept = newest.select(table, snapshot, F.lit(True).alias("_kept"))
    old = F.col(committed_at) < cut_of(as_of, days)
    return (
        snapshots.join(kept, [table, snapshot], "left")
        .withColumn("expired", old & F.col("_kept").isNull())
        .select(*snapshots.columns, "expired")
    )


def unreachable_files(references: DataFrame, *, file: Sequence[str], expired: Column) -> DataFrame:
    """Files that only expired snapshots refer to, from ``(snapshot, file)`` references.

    One aggregate with partial results, instead of a join of two big sets of references.
    """
    return (
        references.groupBy(*file)
        .agg(F.bool_and(expired).alias("_unreachable"))
        .where("_unreachable")
        .drop("_unreachable")
    )


def orphan_files(
    listing: DataFrame,
    referenced: DataFrame,
    *,
    path: str,
    modified: str,
    as_of: datetime,
    days: int = ORPHAN_RETENTION_DAYS,
) -> DataFrame:
    """Listed files that nothing refers to, once they are older than ``days``.

    The age limit spares files of a write that is still going on.
    """
    # Each path once before the join: a path may be referred to by very many snapshots.
    known = referenced.select(path).distinct()
    old = listing.where(F.col(modified) < cut_of(as_of, days))
    return old.join(known, path, "left_anti").select(*listing.columns)
