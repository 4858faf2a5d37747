"""Compaction, snapshot expiry and orphan removal on lake tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from stratalake import files, iceberg, ledger, task_files
from stratalake.layers import resolve
from stratalake.operators import maintenance
from stratalake.session import scratch_path
from stratalake.sinks.lake import write_commit
from stratalake.sinks.layout import file_size_conf, session_with
from stratalake.sinks.ranges import folder_ranges
from stratalake.sinks.registered import register_lake

TARGET_FILE_BYTES = 512 * 1024 * 1024

# Share of the target size that may be written again to be rid of one small file.
WORTH_OF_A_FILE = 0.25


def _current(spark: SparkSession, table: str) -> tuple[str, ledger.Snapshot]:
    location = files.qualify(spark, resolve(spark, table))
    snapshot = ledger.latest(spark, location)
    if snapshot is None:
        raise ValueError(f"no such table: {table}")
    return location, snapshot


def data_files(spark: SparkSession, table: str) -> DataFrame:
    """``(dir, partition, path, length, modified)`` of the files of the current snapshot."""
    location, snapshot = _current(spark, table)
    paths = [f"{location}/data/{name}" for name in snapshot.dirs]
    if not paths:
        return spark.createDataFrame(
            [], "dir string, partition string, path string, length bigint, modified timestamp_ntz"
        )
    listing = maintenance.list_files(spark, *paths)
    folder = ledger.dir_of(F.col("path"))
    return listing.select(
        folder.alias("dir"),
        # Ranges of one commit have nothing to do with those of another.
        F.regexp_replace(folder, rf"^[^/]*/?({ledger.RANGE}=.*)?", "").alias("partition"),
        "path",
        "length",
        "modified",
    )


def table_compaction_plan(
    spark: SparkSession, table: str, target_bytes: int = TARGET_FILE_BYTES
) -> DataFrame:
    """Compaction plan with one row per partition of a lake table."""
    iceberg.refuse(spark, table, "a compaction plan")
    return maintenance.compaction_plan(
        data_files(spark, table), ["partition"], "length", target_bytes
    )


def _files_to_compact(
    spark: SparkSession, table: str, target_bytes: int
) -> DataFrame:
    """``(dir, file, bin)``: the files to write again, and which of them together.

    A file is small if it has less than half the target size. The unit is a folder, so its large
    files are written again with the small ones: that is worth it if they have at most
    ``WORTH_OF_A_FILE`` of the target size for each small file. A partition is taken if its chosen
    folders hold more files than their bytes need; what is written then holds no more than those,
    so a table at rest is not written again. Bins share the bytes of a partition evenly, small files
    first.
    """
    files_ = data_files(spark, table)
    small = F.col("length") < target_bytes // 2
    folders = (
        files_.groupBy("partition", "dir")
        .agg(
            F.count("*").alias("n"),
            F.sum("length").alias("bytes"),
            F.count_if(small).alias("n_small"),
            F.sum(F.when(small, 0).otherwise(F.col("length"))).alias("large"),
        )
        .where(F.col("large") <= F.col("n_small") * F.lit(target_bytes * WORTH_OF_A_FILE))
    )
    partitions = (
        folders.groupBy("partition")
        .agg(F.sum("n").alias("n"), F.sum("bytes").alias("total"))
        .withColumn("planned", F.greatest(F.ceil(F.col("total") / target_bytes), F.lit(1)))
        .where("n > planned")
    )
    chosen = folders.select("partition", "dir").join(partitions, "partition")
    # One row of metadata per file; a task orders the files of one partition.
    before = Window.partitionBy("partition").orderBy("length", "path").rowsBetween(Window.unboundedPreceding, -1)
    middle = F.coalesce(F.sum("length").over(before), F.lit(0)) + F.col("length") / 2
    place = F.floor(middle * F.col("planned") / F.greatest("total", F.lit(1)))
    binned = files_.join(chosen, ["partition", "dir"]).select(
        "partition",
        "dir",
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file"),
        F.least(place, F.col("planned") - 1).alias("place"),
    )
    # One row of metadata per file to come.
    numbered = binned.select("partition", "place").distinct().select(
        "partition", "place", (F.row_number().over(Window.orderBy("partition", "place")) - 1).alias("bin")
    )
    return binned.join(numbered, ["partition", "place"]).select("dir", "file", "bin")


def compact_lake(
    spark: SparkSession,
    table: str,
    *,
    target_bytes: int = TARGET_FILE_BYTES,
    sort_by: Sequence[str] = (),
    committed_at: datetime | None = None,
) -> int | None:
    """Merge small files; the rows stay the same. Returns the new snapshot, None if all is well.

    One job for all partitions. The files to merge are planned into bins of the target size, and
    the rows of a bin go to one task; this shuffles the rows of the chosen folders once, and no
    others. The table's sort order, or ``sort_by``, is applied to the new files.
    """
    catalog = iceberg.catalog_of(spark, table)
    if catalog:
        iceberg.compact(spark, catalog, table, target_bytes, sort_by)
        return None
    location, snapshot = _current(spark, table)
    order = list(sort_by or snapshot.sort_by)
    plan_path = scratch_path(spark, "compaction")
    try:
        _files_to_compact(spark, table, target_bytes).write.parquet(plan_path)
        plan = spark.read.schema("dir string, file string, bin int").parquet(plan_path)
        again = {row["dir"] for row in plan.select("dir").distinct().collect()}
        if not again:
            return None
        bins = plan.agg(F.max("bin")).first()[0] + 1
        rows = ledger.rows_in(spark, location, sorted(again), snapshot.schema)
        ranged = snapshot.ranges
        if order or (ranged and ranged.layout):
            own = session_with(spark, file_size_conf(target_bytes))
            added = write_commit(
                ledger.rows_in(own, location, sorted(again), snapshot.schema),
                location,
                partition_by=snapshot.partition_by,
                schema=snapshot.schema,
                sort_by=order,
                range_by=ranged.column if ranged and ranged.layout else None,
            )
        else:
            path = ledger.decoded(F.col("_metadata.file_path"))
            located = rows.select(
                "*",
                ledger.dir_of(path).alias("_dir"),
                F.regexp_extract(path, r"([^/]+)$", 1).alias("_file"),
            )
            files_ = plan.toDF("_dir", "_file", "_bin")
            binned = located.join(files_, ["_dir", "_file"]).repartitionById(bins, "_bin")
            added = write_commit(
                binned.select(*[F.col(f"`{name}`") for name in rows.columns]),
                location,
                partition_by=snapshot.partition_by,
                schema=snapshot.schema,
                spread=False,
            )
    finally:
        files.delete(spark, plan_path)
    known = ranged and ledger.Ranges(
        ranged.column, ranged.layout, folder_ranges(spark, location, added, snapshot.schema, ranged.column)
    )
    published = ledger.publish(
        spark,
        location,
        snapshot,
        operation="compact",
        dirs=[name for name in snapshot.dirs if name not in again] + added,
        schema=snapshot.schema,
        partition_by=list(snapshot.partition_by),
        at=committed_at or ledger.utc_now(),
        sort_by=order,
        ranges=known,
    )
    register_lake(spark, table)
    return published


def _references(history: DataFrame) -> DataFrame:
    return history.select("snapshot_id", F.explode("dirs").alias("dir"))


def _referenced(spark: SparkSession, location: str) -> DataFrame:
    return _references(ledger.snapshots(spark, location)).select("dir").distinct()


def _put_down(rows: DataFrame, path: str) -> DataFrame:
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


# Folders to delete stand in a table of their own, ``deletions/<id>``, from before the first thing
# is lost until the last of them is gone.


def _delete_listed(spark: SparkSession, location: str, name: str) -> int:
    path = f"{location}/deletions/{name}"
    gone = 0
    if files.exists(spark, f"{path}/_SUCCESS"):
        listed = spark.read.schema("dir string").parquet(path)
        # A run that died before it had forgotten the snapshots has listed folders still in use.
        free = listed.join(_referenced(spark, location), "dir", "left_anti")
        gone = task_files.delete_folders(free, f"{location}/data")
    files.delete(spark, path)
    return gone


def _finish_deletions(spark: SparkSession, location: str) -> None:
    """Do what a run that died has left to do."""
    for name in files.children(spark, f"{location}/deletions", directories=True):
        _delete_listed(spark, location, name)


def expire_lake(
    spark: SparkSession,
    table: str,
    *,
    as_of: datetime,
    days: int = maintenance.SNAPSHOT_RETENTION_DAYS,
    keep: int = maintenance.SNAPSHOTS_TO_RETAIN,
    clean_expired_files: bool = True,
    dry_run: bool = True,
) -> tuple[list[int], DataFrame]:
    """Expire old snapshots and delete the folders only they refer to.

    Returns the snapshots, and the folders as ``(dir)``; nothing is changed unless
    ``dry_run=False``. The folders are listed in a table, then the snapshots are forgotten, so that
    a reader never finds one half deleted, then tasks delete what the table lists. A run that dies
    in between is finished by the next one, of this or of ``remove_orphans``.
    """
    catalog = iceberg.catalog_of(spark, table)
    nothing = spark.createDataFrame([], "dir string")
    if catalog:
        if dry_run or not clean_expired_files:
            iceberg.refuse(spark, table, "a dry run, or expiry without deleting files,")
        iceberg.expire(spark, catalog, table, as_of - timedelta(days=days), keep)
        return [], nothing
    location, current = _current(spark, table)
    if not dry_run:
        _finish_deletions(spark, location)
    history = ledger.snapshots(spark, location).withColumn("table", F.lit(location))
    expired = maintenance.expired_snapshots(
        history,
        table="table",
        snapshot="snapshot_id",
        committed_at="committed_at",
        as_of=as_of,
        days=days,
        keep=max(keep, 1),
    )
    gone = sorted(row["snapshot_id"] for row in expired.select("snapshot_id").collect())
    gone = [i for i in gone if i != current.snapshot_id]
    if not gone:
        return [], nothing
    dirs = nothing
    if clean_expired_files:
        unreachable = maintenance.unreachable_files(
            _references(history), file=["dir"], expired=F.col("snapshot_id").isin(gone)
        )
        dirs = _put_down(unreachable, scratch_path(spark, "unreachable"))
    if not dry_run:
        name = uuid.uuid4().hex
        dirs.write.parquet(f"{location}/deletions/{name}")
        for snapshot_id in gone:
            ledger.forget(spark, location, snapshot_id)
        _delete_listed(spark, location, name)
    return gone, dirs


def orphan_folders(
    spark: SparkSession, table: str, *, as_of: datetime, days: int = maintenance.ORPHAN_RETENTION_DAYS
) -> DataFrame:
    """``(dir)`` of the folders that no snapshot refers to, such as those of a write that died.

    The age of a folder is that of its write, which its name holds, since object stores keep no
    times for folders. Commits are listed as deep as the snapshots that know them do; one that no
    snapshot knows counts as a whole. Tasks list the folders, level by level; only the number of
    levels reaches the driver.
    """
    location, _ = _current(spark, table)
    base = f"{location}/data"
    references = _referenced(spark, location)
    parts = F.split("dir", "/")
    depths = (
        references.select(parts[0].alias("commit"), (F.size(parts) - 1).alias("depth"))
        .groupBy("commit")
        .agg(F.max("depth").alias("depth"))
    )
    commits = task_files.folders_below(task_files.roots(spark), base)
    old = ledger.commit_time_of(F.col("dir")) < maintenance.cut_of(as_of, days)
    commits = commits.where(old).join(depths, F.col("dir") == F.col("commit"), "left")
    level = _put_down(
        commits.select("dir", F.coalesce("depth", F.lit(0)).alias("depth")), scratch_path(spark, "commits")
    )
    folders = level.where("depth = 0").select("dir")
    for depth in range(1, (level.agg(F.max("depth")).first()[0] or 0) + 1):
        # Those of this depth are listed to the end.
        found = level.where(F.col("depth") == depth).select("dir")
        for _ in range(depth):
            below = task_files.folders_below(found, base).where("regexp_extract(dir, '[^/]+$', 0) like '%=%'")
            found = _put_down(below, scratch_path(spark, "folders"))
        folders = folders.unionByName(found)
    listing = folders.withColumn("modified", ledger.commit_time_of(F.col("dir")))
    orphans = maintenance.orphan_files(
        listing, references, path="dir", modified="modified", as_of=as_of, days=days
    )
    return _put_down(orphans.select("dir"), scratch_path(spark, "orphans"))


def remove_orphans(
    spark: SparkSession,
    table: str,
    *,
    as_of: datetime,
    days: int = maintenance.ORPHAN_RETENTION_DAYS,
    dry_run: bool = True,
) -> DataFrame:
    """Delete the folders that ``orphan_folders`` finds, and return them as ``(dir)``. Tasks delete
    them; nothing is deleted unless ``dry_run=False``."""
    catalog = iceberg.catalog_of(spark, table)
    if catalog:
        cut = as_of - timedelta(days=days)
        return iceberg.remove_orphans(spark, catalog, table, cut, dry_run).toDF("dir")
    location, _ = _current(spark, table)
    if not dry_run:
        _finish_deletions(spark, location)
    orphans = orphan_folders(spark, table, as_of=as_of, days=days)
    if not dry_run:
        name = uuid.uuid4().hex
        orphans.write.parquet(f"{location}/deletions/{name}")
        _delete_listed(spark, location, name)
    return orphans
