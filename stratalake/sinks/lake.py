"""Writes to lake tables: append, overwrite, overwrite of partitions, upsert.

All of them write a new folder first, let an optional audit look at it, and publish it last.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import replace
from datetime import datetime
from itertools import count

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, DecimalType, StructField, StructType

from stratalake import files, iceberg, ledger
from stratalake.catalog import Column, lake_table_ddl, quoted
from stratalake.layers import resolve
from stratalake.operators.clean import drop_missing_keys
from stratalake.operators.quality import CheckResult, DataQualityError, QualityChecker
from stratalake.session import scratch_path
from stratalake.sinks.layout import arrange, arrange_ranges
from stratalake.sinks.ranges import folder_ranges, folders_around
from stratalake.sinks.raw import check_mode
from stratalake.sinks.registered import register_lake

Audit = Callable[[DataFrame], QualityChecker]


class DuplicateKeyError(ValueError):
    """The source of an upsert holds a key more than once."""


def conform_to(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``schema`` by name; missing ones become null, others are an error."""
    # Type texts leave out whether nested values may be null, which files do not keep either.
    given = dict(df.dtypes)
    extra = [name for name in given if name not in schema.names]
    if extra:
        raise ValueError(f"columns not in the table: {extra}")
    for field in schema:
        declared = field.dataType.simpleString()
        if given.get(field.name, declared) != declared:
            raise ValueError(
                f"column {field.name} is {given[field.name]}, the table has {declared}"
            )
    return df.select(
        *[
            F.col(f"`{f.name}`") if f.name in given else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def create_lake_table(
    spark: SparkSession,
    table: str,
    columns: Sequence[Column],
    *,
    partition_by: Sequence[str] = (),
    properties: Mapping[str, str] | None = None,
    committed_at: datetime | None = None,
) -> bool:
    """Create an empty lake table unless it exists; says whether it was created."""
    if iceberg.catalog_of(spark, table):
        existed = spark.catalog.tableExists(table)
        keys = [c for c in columns if c[0] in partition_by]
        others = [c for c in columns if c[0] not in partition_by]
        spark.sql(lake_table_ddl(table, others, partition_by=keys, properties=properties))
        return not existed
    location = resolve(spark, table)
    if ledger.latest(spark, location) is not None:
        return False
    ledger.publish(
        spark,
        location,
        None,
        operation="create",
        dirs=[],
        schema=StructType.fromDDL(", ".join(f"{quoted(c[0])} {c[1]}" for c in columns)),
        partition_by=list(partition_by),
        at=committed_at or ledger.utc_now(),
    )
    register_lake(spark, table)
    return True


def write_commit(
    df: DataFrame,
    location: str,
    *,
    partition_by: Sequence[str],
    schema: StructType | None = None,
    sort_by: Sequence[str] = (),
    range_by: str | None = None,
    ranges: int | None = None,
    audit: Audit | None = None,
    spread: bool = True,
) -> list[str]:
    """Write one commit folder, audit what was written, and return its leaf folders.

    ``schema`` is the table's, whose columns may have other names in files. ``spread=False`` leaves
    the rows in the tasks they are in. With ``range_by`` each range of that column gets a folder.
    """
    spark = df.sparkSession
    schema = schema or df.schema
    commit = ledger.new_commit_dir()
    keys = list(partition_by)
    if range_by:
        order = [range_by, *(c for c in sort_by if c != range_by)]
        rows, keys = arrange_ranges(df, order, ledger.RANGE, ranges), [ledger.RANGE]
    else:
        rows = arrange(df, keys, sort_by) if spread else df
    stored = {field.name: ledger.stored_name(field) for field in schema}
    rows = rows.select(*[F.col(f"`{name}`").alias(stored.get(name, name)) for name in rows.columns])
    writer = rows.write.partitionBy(*keys) if keys else rows.write
    writer.parquet(f"{location}/data/{commit}")
    if keys:
        found = files.partition_dirs(spark, f"{location}/data/{commit}", len(keys))
        dirs = [f"{commit}/{name}" for name in found]
    else:
        dirs = [commit]
    if audit is not None:
        audit(ledger.rows_in(spark, location, dirs, schema)).assert_all_passed()
    return dirs


def _range_layout(
    previous: ledger.Snapshot | None, keys: Sequence[str], range_by: str | None, mode: str
) -> tuple[str | None, bool]:
    """The column whose ranges the table keeps, and whether commits have folders for them."""
    if previous is None or mode == "overwrite":
        return range_by, bool(range_by) and not keys
    kept = previous.ranges
    if range_by and (kept is None or kept.column != range_by):
        raise ValueError(f"the table keeps ranges of {kept.column if kept else 'no column'}, not {range_by}")
    return (kept.column, kept.layout) if kept else (None, False)


def _no_repeats(
    spark: SparkSession,
    location: str,
    added: list[str],
    others: ledger.Snapshot,
    schema: StructType,
    keys: Sequence[str],
) -> None:
    """Refuse a commit with a key that it holds twice, or that the rest of the table holds as well.

    The rest is read where a folder's range has room for one of the keys, and of that the keys only.
    """
    keys = list(keys)
    written = drop_missing_keys(ledger.rows_in(spark, location, added, schema).select(*keys), keys)
    QualityChecker(written).unique(*keys).assert_all_passed()
    matches = _holding(spark, location, others, written, keys)
    repeated = matches.count() if matches is not None else 0
    if repeated:
        name = f"unique({','.join(keys)})"
        detail = f"{repeated} rows of the table have a key of these rows"
        raise DataQualityError([CheckResult(name, False, repeated, detail)])


def _partitioning(
    previous: ledger.Snapshot | None, partition_by: Sequence[str] | None, mode: str
) -> list[str]:
    if previous is None:
        return list(partition_by or ())
    if partition_by is None:
        return list(previous.partition_by)
    if mode != "overwrite" and tuple(partition_by) != previous.partition_by:
        raise ValueError(
            f"the table is partitioned by {list(previous.partition_by)}, not {list(partition_by)}"
        )
    return list(partition_by)


def write_lake(
    df: DataFrame,
    table: str,
    mode: str = "append",
    *,
    partition_by: Sequence[str] | None = None,
    sort_by: Sequence[str] = (),
    range_by: str | None = None,
    ranges: int | None = None,
    unique_by: Sequence[str] = (),
    audit: Audit | None = None,
    bookmark: ledger.Bookmark | None = None,
    committed_at: datetime | None = None,
) -> int | None:
    """Write to a lake table, creating it on the first write; returns the snapshot number.

    ``append`` adds rows, ``overwrite`` replaces the table, its schema and, if given, its
    partitioning, ``overwrite_partitions`` replaces the partitions that occur in ``df``. The rows
    really are sorted by ``sort_by``, and the table keeps that order: later writes without one,
    upserts and compactions sort by it too. An overwrite without ``sort_by`` ends it.

    ``range_by`` is a column by which rows will be looked for, such as the first key of upserts. The
    table keeps its range in every folder, and a table without partitions gets a folder for each
    range of a commit, ``ranges`` of them or as many as their size asks for, sorted by it. This too
    holds for later writes, until an overwrite without it.

    ``unique_by`` are columns whose values no two rows of the table may share. Rows that repeat
    each other's, or those of rows already there, close the gate as a failed audit does.
    ``bookmark`` notes, in the same step, how far an incremental read has come. A table given by
    name is registered in the session catalog as well (``register_lake``).
    """
    check_mode(mode)
    spark = df.sparkSession
    if iceberg.catalog_of(spark, table):
        _refuse_bookmark(bookmark)
        if range_by or unique_by:
            iceberg.refuse(spark, table, "range_by or unique_by")
        if audit is None:
            rows = df
        else:  # what is looked at has to be what is written
            path = scratch_path(spark, "audited")
            df.write.parquet(path)
            rows = spark.read.schema(df.schema).parquet(path)
            audit(rows).assert_all_passed()
        iceberg.write(arrange(rows, partition_by or (), sort_by), table, mode, partition_by or ())
        return None
    location = resolve(spark, table)
    previous = ledger.latest(spark, location)
    keys = _partitioning(previous, partition_by, mode)
    if mode == "overwrite_partitions" and not keys:
        raise ValueError("overwrite_partitions needs a partitioned table")
    if previous is None or mode == "overwrite":
        rows, schema = df, ledger.plain(df.schema)
    else:
        rows, schema = conform_to(df, previous.schema), previous.schema
    if not sort_by and previous is not None and mode != "overwrite":
        sort_by = previous.sort_by
    column, layout = _range_layout(previous, keys, range_by, mode)
    if column and column not in schema.names:
        raise ValueError(f"no such column: {column}")
    added = write_commit(
        rows,
        location,
        partition_by=keys,
        schema=schema,
        sort_by=sort_by,
        range_by=column if layout else None,
        ranges=ranges,
        audit=audit,
    )
    kept = list(previous.dirs) if previous and mode != "overwrite" else []
    if mode == "overwrite_partitions":
        replaced = {ledger.partition_of(name) for name in added}
        kept = [name for name in kept if ledger.partition_of(name) not in replaced]
    at = committed_at or ledger.utc_now()
    if unique_by:
        rest = replace(previous or ledger.no_rows(schema, at), dirs=tuple(kept))
        _no_repeats(spark, location, added, rest, schema, unique_by)
    fresh = previous is None or mode == "overwrite"
    published = ledger.publish(
        spark,
        location,
        previous,
        operation=mode,
        dirs=kept + added,
        schema=schema,
        partition_by=keys,
        at=at,
        bookmark=bookmark,
        sort_by=sort_by,
        ranges=_ranges_of(spark, location, added, schema, column, layout),
        keep_ranges=not fresh,
        retired=() if fresh else None,
    )
    register_lake(spark, table)
    return published


def _ranges_of(
    spark: SparkSession, location: str, added: list[str], schema: StructType, column: str | None, layout: bool
) -> ledger.Ranges | None:
    if column is None:
        return None
    return ledger.Ranges(column, layout, folder_ranges(spark, location, added, schema, column))


def _refuse_bookmark(bookmark: ledger.Bookmark | None) -> None:
    if bookmark is not None:
        raise ValueError("bookmarks are kept in the ledger, which Iceberg tables do not have")


def _check_keys_unique(source: DataFrame, keys: Sequence[str]) -> None:
    # Keys with a null match nothing, so they cannot clash.
    complete = drop_missing_keys(source.select(*keys), keys)
    repeated = complete.groupBy(*keys).count().where("count > 1").head(1)
    if repeated:
        raise DuplicateKeyError(f"merge source repeats a key: {repeated[0].asDict()}")


def _without_outdated(
    source: DataFrame, target: DataFrame, keys: list[str], newer_by: Sequence[str]
) -> DataFrame:
    """Source rows that are not older than a target row with their key; nulls are oldest."""
    offered = source.select(*keys, F.struct(*newer_by).alias("_offered"))
    both = target.select(*keys, F.struct(*newer_by).alias("_known")).join(offered, keys)
    outdated = both.where(F.col("_known") > F.col("_offered")).select(*keys).distinct()
    return source.join(outdated, keys, "left_anti").select(*source.columns)


def _holding(
    spark: SparkSession,
    location: str,
    snapshot: ledger.Snapshot,
    source: DataFrame,
    keys: list[str],
) -> DataFrame | None:
    """``(keys, _file)`` of the rows whose key occurs in ``source``; None if there can be none.

    Folders whose range has no room for any key of the source are not even listed. Of the others
    only the keys are read, and of those only row groups within the range of the source's first key.
    """
    if not snapshot.dirs:
        return None
    low, high = source.agg(F.min(keys[0]), F.max(keys[0])).first()
    if low is None:  # no source row has a key that could match
        return None
    around = folders_around(source, snapshot, keys[0])
    if not around:
        return None
    target = ledger.rows_in(spark, location, around, snapshot.schema)
    target = target.where(F.col(keys[0]).between(F.lit(low), F.lit(high)))
    located = target.select(*keys, F.col("_metadata.file_path").alias("_file"))
    return located.join(source.select(*keys), keys, "left_semi")


def _dirs_holding(
    spark: SparkSession,
    location: str,
    snapshot: ledger.Snapshot,
    source: DataFrame,
    keys: list[str],
) -> set[str]:
    """Folders with at least one row whose key occurs in ``source``."""
    matches = _holding(spark, location, snapshot, source, keys)
    if matches is None:
        return set()
    touched = matches.select("_file").distinct()
    # At most one row per folder reaches the driver.
    folders = touched.select(ledger.dir_of(ledger.decoded(F.col("_file"))).alias("_dir"))
    return {row["_dir"] for row in folders.distinct().collect()}


def merge_lake(
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    *,
    newer_by: str | Sequence[str] | None = None,
    unique_by: Sequence[str] = (),
    audit: Audit | None = None,
    bookmark: ledger.Bookmark | None = None,
    committed_at: datetime | None = None,
) -> int | None:
    """Upsert: a source row replaces the rows with its key, other source rows are added.

    Keys compare as in SQL, so a key with a null matches nothing and its row is added. A key that
    occurs twice in the source is an error. With ``newer_by``, a column or several in order of weight,
    a source row whose values are lower than those in the table is left out; null is lowest.

    Only folders that hold a matching key are written again; a table written with ``range_by`` has
    folders for ranges of it. Every upsert notes the range of its first key in the folders it
    writes, if the table keeps no other column's, and later ones pass over folders that have no
    room for their keys. ``unique_by``: as for ``write_lake``, of the rows in folders that are
    written again and in those whose ranges they share.

    The source is put down once in the shared folder, because it is used three
    times and all uses must see the same rows; that copy is deleted at the end. A table that does
    not exist is created.
    """
    spark = source.sparkSession
    keys = list(keys)
    newer_by = [newer_by] if isinstance(newer_by, str) else newer_by
    if iceberg.catalog_of(spark, table):
        _refuse_bookmark(bookmark)
        if audit is not None or unique_by:
            iceberg.refuse(spark, table, "an audit of an upsert")
        _check_keys_unique(source, keys)
        iceberg.merge(source, table, keys, newer_by)
        return None
    location = resolve(spark, table)
    at = committed_at or ledger.utc_now()
    previous = ledger.latest(spark, location) or ledger.no_rows(source.schema, at)
    rows = conform_to(source, previous.schema)
    staged_path = scratch_path(spark, "merge-source")
    try:
        rows.write.parquet(staged_path)
        staged = spark.read.schema(rows.schema).parquet(staged_path)
        _check_keys_unique(staged, keys)
        kept, added = _merged_dirs(staged, location, previous, keys, newer_by, audit)
    finally:
        files.delete(spark, staged_path)
    if unique_by:
        rest = replace(previous, dirs=tuple(kept))
        _no_repeats(spark, location, added, rest, previous.schema, unique_by)
    ranged = previous.ranges
    column, layout = (ranged.column, ranged.layout) if ranged else (keys[0], False)
    published = ledger.publish(
        spark,
        location,
        previous,
        operation="merge",
        dirs=kept + added,
        schema=previous.schema,
        partition_by=list(previous.partition_by),
        at=at,
        bookmark=bookmark,
        ranges=_ranges_of(spark, location, added, previous.schema, column, layout),
    )
    register_lake(spark, table)
    return published


def _merged_dirs(
    staged: DataFrame,
    location: str,
    previous: ledger.Snapshot,
    keys: list[str],
    newer_by: Sequence[str] | None,
    audit: Audit | None,
) -> tuple[list[str], list[str]]:
    """Folders that the upsert leaves as they are, and those that it writes."""
    spark = staged.sparkSession
    touched = _dirs_holding(spark, location, previous, staged, keys)
    rewritten = [name for name in previous.dirs if name in touched]
    again = ledger.rows_in(spark, location, rewritten, previous.schema)
    if newer_by is not None:
        staged = _without_outdated(staged, again, keys, newer_by)
    unmatched = again.join(staged.select(*keys), keys, "left_anti")
    survivors = unmatched.select(*staged.columns)
    added = write_commit(
        survivors.unionByName(staged),
        location,
        partition_by=previous.partition_by,
        schema=previous.schema,
        sort_by=previous.sort_by,
        range_by=previous.ranges.column if previous.ranges and previous.ranges.layout else None,
        audit=audit,
    )
    return [name for name in previous.dirs if name not in touched], added


# Types that hold every value of another, and under which Spark reads files of it.
WIDER = {
    "tinyint": ("smallint", "int", "bigint", "double"),
    "smallint": ("int", "bigint", "double"),
    "int": ("bigint", "double"),
    "float": ("double",),
    "date": ("timestamp_ntz",),
}


def _is_wider(old: DataType, new: DataType) -> bool:
    if isinstance(old, DecimalType) and isinstance(new, DecimalType):
        whole = new.precision - new.scale >= old.precision - old.scale
        return whole and new.scale >= old.scale and new != old
    return new.simpleString() in WIDER.get(old.simpleString(), ())


def alter_lake(
    spark: SparkSession,
    table: str,
    *,
    add: StructType | None = None,
    rename: Mapping[str, str] | None = None,
    drop: Sequence[str] = (),
    widen: Mapping[str, str] | None = None,
    committed_at: datetime | None = None,
) -> int:
    """Change the columns of a lake table in one step; no data is touched.

    ``drop``, ``rename`` (old name to new) and ``widen`` (name to a type that holds all values of
    the one before) speak of the columns as they are; ``add`` comes last. Rows written before read
    as null in added columns, also in those that have the name of a column that was dropped: files
    keep the names they were written with, and the ledger knows which column each belongs to.
    Snapshots from before read as they were. Partition columns stay as they are, since folders bear
    their names; an order or ranges by a dropped column end with it.
    """
    iceberg.refuse(spark, table, "alter_lake (use ALTER TABLE)")
    location = resolve(spark, table)
    previous = ledger.latest(spark, location)
    if previous is None:
        raise ValueError(f"no such table: {table}")
    rename, widen, fields = dict(rename or {}), dict(widen or {}), {f.name: f for f in previous.schema}
    named = [*rename, *drop, *widen]
    if missing := [name for name in named if name not in fields]:
        raise ValueError(f"columns not in the table: {missing}")
    if fixed := [name for name in named if name in previous.partition_by]:
        raise ValueError(f"partition columns cannot change: {fixed}")
    if both := sorted(set(drop) & {*rename, *widen}):
        raise ValueError(f"columns dropped and changed: {both}")
    kept = []
    for name, field in fields.items():
        if name in drop:
            continue
        kind = field.dataType
        if name in widen:
            kind = StructType.fromDDL(f"c {widen[name]}")[0].dataType
            if not _is_wider(field.dataType, kind):
                raise ValueError(f"{name} is {field.dataType.simpleString()}, {widen[name]} is no wider type")
        stored = ledger.stored_name(field)
        new = rename.get(name, name)
        notes = {k: v for k, v in field.metadata.items() if k != ledger.STORED}
        if new != stored:
            notes[ledger.STORED] = stored
        kept.append(StructField(new, kind, field.nullable, notes))
    retired = [*previous.retired, *(ledger.stored_name(fields[name]) for name in drop)]
    used = {ledger.stored_name(f) for f in kept} | set(retired)
    for field in ledger.plain(add or StructType()):
        stored = next(n for n in _names_like(field.name) if n not in used)
        used.add(stored)
        notes = dict(field.metadata) | ({ledger.STORED: stored} if stored != field.name else {})
        kept.append(StructField(field.name, field.dataType, field.nullable, notes))
    names = [f.name for f in kept]
    if clash := sorted({name for name in names if names.count(name) > 1}):
        raise ValueError(f"columns already in the table: {clash}")
    gone = next((i for i, name in enumerate(previous.sort_by) if name in drop), len(previous.sort_by))
    ranges = previous.ranges
    if ranges and ranges.column in {*drop, *rename, *widen}:
        if ranges.layout and ranges.column in drop:
            raise ValueError(f"the folders of the table are ranges of {ranges.column}")
        # Texts of another type are not compared.
        folders = ranges.folders if ranges.column not in widen else {}
        ranges = ledger.Ranges(rename.get(ranges.column, ranges.column), ranges.layout, folders)
        if ranges.column in drop:
            ranges = None
    published = ledger.publish(
        spark,
        location,
        previous,
        operation="alter",
        dirs=list(previous.dirs),
        schema=StructType(kept),
        partition_by=list(previous.partition_by),
        at=committed_at or ledger.utc_now(),
        sort_by=[rename.get(name, name) for name in previous.sort_by[:gone]],
        ranges=ranges,
        keep_ranges=False,
        retired=retired,
    )
    register_lake(spark, table)
    return published


def _names_like(name: str) -> Iterator[str]:
    yield name
    yield from (f"{name}__{n}" for n in count(2))


def evolve_lake(
    spark: SparkSession,
    table: str,
    new_columns: StructType,
    *,
    committed_at: datetime | None = None,
) -> int:
    """Add columns to a lake table; rows written before read as null. No data is touched."""
    return alter_lake(spark, table, add=new_columns, committed_at=committed_at)
