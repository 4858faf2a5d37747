"""Snapshots of a lake table kept as Parquet folders.

Every commit writes one new folder ``data/_commit=<id>`` and, last, one line of JSON under
``ledger/`` that names the folders the table now consists of. Data is never changed in place, so
readers keep a whole snapshot and a writer that dies leaves only an unreferenced folder behind.
One writer at a time. Where the Iceberg connector is configured it is used instead (``iceberg``).
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from stratalake import files
from stratalake.catalog import values_of

COMMIT = "_commit"
RANGE = "_range"
STORED = "stratalake.stored"  # in the metadata of a renamed column, its name in files
LEDGER_SCHEMA = (
    "snapshot_id bigint, committed_at timestamp_ntz, operation string, "
    "dirs array<string>, partition_by array<string>"
)
_COMMIT_DIR = re.compile(rf"{COMMIT}=(\d+)-")


@dataclass(frozen=True)
class Ranges:
    """The least and the largest value of a column, as texts, in folders for which they are known;
    two nulls where a folder has none. With ``layout`` every commit has a folder for each of its
    ranges of the column."""

    column: str
    layout: bool
    folders: dict[str, tuple[str | None, str | None]]


@dataclass(frozen=True)
class Snapshot:
    snapshot_id: int
    committed_at: datetime
    operation: str
    dirs: tuple[str, ...]
    partition_by: tuple[str, ...]
    schema: StructType
    bookmarks: dict[str, int]
    sort_by: tuple[str, ...] = ()
    ranges: Ranges | None = None
    retired: tuple[str, ...] = ()  # names in files of columns that are gone


@dataclass(frozen=True)
class Bookmark:
    """How far a job has read a source table."""

    source: str
    snapshot_id: int


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def new_commit_dir(started: datetime | None = None) -> str:
    """Folder name of a commit: the time its write began, in milliseconds, and something unique.

    This is the clock's time whatever time the snapshot is given, since orphan removal goes by it.
    """
    millis = int((started or utc_now()).replace(tzinfo=timezone.utc).timestamp() * 1000)
    return f"{COMMIT}={millis}-{uuid.uuid4().hex[:12]}"


def commit_time(directory: str) -> datetime | None:
    found = _COMMIT_DIR.match(directory)
    if found is None:
        return None
    return datetime.fromtimestamp(int(found[1]) / 1000, timezone.utc).replace(tzinfo=None)


def commit_time_of(directory: Column) -> Column:
    """``commit_time`` of a column of folders; null where a folder is not of a commit."""
    millis = F.nullif(F.regexp_extract(directory, f"^{_COMMIT_DIR.pattern}", 1), F.lit("")).cast("bigint")
    seconds = (millis / F.lit(1000)).cast("decimal(18,6)")
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def _entry_path(location: str, snapshot_id: int) -> str:
    return f"{location}/ledger/{snapshot_id:012d}.json"


def snapshot_ids(spark: SparkSession, location: str) -> list[int]:
    names = files.children(spark, f"{location}/ledger", directories=False)
    return [int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()]


def load(spark: SparkSession, location: str, snapshot_id: int) -> Snapshot:
    entry = json.loads(files.read_text(spark, _entry_path(location, snapshot_id)))
    return Snapshot(
        snapshot_id=entry["snapshot_id"],
        committed_at=datetime.fromisoformat(entry["committed_at"]),
        operation=entry["operation"],
        dirs=tuple(entry["dirs"]),
        partition_by=tuple(entry["partition_by"]),
        schema=StructType.fromJson(entry["schema"]),
        bookmarks=entry["bookmarks"],
        sort_by=tuple(entry.get("sort_by", ())),
        ranges=_ranges_from(entry.get("ranges")),
        retired=tuple(entry.get("retired", ())),
    )


def _ranges_from(entry: dict | None) -> Ranges | None:
    if entry is None:
        return None
    folders = {name: (low, high) for name, (low, high) in entry["folders"].items()}
    return Ranges(entry["column"], entry["layout"], folders)


def latest(spark: SparkSession, location: str) -> Snapshot | None:
    ids = snapshot_ids(spark, location)
    return load(spark, location, ids[-1]) if ids else None


def publish(
    spark: SparkSession,
    location: str,
    previous: Snapshot | None,
    *,
    operation: str,
    dirs: list[str],
    schema: StructType,
    partition_by: list[str],
    at: datetime,
    bookmark: Bookmark | None = None,
    sort_by: Sequence[str] | None = None,
    ranges: Ranges | None = None,
    keep_ranges: bool = True,
    retired: Sequence[str] | None = None,
) -> int:
    """Make a commit the newest snapshot; ``bookmark`` becomes valid together with it.

    The table keeps its sort order and ``retired`` unless it is given others. ``ranges`` are added to
    those known of folders that stay in the table, or with ``keep_ranges=False`` replace them.
    """
    if sort_by is None:
        sort_by = previous.sort_by if previous else ()
    if retired is None:
        retired = previous.retired if previous else ()
    known = previous.ranges if previous and keep_ranges else None
    if ranges is None:
        ranges = known
    elif known and known.column == ranges.column:
        ranges = Ranges(ranges.column, ranges.layout, known.folders | ranges.folders)
    bookmarks = dict(previous.bookmarks) if previous else {}
    if bookmark is not None:
        bookmarks[bookmark.source] = bookmark.snapshot_id
    snapshot_id = previous.snapshot_id + 1 if previous else 1
    entry = {
        "snapshot_id": snapshot_id,
        "committed_at": at.isoformat(),
        "operation": operation,
        "dirs": sorted(dirs),
        "partition_by": list(partition_by),
        "schema": schema.jsonValue(),
        "bookmarks": bookmarks,
        "sort_by": list(sort_by),
        "ranges": ranges
        and {
            "column": ranges.column,
            "layout": ranges.layout,
            "folders": {name: ranges.folders[name] for name in sorted(dirs) if name in ranges.folders},
        },
        "retired": list(retired),
        "writer": uuid.uuid4().hex,
    }
    files.write_text_once(spark, _entry_path(location, snapshot_id), json.dumps(entry))
    return snapshot_id


def forget(spark: SparkSession, location: str, snapshot_id: int) -> None:
    files.delete(spark, _entry_path(location, snapshot_id))


def no_rows(schema: StructType, at: datetime) -> Snapshot:
    """What comes before the first snapshot of a table."""
    return Snapshot(0, at, "create", (), (), schema, {})


def snapshots(spark: SparkSession, location: str) -> DataFrame:
    """One row per snapshot, with the folders it consists of."""
    paths = [_entry_path(location, i) for i in snapshot_ids(spark, location)]
    if not paths:
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).json(paths)


def stored_name(field: StructField) -> str:
    """What a column is called in files; a renamed one keeps its name there."""
    return field.metadata.get(STORED, field.name)


def rows_in(
    spark: SparkSession, location: str, dirs: list[str] | tuple[str, ...], schema: StructType
) -> DataFrame:
    """Rows of some folders of a table under its declared schema."""
    if not dirs:
        return spark.createDataFrame([], plain(schema))
    base = f"{location}/data"
    stored = StructType([StructField(stored_name(f), f.dataType, f.nullable) for f in schema])
    frame = (
        spark.read.schema(stored)
        .option("basePath", base)
        .parquet(*[f"{base}/{name}" for name in dirs])
    )
    return frame.select(*[F.col(f"`{s.name}`").alias(f.name) for f, s in zip(schema, stored)])


def plain(schema: StructType) -> StructType:
    """A schema without what this module notes in it."""
    notes = lambda f: {k: v for k, v in f.metadata.items() if k != STORED}
    return StructType([StructField(f.name, f.dataType, f.nullable, notes(f)) for f in schema])


def dir_of(path: Column) -> Column:
    """Folder, relative to ``data/``, of a file given by path (not URL-encoded)."""
    return F.regexp_extract(path, rf"({COMMIT}=[^/]+(?:/[^/=]+=[^/]*)*)/[^/]+$", 1)


def decoded(path: Column) -> Column:
    """``_metadata.file_path`` is URL-encoded; listings are not."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def partition_of(directory: str) -> str:
    """Partition part of a folder name; empty for an unpartitioned table, whose folders for ranges
    are no partitions."""
    below = directory.partition("/")[2]
    return "" if below.startswith(f"{RANGE}=") else below


def partition_values(directory: str) -> dict[str, str | None]:
    """Partition columns, or the range, and their values, as text, of a folder."""
    return values_of(directory.partition("/")[2])
