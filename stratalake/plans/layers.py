"""The chain raw → refined → curated for an event source, one write per layer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from stratalake import ledger
from stratalake.catalog import Column
from stratalake.functions import MONEY, clean_text, day_string
from stratalake.layers import Lake
from stratalake.operators import (
    DataQualityError,
    QualityChecker,
    accepted,
    clean,
    daily_summary,
    extract_payload,
    rejected,
    with_failures,
)
from stratalake.operators.typed import FAILED
from stratalake.sinks import land_delivery, merge_lake, write_lake
from stratalake.sources import (
    bookmark_of,
    lake_exists,
    read_changed,
    read_lake,
    read_new,
)

# Columns of the raw event table and of the curated summary.
RAW_EVENTS = [
    Column("event_id", "string", "Unique event identifier"),
    Column("payload", "string", "JSON payload"),
    Column("created_at", "timestamp_ntz", "Event timestamp"),
]
RAW_PARTITIONS = [Column("dt", "string")]
DELIVERY = Column("delivery", "string", "What brought the rows")
SUMMARY_TYPES = {"date": "date", "total_amount": "decimal(18,2)", "total_count": "bigint"}

PAYLOAD_FIELDS = "user_id string, event_type string, value string, props string"
MALFORMED = "_malformed"
REFINED_TYPES = {"event_id": "bigint", "user_id": "bigint", "value": MONEY}


@dataclass(frozen=True)
class EventTables:
    raw: str
    deliveries: str
    refined: str
    rejects: str
    curated: str


def tables_of(lake: Lake) -> EventTables:
    return EventTables(
        raw=lake.table("raw", "raw_events"),
        deliveries=lake.table("raw", "raw_deliveries"),
        refined=lake.table("refined", "events"),
        rejects=lake.table("refined", "events_rejects"),
        curated=lake.table("curated", "daily_summary"),
    )


def as_raw(events: DataFrame) -> DataFrame:
    """Events as a source would deliver them: everything but id and time inside JSON text."""
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.to_json(F.struct("user_id", "event_type", "value", "props")).alias("payload"),
        F.col("ts").alias("created_at"),
        day_string("ts").alias("dt"),
    )


def land(spark: SparkSession, rows: DataFrame, lake: Lake, delivery: str = "all") -> DataFrame:
    """Raw layer: rows as they are, by day and delivery, registered under their declared schema.

    A delivery that is landed again takes the place of its rows once all the new ones stand, and
    leaves those of others alone.
    """
    return land_delivery(
        rows,
        tables_of(lake).raw,
        RAW_EVENTS,
        location=lake.location("raw", "raw_events"),
        partition_by=RAW_PARTITIONS,
        delivery=DELIVERY,
        value=delivery,
        comment="Raw events, as delivered",
    )


def refined_checks(df: DataFrame) -> QualityChecker:
    # One scan of two columns. Events are unique by the way they are picked; checking that as
    # well would shuffle the ids of the whole table.
    return (
        QualityChecker(df)
        .not_null("event_id")
        .not_null("event_type")
        .row_count_min(1)
        .schema_match(REFINED_TYPES)
    )


def merged_checks(df: DataFrame) -> QualityChecker:
    """Checks of an upsert, which may have nothing to write."""
    return QualityChecker(df).not_null("event_id").not_null("event_type").schema_match(REFINED_TYPES)


def check_raw(raw: DataFrame) -> DataFrame:
    """Raw rows with their parsed payload and the names of the columns that are wrong."""
    parsed = extract_payload(raw, "payload", PAYLOAD_FIELDS, malformed=MALFORMED, drop=False)
    invalid = {
        "payload": F.col(MALFORMED).isNotNull(),
        "event_id": F.col("event_id").isNull(),
        "event_type": clean_text("event_type").isNull(),
    }
    return with_failures(parsed, REFINED_TYPES, invalid)


# What makes one version of an event newer than another; later columns decide between equal times.
NEWER_BY = ["created_at", "value", "user_id", "event_type", "props", "dt"]


def newest_events(checked: DataFrame) -> DataFrame:
    """Accepted rows, typed and tidy, in the newest version of each event."""
    return clean(
        accepted(checked, REFINED_TYPES).drop("payload", MALFORMED, DELIVERY.name),
        keys=["event_id"],
        newest_first=[F.desc(name) for name in NEWER_BY],
        text_columns=["event_type"],
    )


def refine(raw: DataFrame, lake: Lake) -> None:
    """Refined layer: payload parsed, values typed, newest version of each event.

    Both tables are written anew from the whole raw table, so a rerun changes nothing. The number
    of rejects is counted while the accepted rows are written, so the raw table is read a second
    time only when there is something to put into the reject table.
    """
    tables = tables_of(lake)
    seen = Observation("refine")
    checked = check_raw(raw)
    watched = checked.observe(seen, F.count_if(F.col(FAILED) != "").alias("rejects"))
    rows = newest_events(watched)

    def keep_rejects() -> None:
        wrong = rejected(checked).select(*raw.columns, "failed_columns")
        write_lake(wrong, tables.rejects, "overwrite", partition_by=["dt"])

    try:
        write_lake(rows, tables.refined, "overwrite", partition_by=["dt"], audit=refined_checks)
    except DataQualityError:
        keep_rejects()  # they say why the gate closed
        raise
    if seen.get["rejects"] or lake_exists(raw.sparkSession, tables.rejects):
        keep_rejects()


def summary_checks(df: DataFrame) -> QualityChecker:
    return (
        QualityChecker(df)
        .unique("date")
        .min_value("total_count", 1)
        .schema_match(SUMMARY_TYPES, allow_extra_columns=False)
    )


def curate(refined: DataFrame, lake: Lake) -> None:
    """Curated layer: one row per day."""
    summary = daily_summary(refined, "created_at", "value")
    write_lake(summary, tables_of(lake).curated, "overwrite", audit=summary_checks)


def raw_to_curated(spark: SparkSession, rows: DataFrame, lake: Lake) -> DataFrame:
    """Run all three layers over raw event rows; returns the curated table. A rerun with the same
    rows changes nothing."""
    tables = tables_of(lake)
    lake.create_databases(spark)
    refine(land(spark, rows, lake), lake)
    curate(read_lake(spark, tables.refined), lake)
    return read_lake(spark, tables.curated)


def refine_new(spark: SparkSession, lake: Lake) -> None:
    """Take what was delivered since the last run into the refined table and the reject table.

    Rejects are counted while the accepted rows are written. The deliveries are read again only for
    rejects: if there are any, or if the last run died between the two tables.
    """
    tables = tables_of(lake)
    # Read as a whole again, deliveries are an upsert that finds most of its rows in place.
    delivered = read_new(spark, tables.deliveries, tables.refined, on_expired="whole")
    unsorted = read_new(spark, tables.deliveries, tables.rejects, on_expired="whole")

    def keep_rejects(some: bool = True) -> None:
        wrong = rejected(check_raw(unsorted.rows)).select(*unsorted.rows.columns, "failed_columns")
        write_lake(
            wrong if some else wrong.limit(0),
            tables.rejects,
            unsorted.mode,
            partition_by=["dt"],
            bookmark=unsorted.bookmark,
        )

    def done(target: str) -> int:
        return bookmark_of(spark, target, unsorted.bookmark.source)

    same = bool(delivered and unsorted) and done(tables.refined) == done(tables.rejects)
    if unsorted and not same:
        keep_rejects()
    if delivered is None:
        return
    seen = Observation("refine-new")
    checked = check_raw(delivered.rows).observe(seen, F.count_if(F.col(FAILED) != "").alias("rejects"))
    rows = newest_events(checked)
    try:
        if lake_exists(spark, tables.refined):
            merge_lake(
                rows,
                tables.refined,
                ["event_id"],
                newer_by=NEWER_BY,
                unique_by=["event_id"],
                audit=merged_checks,
                bookmark=delivered.bookmark,
            )
        else:
            write_lake(
                rows,
                tables.refined,
                partition_by=["dt"],
                range_by="event_id",
                unique_by=["event_id"],
                audit=refined_checks,
                bookmark=delivered.bookmark,
            )
    except DataQualityError:
        if same:
            keep_rejects()  # they say why the gate closed
        raise
    if same:
        keep_rejects(some=bool(seen.get["rejects"]))


def curate_changed(spark: SparkSession, lake: Lake) -> None:
    """Summarise the days again whose partition of the refined table has changed."""
    tables = tables_of(lake)
    changed = read_changed(spark, tables.refined, tables.curated)
    if changed:
        summary = daily_summary(changed.rows, "created_at", "value")
        write_lake(
            summary,
            tables.curated,
            changed.mode,
            partition_by=["date"],
            audit=summary_checks,
            bookmark=changed.bookmark,
        )


def load_delivery(
    spark: SparkSession, rows: DataFrame, lake: Lake, delivery: str | None = None
) -> DataFrame:
    """One delivery of raw rows through all layers, reading only what it touches.

    Gives the same tables as ``raw_to_curated`` over all deliveries. ``dt`` has to be the day of
    ``created_at``, since days are summarised by partition. A ``delivery`` that has a name is taken
    in once: landing it and noting its name are one step, so a retry goes on from there.
    """
    tables = tables_of(lake)
    lake.create_databases(spark)
    name = f"delivery:{delivery}"
    if delivery is None or not bookmark_of(spark, tables.deliveries, name):
        mark = ledger.Bookmark(name, 1) if delivery is not None else None
        write_lake(rows, tables.deliveries, partition_by=["dt"], bookmark=mark)
    refine_new(spark, lake)
    curate_changed(spark, lake)
    return read_lake(spark, tables.curated)
