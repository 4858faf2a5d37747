"""Reads of lake tables and of standard tables."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from stratalake import catalog, iceberg, ledger
from stratalake.layers import resolve


def read_lake(
    spark: SparkSession,
    table: str,
    *,
    snapshot_id: int | None = None,
    partitions: Mapping[str, Collection[str | None]] | None = None,
) -> DataFrame:
    """Rows of a lake table, by ``catalog.database.table`` or by path, newest snapshot by default.

    A filter on a partition column prunes folders after Spark has listed them all. In a table of
    very many partitions ``partitions``, the wanted values as text per column, saves the listing.
    """
    if iceberg.catalog_of(spark, table):
        if partitions:
            raise ValueError("Iceberg tables prune partitions by themselves")
        if snapshot_id is None:
            return spark.table(table)
        return spark.read.option("snapshot-id", snapshot_id).table(table)
    location = resolve(spark, table)
    if snapshot_id is None:
        snapshot = ledger.latest(spark, location)
    elif snapshot_id in ledger.snapshot_ids(spark, location):
        snapshot = ledger.load(spark, location, snapshot_id)
    else:
        snapshot = None
    if snapshot is None:
        raise ValueError(f"no such table or snapshot: {table} {snapshot_id or ''}".rstrip())
    dirs = snapshot.dirs
    for column, wanted in (partitions or {}).items():
        if column not in snapshot.partition_by:
            raise ValueError(f"{table} is not partitioned by {column}")
        dirs = [name for name in dirs if ledger.partition_values(name)[column] in wanted]
    return ledger.rows_in(spark, location, dirs, snapshot.schema)


def lake_exists(spark: SparkSession, table: str) -> bool:
    if iceberg.catalog_of(spark, table):
        return spark.catalog.tableExists(table)
    return bool(ledger.snapshot_ids(spark, resolve(spark, table)))


def read_raw(
    spark: SparkSession,
    source: str,
    *,
    schema: StructType | str | None = None,
    fmt: str = "parquet",
    **options: str,
) -> DataFrame:
    """Rows of a registered table, or of files read under a declared schema.

    Partition values keep the declared type: without a schema ``dt=2024-01-03`` would turn into a
    date. Columns come back in the order of the schema.
    """
    if "/" not in source:
        return spark.table(source)
    if schema is None:
        raise ValueError("files are read under a declared schema")
    frame = spark.read.format(fmt).options(**options).schema(schema).load(source)
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    return frame.select(*[F.col(f"`{name}`") for name in schema.names])


def register_raw(
    spark: SparkSession,
    name: str,
    columns: Sequence[catalog.Column],
    *,
    location: str,
    partition_by: Sequence[catalog.Column] = (),
    fmt: str = "parquet",
    comment: str = "",
) -> DataFrame:
    """Register files as an external table with its partitions, and return the table."""
    catalog.create_external_table(
        spark,
        name,
        columns,
        location=location,
        using=fmt,
        partition_by=partition_by,
        comment=comment,
    )
    return spark.table(name)
