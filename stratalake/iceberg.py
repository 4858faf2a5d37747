"""Thin dispatch to the Iceberg connector where a catalog of that kind is configured.

The connector is not available where this library is tested, so these calls are untested.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from stratalake.catalog import literal, quoted


def catalog_conf(
    name: str, warehouse: str, implementation: str | None = None
) -> dict[str, str]:
    """Session settings that map the catalog ``name`` to the connector, for ``get_spark``."""
    settings = {
        "spark.sql.extensions": (
            "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions"
        ),
        f"spark.sql.catalog.{name}": "org.apache.iceberg.spark.SparkCatalog",
        f"spark.sql.catalog.{name}.warehouse": warehouse,
    }
    if implementation:
        settings[f"spark.sql.catalog.{name}.catalog-impl"] = implementation
    else:
        settings[f"spark.sql.catalog.{name}.type"] = "hadoop"
    return settings


def catalog_of(spark: SparkSession, table: str) -> str | None:
    """Catalog of a three-part name when the session maps it to Iceberg."""
    parts = table.split(".")
    if "/" in table or len(parts) != 3:
        return None
    configured = spark.conf.get(f"spark.sql.catalog.{parts[0]}", "") or ""
    return parts[0] if configured.startswith("org.apache.iceberg.") else None


def write(df: DataFrame, table: str, mode: str, partition_by: Sequence[str]) -> None:
    writer = df.writeTo(table)
    if not df.sparkSession.catalog.tableExists(table):
        writer = writer.using("iceberg").tableProperty("format-version", "2")
        if partition_by:
            writer = writer.partitionedBy(*[F.col(c) for c in partition_by])
        writer.create()
    elif mode == "append":
        writer.append()
    elif mode == "overwrite":
        # Schema and partitioning are replaced too, older snapshots stay.
        writer = writer.using("iceberg").tableProperty("format-version", "2")
        if partition_by:
            writer = writer.partitionedBy(*[F.col(c) for c in partition_by])
        writer.replace()
    else:
        writer.overwritePartitions()


def merge(source: DataFrame, table: str, keys: Sequence[str], newer_by: Sequence[str] | None) -> None:
    matched = F.lit(True)
    for key in keys:
        matched &= F.col(f"s.{quoted(key)}") == F.col(f"{quoted(table)}.{quoted(key)}")
    # A source row that is older matches, so it is not inserted, and changes nothing.
    newer = F.lit(True)
    if newer_by is not None:
        sides = [F.struct(*[F.col(f"{t}.{quoted(c)}") for c in newer_by]) for t in (quoted(table), "s")]
        newer = ~(sides[0] > sides[1])
    (
        source.alias("s")
        .mergeInto(table, matched)
        .whenMatched(newer)
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )


def _call(spark: SparkSession, catalog: str, procedure: str, arguments: str) -> DataFrame:
    return spark.sql(f"CALL {quoted(catalog)}.system.{procedure}({arguments})")


def refuse(spark: SparkSession, table: str, what: str) -> None:
    """Raise for what only ledger tables have, instead of looking for a ledger that is not there."""
    if catalog_of(spark, table):
        raise NotImplementedError(f"{what} is not available for Iceberg tables: {table}")


def compact(
    spark: SparkSession, catalog: str, table: str, target_bytes: int, sort_by: Sequence[str] = ()
) -> DataFrame:
    options = f"map('target-file-size-bytes', '{target_bytes}')"
    order = ", ".join(f"{quoted(c)} ASC NULLS FIRST" for c in sort_by)
    sort = f", strategy => 'sort', sort_order => {literal(order)}" if sort_by else ""
    return _call(
        spark,
        catalog,
        "rewrite_data_files",
        f"table => {literal(table)}, options => {options}{sort}",
    )


def expire(
    spark: SparkSession, catalog: str, table: str, older_than: datetime, keep: int
) -> DataFrame:
    return _call(
        spark,
        catalog,
        "expire_snapshots",
        f"table => {literal(table)}, older_than => TIMESTAMP '{older_than}', "
        f"retain_last => {keep}",
    )


def remove_orphans(
    spark: SparkSession, catalog: str, table: str, older_than: datetime, dry_run: bool
) -> DataFrame:
    return _call(
        spark,
        catalog,
        "remove_orphan_files",
        f"table => {literal(table)}, older_than => TIMESTAMP '{older_than}', "
        f"dry_run => {str(dry_run).lower()}",
    )
