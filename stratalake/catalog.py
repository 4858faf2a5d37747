"""Databases, external tables and partitions in the session catalog."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import SparkSession

from stratalake import files


class Column(NamedTuple):
    name: str
    type: str
    comment: str = ""


# Properties a lake table always has, and keys that the catalog manages by itself.
LAKE_PROPERTIES = {"classification": "iceberg"}
RESERVED_PROPERTIES = ("table_type", "metadata_location")

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"  # what a folder is called for a null


def quoted(name: str) -> str:
    """Multi-part identifier with every part in backticks."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def path_value(value: str) -> str:
    """A partition value as it stands in the name of its folder."""
    return "".join(
        f"%{ord(c):02X}" if ord(c) < 32 or c in "\"#%'*/:=?\\\x7f{}[]^" else c for c in value
    )


def values_of(folder: str) -> dict[str, str | None]:
    """Partition columns and their values, as text, from ``key=value`` folder names."""
    parts = [part.split("=", 1) for part in folder.split("/") if part]
    return {key: None if value == NULL_PARTITION else unquote(value) for key, value in parts}


def _pairs(values: Mapping[str, str]) -> str:
    return ", ".join(f"{literal(k)} = {literal(str(v))}" for k, v in values.items())


def _partition(values: Mapping[str, str]) -> str:
    spec = ", ".join(
        f"{quoted(k)} = {'null' if v is None else literal(str(v))}" for k, v in values.items()
    )
    return f"PARTITION ({spec})"


def create_database(
    spark: SparkSession,
    name: str,
    *,
    location: str | None = None,
    comment: str = "",
    properties: Mapping[str, str] | None = None,
) -> None:
    parts = [f"CREATE DATABASE IF NOT EXISTS {quoted(name)}"]
    if comment:
        parts.append(f"COMMENT {literal(comment)}")
    if location:
        parts.append(f"LOCATION {literal(location)}")
    if properties:
        parts.append(f"WITH DBPROPERTIES ({_pairs(properties)})")
    spark.sql(" ".join(parts))


def table_ddl(
    name: str,
    columns: Sequence[Column],
    *,
    using: str = "parquet",
    partition_by: Sequence[Column] = (),
    location: str | None = None,
    comment: str = "",
    properties: Mapping[str, str] | None = None,
    if_not_exists: bool = False,
) -> str:
    """``CREATE TABLE`` text. Partition columns come last, as Spark returns them."""

    def column(definition: Column) -> str:
        text = f"{quoted(definition.name)} {definition.type}"
        return f"{text} COMMENT {literal(definition.comment)}" if definition.comment else text

    listed = ", ".join(column(Column(*c)) for c in [*columns, *partition_by])
    parts = [
        "CREATE TABLE" + (" IF NOT EXISTS" if if_not_exists else ""),
        f"{quoted(name)} ({listed})",
        f"USING {using}",
    ]
    if partition_by:
        parts.append("PARTITIONED BY (" + ", ".join(quoted(c[0]) for c in partition_by) + ")")
    if location:
        parts.append(f"LOCATION {literal(location)}")
    if comment:
        parts.append(f"COMMENT {literal(comment)}")
    if properties:
        parts.append(f"TBLPROPERTIES ({_pairs(properties)})")
    return " ".join(parts)


def lake_properties(extra: Mapping[str, str] | None = None) -> dict[str, str]:
    """Lake table properties: the fixed ones, overridden by ``extra`` without reserved keys."""
    kept = {k: v for k, v in (extra or {}).items() if k not in RESERVED_PROPERTIES}
    return LAKE_PROPERTIES | kept


def lake_table_ddl(
    name: str,
    columns: Sequence[Column],
    *,
    location: str | None = None,
    partition_by: Sequence[Column] = (),
    comment: str = "",
    properties: Mapping[str, str] | None = None,
) -> str:
    """``CREATE TABLE IF NOT EXISTS`` for an Iceberg v2 table."""
    return table_ddl(
        name,
        columns,
        using="iceberg",
        partition_by=partition_by,
        location=location,
        comment=comment,
        properties={"format-version": "2"} | lake_properties(properties),
        if_not_exists=True,
    )


def create_external_table(
    spark: SparkSession, name: str, columns: Sequence[Column], *, location: str, **options
) -> None:
    """External table over a folder, unless there is one; partitions that are there already are
    registered as well."""
    options = {"if_not_exists": True} | options
    spark.sql(table_ddl(name, columns, location=location, **options))
    if options.get("partition_by") and files.exists(spark, location):
        recover_partitions(spark, name)


def add_columns(spark: SparkSession, name: str, columns: Sequence[Column]) -> None:
    listed = ", ".join(f"{quoted(c[0])} {c[1]}" for c in columns)
    spark.sql(f"ALTER TABLE {quoted(name)} ADD COLUMNS ({listed})")


def recover_partitions(spark: SparkSession, name: str) -> None:
    """Register every partition folder below the table location."""
    spark.catalog.recoverPartitions(quoted(name))


def add_partitions(
    spark: SparkSession, name: str, partitions: Iterable[tuple[Mapping[str, str], str | None]]
) -> None:
    """Register ``(values, location or None)`` pairs in one statement."""
    clauses = [
        _partition(values) + (f" LOCATION {literal(location)}" if location else "")
        for values, location in partitions
    ]
    if clauses:
        spark.sql(f"ALTER TABLE {quoted(name)} ADD IF NOT EXISTS " + " ".join(clauses))


def drop_partitions(
    spark: SparkSession, name: str, partitions: Iterable[Mapping[str, str]]
) -> None:
    """Forget partitions of an external table; their files stay."""
    clauses = [_partition(values) for values in partitions]
    if clauses:
        spark.sql(f"ALTER TABLE {quoted(name)} DROP IF EXISTS " + ", ".join(clauses))


def partitions(
    spark: SparkSession, name: str, given: Mapping[str, str | None] | None = None
) -> list[dict[str, str | None]]:
    """Values of the registered partitions, all or those with the ``given`` values."""
    which = f" {_partition(given)}" if given else ""
    return [values_of(row[0]) for row in spark.sql(f"SHOW PARTITIONS {quoted(name)}{which}").collect()]


def move_partition(
    spark: SparkSession, name: str, values: Mapping[str, str], location: str
) -> None:
    spark.sql(
        f"ALTER TABLE {quoted(name)} {_partition(values)} SET LOCATION {literal(location)}"
    )
