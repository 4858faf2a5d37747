"""Lake tables in the session catalog, for SQL, views and listings."""

from __future__ import annotations

from itertools import batched

from pyspark.sql import SparkSession

from stratalake import catalog, ledger
from stratalake.catalog import Column, quoted
from stratalake.layers import resolve

FILES = "__files"
PARTITIONS_A_STATEMENT = 500


def register_lake(spark: SparkSession, table: str) -> None:
    """Make the newest snapshot of a lake table readable by its name; paths have none.

    The folders of the snapshot are the partitions of an external table, ``<name>__files``, so
    that Spark lists only those a query needs; the name itself is a view of the table's columns.
    Only folders that came or went are changed. The ledger remains what counts: a run that dies
    before this is made up for by the next write, or by calling this again.
    """
    if "/" in table:
        return
    location = resolve(spark, table)
    snapshot = ledger.latest(spark, location)
    if snapshot is None:
        raise ValueError(f"no such table: {table}")
    *_, database, name = table.split(".")
    files_table, view = f"{database}.{name}{FILES}", f"{database}.{name}"
    stored = {field.name: ledger.stored_name(field) for field in snapshot.schema}
    types = {field.name: field.dataType.simpleString() for field in snapshot.schema}
    inner = [Column(stored[c], t) for c, t in types.items() if c not in snapshot.partition_by]
    keys = [Column(ledger.COMMIT, "string"), *(Column(c, types[c]) for c in snapshot.partition_by)]
    if snapshot.ranges and snapshot.ranges.layout:
        keys.append(Column(ledger.RANGE, "string"))
    listed = ", ".join(quoted(s) if s == c else f"{quoted(s)} AS {quoted(c)}" for c, s in stored.items())

    wanted = {column.name: column.type for column in [*inner, *keys]}
    exists = spark.catalog.tableExists(files_table)
    if exists and dict(spark.table(files_table).dtypes) != wanted:
        spark.sql(f"DROP TABLE {quoted(files_table)}")  # external: the data stay
        exists = False
    if not exists:
        spark.sql(
            catalog.table_ddl(files_table, inner, partition_by=keys, location=f"{location}/data")
        )
    there = {row[0] for row in spark.sql(f"SHOW PARTITIONS {quoted(files_table)}").collect()}
    live = set(snapshot.dirs)

    def values(directory: str) -> dict[str, str | None]:
        commit = directory.partition("/")[0].partition("=")[2]
        return {ledger.COMMIT: commit} | ledger.partition_values(directory)

    for some in batched(sorted(there - live), PARTITIONS_A_STATEMENT):
        catalog.drop_partitions(spark, files_table, map(values, some))
    for some in batched(sorted(live - there), PARTITIONS_A_STATEMENT):
        added = [(values(name), f"{location}/data/{name}") for name in some]
        catalog.add_partitions(spark, files_table, added)
    spark.sql(f"CREATE OR REPLACE VIEW {quoted(view)} AS SELECT {listed} FROM {quoted(files_table)}")
