"""Writes to standard (non-snapshot) tables and folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from stratalake.sinks.layout import arrange, session_conf

# Text formats would cut times to milliseconds by default.
TEXT_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

MODES = ("append", "overwrite", "overwrite_partitions")


def check_mode(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")


def write_raw(
    df: DataFrame,
    path: str,
    *,
    fmt: str = "parquet",
    mode: str = "append",
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
) -> None:
    """Write files as they are. ``overwrite_partitions`` replaces only the partitions in ``df``."""
    check_mode(mode)
    writer = arrange(df, partition_by, sort_by).write.format(fmt)
    if fmt in ("csv", "json"):
        writer = writer.options(**TEXT_TIMES)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if mode == "overwrite_partitions":
        if not partition_by:
            raise ValueError("overwrite_partitions needs partition_by")
        writer = writer.option("partitionOverwriteMode", "dynamic")
    elif mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "static")
    writer.mode("append" if mode == "append" else "overwrite").save(path)


def insert_raw(df: DataFrame, table: str, *, mode: str = "append") -> None:
    """Write into a registered table by column name; new partitions are registered too."""
    check_mode(mode)
    columns = df.sparkSession.catalog.listColumns(table)
    rows = df.select(*[column.name for column in columns])
    writer = arrange(rows, [column.name for column in columns if column.isPartition]).write
    if mode == "append":
        writer.insertInto(table)
        return
    overwrite = "dynamic" if mode == "overwrite_partitions" else "static"
    # insertInto takes this from the session, not from the options of the writer.
    conf = {"spark.sql.sources.partitionOverwriteMode": overwrite}
    with session_conf(df.sparkSession, conf):
        writer.insertInto(table, overwrite=True)
