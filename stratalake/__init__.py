"""Layered lake tables on Spark: reads, writes, upserts, transforms, checks and maintenance."""

from stratalake.layers import Lake
from stratalake.session import get_spark
from stratalake.sinks import (
    alter_lake,
    create_lake_table,
    evolve_lake,
    insert_raw,
    merge_lake,
    write_lake,
    write_raw,
)
from stratalake.sources import read_lake, read_raw, register_raw

__all__ = [
    "Lake",
    "alter_lake",
    "create_lake_table",
    "evolve_lake",
    "get_spark",
    "insert_raw",
    "merge_lake",
    "read_lake",
    "read_raw",
    "register_raw",
    "write_lake",
    "write_raw",
]
