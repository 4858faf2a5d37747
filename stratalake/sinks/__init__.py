from stratalake.sinks.lake import (
    DuplicateKeyError,
    alter_lake,
    create_lake_table,
    evolve_lake,
    merge_lake,
    write_lake,
)
from stratalake.sinks.landing import land_delivery
from stratalake.sinks.raw import insert_raw, write_raw

__all__ = [
    "DuplicateKeyError",
    "alter_lake",
    "create_lake_table",
    "evolve_lake",
    "insert_raw",
    "land_delivery",
    "merge_lake",
    "write_lake",
    "write_raw",
]
