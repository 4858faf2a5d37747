from stratalake.sources.incremental import (
    HistoryExpiredError,
    Increment,
    bookmark_of,
    read_changed,
    read_new,
)
from stratalake.sources.tables import lake_exists, read_lake, read_raw, register_raw

__all__ = [
    "HistoryExpiredError",
    "Increment",
    "bookmark_of",
    "lake_exists",
    "read_changed",
    "read_lake",
    "read_new",
    "read_raw",
    "register_raw",
]
