"""Folders listed and deleted by Spark's tasks, for tables with more of them than a driver can hold.

Tasks reach no Hadoop file system, so they go by pyarrow's, with the credentials of the machine they
run on: local files, HDFS, S3, Google and Azure storage. Functions here travel with the job.
"""

from __future__ import annotations

import sys
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Requests at a time in one task, and rows it takes up together.
REQUESTS = 16
ROWS = 1024

# Spark's names of stores that pyarrow calls otherwise.
SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs"}


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a location and the location's path in it."""
    scheme = urlsplit(uri).scheme
    if scheme in ("", "file"):
        return fs.LocalFileSystem(), urlsplit(uri).path
    known = SCHEMES.get(scheme, scheme)
    return fs.FileSystem.from_uri(uri.replace(f"{scheme}://", f"{known}://", 1))


def _spread(rows: DataFrame) -> DataFrame:
    """Names over all tasks there are, however few bytes they are."""
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism)


def _batch(names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(names, pa.string())], names=["dir"])


def folders_below(parents: DataFrame, base: str) -> DataFrame:
    """(dir) of the folders directly below those of ``parents`` (dir), relative to ``base``; there
    may be none."""

    def list_them(batches):
        system, root = file_system(base)

        def below(parent: str) -> list[str]:
            path = f"{root}/{parent}".rstrip("/")
            found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
            return [f"{parent}/{x.base_name}".lstrip("/") for x in found if x.type == fs.FileType.Directory]

        with ThreadPoolExecutor(max_workers=REQUESTS) as pool:
            for batch in batches:
                for names in pool.map(below, batch.column("dir").to_pylist()):
                    for at in range(0, len(names), ROWS):
                        yield _batch(names[at : at + ROWS])

    return _spread(parents.select("dir")).mapInArrow(list_them, "dir string")


def roots(spark: SparkSession) -> DataFrame:
    """(dir) of a base folder itself."""
    return spark.createDataFrame([("",)], "dir string")


def delete_folders(folders: DataFrame, base: str) -> int:
    """Delete the folders ``dir`` below ``base``, each with all it holds; returns how many there
    were. Those that are gone already are no error, so a task can be run again."""

    def delete_them(batches):
        system, root = file_system(base)

        def delete(name: str) -> int:
            if not name or name.startswith("/") or ".." in name.split("/"):
                raise ValueError(f"not a folder below {base}: {name!r}")
            path = f"{root}/{name}"
            if system.get_file_info(path).type != fs.FileType.Directory:
                return 0
            try:
                system.delete_dir(path)
            except FileNotFoundError:
                return 0
            return 1

        with ThreadPoolExecutor(max_workers=REQUESTS) as pool:
            for batch in batches:
                gone = sum(pool.map(delete, batch.column("dir").to_pylist()))
                yield pa.RecordBatch.from_arrays([pa.array([gone], pa.int64())], names=["gone"])

    counts = _spread(folders.select("dir")).mapInArrow(delete_them, "gone long")
    return counts.groupBy().sum("gone").first()[0] or 0
