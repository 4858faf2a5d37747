"""Directory listing, small text files and deletion through the Hadoop file system API.

Only names of directories and one-line files pass through here; table data never does.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Requests to the file system at a time; folders number as many as partitions.
REQUESTS = 16


def _open(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def qualify(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme, as the file system spells it."""
    fs, jpath = _open(spark, path)
    return fs.makeQualified(jpath).toString().rstrip("/")


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _open(spark, path)
    return fs.exists(jpath)


def children(spark: SparkSession, path: str, *, directories: bool) -> list[str]:
    """Sorted names directly below ``path``: only directories, or only files."""
    fs, jpath = _open(spark, path)
    if not fs.exists(jpath):
        return []
    return sorted(
        status.getPath().getName()
        for status in fs.listStatus(jpath)
        if status.isDirectory() == directories
    )


def partition_dirs(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Relative ``key=value`` directories exactly ``depth`` levels below ``path``."""
    found = [""]
    with ThreadPoolExecutor(max_workers=REQUESTS) as pool:
        for _ in range(depth):
            below = pool.map(
                lambda parent: children(spark, f"{path}/{parent}".rstrip("/"), directories=True),
                found,
            )
            found = [
                f"{parent}/{name}".lstrip("/")
                for parent, names in zip(found, below)
                for name in names
                if "=" in name
            ]
    return [name for name in found if name]


def read_text(spark: SparkSession, path: str) -> str:
    fs, jpath = _open(spark, path)
    stream = fs.open(jpath)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text_once(spark: SparkSession, path: str, text: str) -> None:
    """Create ``path`` in one step; a path that already exists is an error.

    The text is put down under a name of its own first. A local file then gets its name by a hard
    link and others by a rename that does not replace, both of which only one writer can do; what
    is there afterwards is compared with the text, for stores whose rename promises less.
    """
    fs, target = _open(spark, path)
    if fs.exists(target):
        raise FileExistsError(path)
    folder, name = path.rsplit("/", 1)
    _, pending = _open(spark, f"{folder}/_pending-{uuid.uuid4().hex}-{name}")
    stream = fs.create(pending, False)
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    try:
        if fs.getScheme() == "file":
            local = [spark._jvm.java.io.File(p.toUri().getPath()).toPath() for p in (target, pending)]
            spark._jvm.java.nio.file.Files.createLink(*local)
        else:
            options = spark.sparkContext._gateway.new_array(
                spark._jvm.org.apache.hadoop.fs.Options.Rename, 0
            )
            context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()
            )
            context.rename(pending, target, options)
    except Py4JJavaError as error:
        raise FileExistsError(path) from error
    finally:
        fs.delete(pending, False)
    if read_text(spark, path) != text:
        raise FileExistsError(path)


def delete(spark: SparkSession, *paths: str) -> None:
    def remove(path: str) -> None:
        fs, jpath = _open(spark, path)
        fs.delete(jpath, True)

    with ThreadPoolExecutor(max_workers=REQUESTS) as pool:
        list(pool.map(remove, paths))
