"""What the corpus operators share: words, hashes, scratch tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType
from xxhash import xxh3_64_intdigest

from stratalake.session import scratch_path
from stratalake.sinks.layout import session_conf


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder; what reads it no longer depends on how it was made."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession, most: int = 1000):
    """Within it, tasks get batches of at most ``most`` rows, of which executor and Python worker both
    hold one: texts, or pairs of them, make batches of Spark's 10,000 rows large."""
    given = int(spark.conf.get(BATCH_ROWS, "10000"))
    return session_conf(spark, {BATCH_ROWS: str(min(given, most) if given > 0 else most)})


def columns_of(df: DataFrame) -> list[Column]:
    """The columns of ``df``, whatever they are called."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in df.columns]


def new_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores in front as far as ``df`` has a column of that name, in
    either case."""
    taken = {name.lower() for name in df.columns}
    found = []
    for name in names:
        while name in taken:
            name = f"_{name}"
        taken.add(name)
        found.append(name)
    return found


def map_batches(df: DataFrame, function, schema: StructType) -> DataFrame:
    """``df.mapInArrow(function, schema)`` for columns of any names, also such as ``a.b``."""
    names, numbered = df.columns, [f"c{i}" for i in range(len(df.columns))]
    out = [f"c{i}" for i in range(len(schema))]

    def renamed(batches):
        for batch in function(b.rename_columns(names) for b in batches):
            yield batch.rename_columns(out)

    kinds = StructType([StructField(n, f.dataType, f.nullable) for n, f in zip(out, schema)])
    return df.toDF(*numbered).mapInArrow(renamed, kinds).toDF(*schema.names)


def hash_sample(rows: DataFrame, key: list[str], most: int) -> DataFrame:
    """At most ``most`` rows, those whose ``key`` has the smallest hash: the same ones however the
    rows are spread. Rows far from being among them are passed over in the scan, so that what tasks
    hand on has a bound that does not grow with their number."""
    at, count = F.xxhash64(*key), rows.count()
    if count > 2 * most + 1000:
        rows = rows.where(at < -(2**63) + 2**64 * (2 * most + 1000) // count)
    return rows.orderBy(at, *key).limit(most)


def parts_of(batches, rows: int):
    """Batches of at most ``rows`` rows, so that what is made of them stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def values(batch, name: str):
    """The values of a column one by one, texts as UTF-8 bytes, nulls as empty."""
    column = batch.column(name)
    if str(column.type) in ("string", "large_string"):
        column = column.cast("binary" if str(column.type) == "string" else "large_binary")
    for value in column:
        yield value.as_py() or b""


def finite_vector(vector: Column) -> Column:
    """Whether a vector is there and all its entries are numbers."""
    whole = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return F.coalesce(whole, F.lit(False))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """64-bit values spread evenly, one to one."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """One hash for every run of ``width`` consecutive words, put together from powers of two."""
    factor = 0x9E3779B97F4A7C15
    done, total, power, size = 0, None, hashes, 1
    while size <= width:
        if width & size:
            if total is None:
                total = power
            else:
                scale = np.uint64(pow(factor, size, 2**64))
                count = len(hashes) - done - size + 1
                total = total[:count] * scale + power[done : done + count]
            done += size
        if size * 2 <= width:
            scale = np.uint64(pow(factor, size, 2**64))
            count = len(hashes) - 2 * size + 1
            power = power[:count] * scale + power[size : size + count]
        size *= 2
    return mixed(total + np.uint64(width))
