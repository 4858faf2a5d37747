"""How rows are spread over tasks before they are written.

No layout puts all rows of one partition value, one sort value or one group of copies into a
single task, so a value that holds a third of a table still becomes many files.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from threading import RLock

from pyspark.sql import DataFrame, SparkSession, functions as F

_TIE = "_layout_tie"


def arrange(
    df: DataFrame, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()
) -> DataFrame:
    """Spread ``df`` for a write.

    * neither: the rows stay where they are, no shuffle;
    * ``partition_by``: few files per partition value; AQE splits values that are too big for one
      task and merges small ones (``REBALANCE``);
    * ``sort_by``: files hold disjoint ranges of (partition, sort columns) and are sorted inside,
      so that a filter on the sort columns skips files and row groups. The number of the input
      task breaks ties between equal rows; it is the same when a task is run again. The ranges
      need a sample, so ``df`` is computed twice: write it down first if it is expensive.
    """
    if sort_by:
        order = [F.col(c) for c in [*partition_by, *sort_by]]
        tied = df.withColumn(_TIE, F.spark_partition_id())
        return tied.orderBy(*order, _TIE).drop(_TIE)
    if partition_by:
        return df.hint("rebalance", *[F.col(c) for c in partition_by])
    return df


def arrange_ranges(
    df: DataFrame, sort_by: Sequence[str], folder: str, ranges: int | None = None
) -> DataFrame:
    """Spread ``df`` by ranges of ``sort_by``, sorted, with the number of its range in ``folder``.

    ``ranges`` of them, or as many as AQE finds their size asks for. Equal values are split as in
    ``arrange``, so ranges may meet in a value.
    """
    order = [F.col(c) for c in [*sort_by, _TIE]]
    tied = df.withColumn(_TIE, F.spark_partition_id())
    spread = tied.repartitionByRange(ranges, *order) if ranges else tied.repartitionByRange(*order)
    numbered = spread.withColumn(folder, F.spark_partition_id())
    return numbered.sortWithinPartitions(folder, *order).drop(_TIE)


_SETTING = RLock()


@contextmanager
def session_conf(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Set session settings for the length of one action. Threads take turns, so that none puts back
    what another has set."""
    with _SETTING:
        before = {key: spark.conf.get(key, None) for key in values}
        for key, value in values.items():
            spark.conf.set(key, value)
        try:
            yield
        finally:
            for key, value in before.items():
                if value is None:
                    spark.conf.unset(key)
                else:
                    spark.conf.set(key, value)


def session_with(spark: SparkSession, values: Mapping[str, str]) -> SparkSession:
    """A session with the settings of ``spark`` and ``values``, for work that others go on beside."""
    own = spark.newSession()
    for key, value in {**spark.conf.getAll, **values}.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    return own


def file_size_conf(target_bytes: int) -> dict[str, str]:
    """Settings under which ``REBALANCE`` aims at tasks, hence files, of ``target_bytes``."""
    return {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
