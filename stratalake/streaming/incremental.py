"""Incremental loads: only what an earlier run has not seen.

The checkpoint of a file stream is the bookmark. A run takes the files that are new, ends by
itself, and leaves its target right even if it is stopped and started again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from stratalake.operators.alerts import Rule, match_rules

Transform = Callable[[DataFrame], DataFrame]


def new_rows(
    spark: SparkSession,
    source: str,
    schema: StructType | str,
    *,
    fmt: str = "parquet",
    max_files: int | None = None,
    max_file_age: str = "36500d",
    archive: str | None = None,
) -> DataFrame:
    """Stream over the files of a folder; ``max_files`` bounds one batch, not the run.

    Spark skips files older than ``max_file_age`` before the newest it has seen. Its own default
    of a week would lose files that arrive late with an old time. The price is that the names of
    all files ever seen are kept, in the driver and the checkpoint. In a folder that goes on
    growing, name an ``archive``: files that have been read move there, so ``source`` holds what is
    new and listing it stays cheap, and give ``max_file_age`` the longest delay of a delivery.
    Lakes of very many files are better read by ``read_new``, which goes by snapshots.
    """
    reader = spark.readStream.format(fmt).schema(schema).option("maxFileAge", max_file_age)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(source)


def run_incremental(
    rows: DataFrame,
    target: str,
    checkpoint: str,
    *,
    transform: Transform | None = None,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
) -> None:
    """Load everything that is new into ``target``.

    The target is a file sink: its log lists the files of finished batches, so a batch that is
    repeated after a failure is not counted twice.
    """
    output = transform(rows) if transform else rows
    writer = output.writeStream.format(fmt).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.trigger(availableNow=True).outputMode("append").start(target).awaitTermination()


def forward_alerts(
    events: DataFrame, rules: Sequence[Rule], target: str, checkpoint: str
) -> None:
    """Write events that match a rule to an alert table, each event once over all runs."""
    run_incremental(
        events, target, checkpoint, transform=lambda rows: match_rules(rows, rules)
    )
