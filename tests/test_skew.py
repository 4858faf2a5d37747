"""One value holds a third of all rows or more: results stay whole and work stays spread."""

from collections import Counter

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from stratalake import merge_lake, read_lake, write_lake
from stratalake.operators import Dimension, daily_summary, denormalise, latest_per_key
from stratalake.plans.maintenance import compact_lake, data_files
from stratalake.sinks.layout import session_conf

N = 60000
SMALL = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(64 * 1024),
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(64 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture
def skewed(spark):
    """A third of the rows, and of the days, are the same."""
    hot = F.col("id") % 3 == 0
    return spark.range(0, N, 1, 8).select(
        F.when(hot, 0).otherwise(F.col("id")).alias("key"),
        F.when(hot, "hot").otherwise(F.concat(F.lit("d"), F.col("id") % 5)).alias("day"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
        "id",
    )


def test_hot_partition_value_becomes_many_files(spark, skewed, location):
    with session_conf(spark, SMALL):
        write_lake(skewed, location, partition_by=["day"])
    files = Counter(r["partition"] for r in data_files(spark, location).collect())
    assert files["day=hot"] >= 4
    assert read_lake(spark, location).count() == N


def test_compaction_splits_a_hot_partition(spark, skewed, location):
    for part in (F.col("id") % 2 == 0, F.col("id") % 2 == 1):
        write_lake(skewed.where(part), location, partition_by=["day"])
    hot = data_files(spark, location).where("partition = 'day=hot'")
    total = hot.agg(F.sum("length")).first()[0]
    compact_lake(spark, location, target_bytes=int(total * 0.7))
    assert hot.count() == 2
    assert read_lake(spark, location).agg(F.sum("id")).first()[0] == N * (N - 1) // 2


def executed_plan(df):
    """The plan as it was after the run."""
    df.collect()
    return plan_of(df)


def test_hot_foreign_key_is_split(spark, skewed, tmp_path):
    path = f"file:{tmp_path}/dim"
    spark.range(N).select(F.col("id").alias("k"), F.lit("name").alias("name")).write.parquet(path)
    dimension = Dimension(spark.read.parquet(path), "k", "key")
    with session_conf(spark, SMALL):
        wide = denormalise(skewed, [dimension])
        assert "skew=true" in executed_plan(wide)
        assert wide.where("name is null").count() == 0
        assert wide.count() == N


def test_upsert_over_a_hot_key(spark, skewed, location):
    # The table may hold a key many times; the source row replaces all of them.
    write_lake(skewed, location)
    change = skewed.where("key in (0, 1)").dropDuplicates(["key"]).withColumn("text", F.lit("new"))
    with session_conf(spark, SMALL):
        merge_lake(change, location, ["key"])
    after = read_lake(spark, location)
    assert after.count() == N - N // 3 + 1
    assert after.where("text = 'new'").count() == 2


def test_newest_row_of_a_hot_key(skewed):
    newest = latest_per_key(skewed, ["key"], [F.desc("id")])
    assert newest.count() == N - N // 3 + 1
    assert newest.where("key = 0").first()["id"] == N - 3


def test_hot_day_in_a_summary(spark, skewed):
    day = F.when(F.col("day") == "hot", "2024-01-01").otherwise("2024-01-02")
    timed = skewed.withColumn("t", day.cast("timestamp_ntz"))
    counts = {str(r["date"]): r["total_count"] for r in daily_summary(timed, "t", "id").collect()}
    assert counts == {"2024-01-01": N // 3, "2024-01-02": N - N // 3}
