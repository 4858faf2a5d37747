"""Incremental loads and alert streams."""

import pytest
from conftest import rows

from stratalake import read_raw, write_raw
from stratalake.operators import Rule
from stratalake.streaming import forward_alerts, new_rows, run_incremental

SCHEMA = "id bigint, kind string"


@pytest.fixture
def paths(tmp_path):
    return {name: f"file:{tmp_path}/{name}" for name in ("source", "target", "checkpoint")}


def load(spark, paths, **options):
    stream = new_rows(spark, paths["source"], SCHEMA, **options)
    run_incremental(stream, paths["target"], paths["checkpoint"])
    return rows(read_raw(spark, paths["target"], schema=SCHEMA))


def test_each_run_takes_only_new_rows(spark, paths):
    first = spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA)
    write_raw(first, paths["source"])
    assert load(spark, paths) == [(1, "a"), (2, "b")]
    assert load(spark, paths) == [(1, "a"), (2, "b")]
    write_raw(spark.createDataFrame([(3, "c")], SCHEMA), paths["source"])
    assert load(spark, paths) == [(1, "a"), (2, "b"), (3, "c")]


def test_small_batches_load_everything(spark, paths):
    for i in range(5):
        write_raw(spark.createDataFrame([(i, "a")], SCHEMA), paths["source"])
    assert load(spark, paths, max_files=2) == [(i, "a") for i in range(5)]


def test_files_with_an_old_time_are_not_lost(spark, paths, tmp_path):
    import os

    write_raw(spark.createDataFrame([(1, "a")], SCHEMA), paths["source"])
    load(spark, paths)
    write_raw(spark.createDataFrame([(2, "late")], SCHEMA), paths["source"])
    for path in (tmp_path / "source").glob("*.parquet"):
        if "late" in str(spark.read.parquet(f"file:{path}").collect()):
            os.utime(path, (10**9, 10**9))
    assert load(spark, paths) == [(1, "a"), (2, "late")]


def test_partitioned_target(spark, paths):
    write_raw(spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA), paths["source"])
    stream = new_rows(spark, paths["source"], SCHEMA)
    run_incremental(stream, paths["target"], paths["checkpoint"], partition_by=["kind"])
    assert rows(read_raw(spark, paths["target"], schema=SCHEMA)) == [(1, "a"), (2, "b")]


def test_alerts_are_forwarded_once(spark, paths):
    rules = [Rule("bad", {"kind": ["error"]})]
    expected = []
    for i in range(2):
        write_raw(spark.createDataFrame([(i, "error"), (i, "fine")], SCHEMA), paths["source"])
        stream = new_rows(spark, paths["source"], SCHEMA)
        forward_alerts(stream, rules, paths["target"], paths["checkpoint"])
        expected.append((i, "error", "bad"))
        assert rows(read_raw(spark, paths["target"], schema=f"{SCHEMA}, rule string")) == expected


def test_files_that_were_read_move_to_the_archive(spark, tmp_path):
    source, archive = f"file:{tmp_path}/in", f"{tmp_path}/archive"
    for number in range(3):
        spark.range(number, number + 1, 1, 1).write.mode("append").parquet(source)
        rows = new_rows(spark, source, "id long", archive=archive)
        run_incremental(rows, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [0, 1, 2]
    assert list((tmp_path / "archive").rglob("part-*.parquet"))
