"""Incremental reads of lake tables and the chain that is built on them."""

import random
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql.types import StructType

from stratalake import Lake, evolve_lake, merge_lake, read_lake, write_lake
from stratalake.layers import LAYERS
from stratalake.plans.layers import load_delivery, raw_to_curated, tables_of
from stratalake.plans.maintenance import compact_lake, expire_lake
from stratalake.sources import HistoryExpiredError, read_changed, read_new

SCHEMA = "id bigint, day string"


@pytest.fixture
def paths(tmp_path):
    return f"file:{tmp_path}/source", f"file:{tmp_path}/target"


def frame(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


def step(spark, read, source, target):
    increment = read(spark, source, target)
    if increment is None:
        return None
    write_lake(increment.rows, target, increment.mode, bookmark=increment.bookmark)
    return rows(increment.rows)


def test_only_new_rows(spark, paths):
    source, target = paths
    write_lake(frame(spark, (1, "a")), source)
    assert step(spark, read_new, source, target) == [(1, "a")]
    assert step(spark, read_new, source, target) is None
    write_lake(frame(spark, (2, "a")), source)
    write_lake(frame(spark, (3, "b")), source)
    assert step(spark, read_new, source, target) == [(2, "a"), (3, "b")]
    assert rows(read_lake(spark, target)) == rows(read_lake(spark, source))


def test_a_run_that_dies_is_repeated(spark, paths):
    source, target = paths
    write_lake(frame(spark, (1, "a")), source)
    read_new(spark, source, target)
    assert step(spark, read_new, source, target) == [(1, "a")]


def test_maintenance_of_the_source_adds_nothing(spark, paths):
    source, target = paths
    write_lake(frame(spark, (1, "a")), source)
    step(spark, read_new, source, target)
    write_lake(frame(spark, (2, "a")), source)
    compact_lake(spark, source)
    evolve_lake(spark, source, StructType.fromDDL("more int"))
    increment = read_new(spark, source, target)
    assert rows(increment.rows) == [(2, "a", None)]
    write_lake(increment.rows.drop("more"), target, bookmark=increment.bookmark)
    assert read_new(spark, source, target) is None


def test_bookmark_outlives_other_writes(spark, paths):
    source, target = paths
    write_lake(frame(spark, (1, "a")), source)
    step(spark, read_new, source, target)
    merge_lake(frame(spark, (9, "z")), target, ["id"])
    compact_lake(spark, target)
    assert read_new(spark, source, target) is None


def test_changes_are_no_new_rows(spark, paths):
    source, target = paths
    write_lake(frame(spark, (1, "a")), source)
    step(spark, read_new, source, target)
    merge_lake(frame(spark, (1, "b")), source, ["id"])
    with pytest.raises(ValueError, match="is no append: merge"):
        read_new(spark, source, target)


def test_expired_history_is_noticed(spark, paths):
    source, target = paths
    day = [datetime(2024, 1, number) for number in range(1, 8)]
    write_lake(frame(spark, (1, "a")), source, committed_at=day[0])
    step(spark, read_new, source, target)
    for number in (2, 3, 4):
        write_lake(frame(spark, (number, "a")), source, committed_at=day[number])
    expire_lake(spark, source, as_of=datetime(2024, 3, 1), keep=2, dry_run=False)
    with pytest.raises(HistoryExpiredError):
        read_new(spark, source, target)
    whole = read_changed(spark, source, target)
    assert whole.mode == "overwrite" and whole.rows.count() == 4


def test_changed_partitions(spark, paths):
    source, target = paths
    write_lake(frame(spark, (1, "a"), (2, "b"), (3, "c")), source, partition_by=["day"])
    first = read_changed(spark, source, target)
    assert first.mode == "overwrite" and first.rows.count() == 3
    write_lake(first.rows, target, first.mode, partition_by=["day"], bookmark=first.bookmark)
    assert read_changed(spark, source, target) is None
    write_lake(frame(spark, (4, "a")), source)
    assert step(spark, read_changed, source, target) == [(1, "a"), (4, "a")]
    # The row leaves day b, where another one stays.
    write_lake(frame(spark, (5, "b")), source)
    merge_lake(frame(spark, (2, "c")), source, ["id"])
    increment = read_changed(spark, source, target)
    assert increment.mode == "overwrite_partitions"
    assert step(spark, read_changed, source, target) == [(2, "c"), (3, "c"), (5, "b")]
    # Now day b is empty, so the target has to be written as a whole.
    merge_lake(frame(spark, (5, "c")), source, ["id"])
    increment = read_changed(spark, source, target)
    assert increment.mode == "overwrite"
    step(spark, read_changed, source, target)
    assert rows(read_lake(spark, target)) == rows(read_lake(spark, source))


RAW = "event_id string, payload string, created_at timestamp_ntz, dt string"


def random_raw(rng, count):
    made = []
    for _ in range(count):
        day, hour = rng.randint(1, 4), rng.randint(0, 23)
        payload = f'{{"user_id": 1, "event_type": "click", "value": {rng.randint(1, 99)}}}'
        if rng.random() < 0.1:
            payload = "{broken"
        made.append(
            (str(rng.randint(0, 25)), payload, datetime(2024, 1, day, hour), f"2024-01-0{day}")
        )
    return made


def test_deliveries_give_the_same_as_everything_at_once(spark, tmp_path):
    rng = random.Random(1)
    deliveries = [random_raw(rng, 15) for _ in range(3)]

    def make(name):
        folders = {layer: f"file:{tmp_path}/{name}/{layer}" for layer in LAYERS}
        return Lake(name, "de", "sales", folders)

    whole, parts = make("whole"), make("parts")
    every = spark.createDataFrame([row for part in deliveries for row in part], RAW)
    # Versions of an event at the same time are no matter of this test.
    every = every.dropDuplicates(["event_id", "created_at"]).cache()
    for part in deliveries:
        part = spark.createDataFrame(part, RAW).join(every, every.columns, "left_semi")
        by_delivery = load_delivery(spark, part.select(*every.columns), parts)
    at_once = raw_to_curated(spark, every, whole)
    assert rows(by_delivery) == rows(at_once)
    both = [tables_of(whole).refined, tables_of(parts).refined]
    assert rows(read_lake(spark, both[0])) == rows(read_lake(spark, both[1]))
    assert load_delivery(spark, every.limit(0), parts).count() == at_once.count()
