"""Ranges of a key: what is noted, what is passed over, what an upsert writes again."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from stratalake import alter_lake, ledger, merge_lake, read_lake, write_lake
from stratalake.operators import DataQualityError
from stratalake.plans.layers import load_delivery, tables_of
from stratalake.plans.maintenance import compact_lake, data_files, remove_orphans
from stratalake.sinks import DuplicateKeyError
from stratalake.sinks.ranges import folders_around


def numbers(spark, start, stop):
    return spark.range(start, stop).select("id", (F.col("id") * 2).alias("v"))


def dirs(spark, location):
    return set(ledger.latest(spark, location).dirs)


@pytest.fixture
def read(monkeypatch):
    """The folders whose rows are asked for, call by call."""
    calls, rows_in = [], ledger.rows_in
    monkeypatch.setattr(ledger, "rows_in", lambda s, p, d, c: calls.append(set(d)) or rows_in(s, p, d, c))
    return calls


def test_an_upsert_of_one_key_writes_one_range_of_a_hundred(spark, location, read):
    write_lake(numbers(spark, 0, 10000), location, range_by="id", ranges=100)
    before = dirs(spark, location)
    assert len(before) == 100
    read.clear()
    merge_lake(spark.createDataFrame([(4321, -1)], "id bigint, v bigint"), location, ["id"])
    after = dirs(spark, location)
    assert len(before - after) == 1 and len(after - before) == 1
    assert max(map(len, read)) == 1  # no other folder is even listed
    assert read_lake(spark, location).where("v = -1").collect()[0]["id"] == 4321
    assert read_lake(spark, location).count() == 10000


def test_only_folders_with_room_for_a_key_are_listed(spark, location, read):
    days = numbers(spark, 0, 1000).withColumn("day", F.floor(F.col("id") / 100))
    write_lake(days, location, partition_by=["day"], range_by="id")
    known = ledger.latest(spark, location).ranges
    assert known.column == "id" and not known.layout
    assert {d.rpartition("=")[2]: r for d, r in known.folders.items()} == {
        str(n): (str(100 * n), str(100 * n + 99)) for n in range(10)
    }
    read.clear()
    # Two keys far apart: the folders between them are passed over as well.
    change = spark.createDataFrame([(7, -1, 0), (950, -1, 9)], "id bigint, v bigint, day bigint")
    merge_lake(change, location, ["id"])
    assert {d.rpartition("=")[2] for d in read[0]} == {"0", "9"}
    assert read_lake(spark, location).where("v = -1").count() == 2
    # Appends note ranges too, and what is not known is looked through.
    write_lake(days.where("id < 5").withColumn("id", F.col("id") + 5000), location)
    read.clear()
    merge_lake(spark.createDataFrame([(5003, 0, 0)], "id bigint, v bigint, day bigint"), location, ["id"])
    assert max(map(len, read)) == 1 and read_lake(spark, location).count() == 1005


def test_upserts_note_the_range_of_their_key(spark, location, read):
    write_lake(numbers(spark, 0, 10), location)
    merge_lake(numbers(spark, 100, 110), location, ["id"])
    first, second = sorted(dirs(spark, location))
    assert ledger.latest(spark, location).ranges.folders == {second: ("100", "109")}
    read.clear()
    merge_lake(numbers(spark, 50, 60), location, ["id"])
    assert read[0] == {first}
    with pytest.raises(ValueError, match="keeps ranges of id"):
        write_lake(numbers(spark, 0, 1), location, range_by="v")


def test_ranged_tables_through_all_operations(spark, lake):
    lake.create_databases(spark)
    name = lake.table("refined", "ranged")
    location = lake.location("refined", "ranged")
    write_lake(numbers(spark, 0, 1000), name, range_by="id", ranges=10)
    write_lake(numbers(spark, 500, 1500).withColumn("id", F.col("id") + 500), name)
    assert ledger.latest(spark, location).ranges.layout
    expected = rows(read_lake(spark, name))
    assert len(expected) == 2000 and rows(spark.table(name)) == expected
    assert data_files(spark, name).select("partition").distinct().collect()[0][0] == ""
    compact_lake(spark, name)
    snapshot = ledger.latest(spark, location)
    assert rows(spark.table(name)) == expected == rows(read_lake(spark, name))
    assert snapshot.dirs and set(snapshot.ranges.folders) == set(snapshot.dirs)
    assert all(f"/{ledger.RANGE}=" in d for d in snapshot.dirs)
    assert remove_orphans(spark, name, as_of=datetime(2100, 1, 1)).count() == 0
    merge_lake(numbers(spark, 5000, 5001), name, ["id"])
    assert rows(spark.table(name)) == sorted([*expected, (5000, 10000)], key=repr)
    write_lake(numbers(spark, 0, 5), name, "overwrite")
    assert ledger.latest(spark, location).ranges is None
    assert rows(spark.table(name)) == rows(numbers(spark, 0, 5))


def test_ranges_are_sorted_and_one_hot_key_is_spread(spark, location):
    hot = spark.range(0, 20000, 1, 8).select(F.lit(1).alias("k"), (-F.col("id")).alias("v"))
    write_lake(hot, location, range_by="k", sort_by=["v"], ranges=8)
    sizes = read_lake(spark, location).groupBy(F.input_file_name()).count().collect()
    assert len(sizes) > 4 and max(r["count"] for r in sizes) <= 10000
    for row in read_lake(spark, location).groupBy(F.col("_metadata.file_path").alias("f")).agg(
        F.collect_list(F.struct("_metadata.row_index", "v")).alias("rows")
    ).collect():
        values = [r["v"] for r in sorted(row["rows"])]
        assert values == sorted(values)


VALUES = {
    "bigint": [-5, -1, 0, 3, 7, 10**12],
    "string": ["", "A", "a", "a b", "z", "ä", "\uffee", "𝄞"],
    "date": [date(1969, 1, 1), date(2024, 2, 29), date(2024, 3, 1)],
    "timestamp_ntz": [datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 0, 5), datetime(2024, 1, 1, 0, 0, 1)],
    "decimal(12,2)": [Decimal("-10.50"), Decimal("-9.00"), Decimal("0.00"), Decimal("100.00")],
    "double": [-1.0, 0.5, float("nan")],
}


@pytest.mark.parametrize("kind", VALUES)
def test_every_folder_with_a_key_is_among_those_looked_through(spark, location, kind):
    schema = f"k {kind}, p int"
    for n, pair in enumerate(zip(VALUES[kind], VALUES[kind][1:])):
        write_lake(
            spark.createDataFrame([(pair[0], n), (pair[1], n), (None, n)], schema), location, range_by="k", ranges=1
        )
    write_lake(spark.createDataFrame([(None, 99)], schema), location)
    snapshot = ledger.latest(spark, location)
    for value in VALUES[kind]:
        source = spark.createDataFrame([(value, 0), (None, 0)], schema)
        around = folders_around(source, snapshot, "k")
        holding = ledger.rows_in(spark, location, snapshot.dirs, snapshot.schema).where(
            F.col("k") == F.lit(value).cast(kind)
        )
        found = {r[0] for r in holding.select(ledger.dir_of(F.col("_metadata.file_path"))).collect()}
        assert found <= set(around)
        if kind != "double":
            assert len(around) <= 2 and found == set(around)
    assert read_lake(spark, location).count() == 3 * (len(VALUES[kind]) - 1) + 1


spans = st.lists(st.tuples(st.integers(0, 60), st.integers(0, 25)), min_size=1, max_size=8)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(spans=spans, keys=st.sets(st.integers(-5, 90), max_size=6))
def test_folders_around_matches_brute_force(spark, spans, keys):
    known = {f"_commit={n}-x": (str(low), str(low + more)) for n, (low, more) in enumerate(spans)}
    schema = spark.range(1).schema
    snapshot = ledger.Snapshot(
        1, datetime(2024, 1, 1), "append", (*known, "_commit=99-y"), (), schema, {}, (),
        ledger.Ranges("id", False, known),
    )
    source = spark.createDataFrame([(k,) for k in keys], "id bigint").repartition(2)
    want = {d for d, (low, high) in known.items() if any(int(low) <= k <= int(high) for k in keys)}
    assert sorted(folders_around(source, snapshot, "id")) == sorted(want | {"_commit=99-y"})


# Uniqueness over all folders


def test_rows_that_repeat_a_key_of_the_table_are_refused(spark, location, read):
    for start in (0, 100, 200):
        write_lake(numbers(spark, start, start + 100), location, range_by="id", unique_by=["id"], ranges=1)
    before = rows(read_lake(spark, location))
    read.clear()
    with pytest.raises(DataQualityError, match="1 rows of the table have a key of these rows"):
        write_lake(numbers(spark, 299, 310), location, unique_by=["id"])
    assert max(map(len, read)) == 1  # the new folder, and the one old folder around 299
    with pytest.raises(DataQualityError, match="4 rows share a key"):
        write_lake(numbers(spark, 400, 402).unionAll(numbers(spark, 400, 402)), location, unique_by=["id"])
    assert rows(read_lake(spark, location)) == before
    write_lake(spark.createDataFrame([(None, 1), (None, 2)], "id bigint, v bigint"), location, unique_by=["id"])
    write_lake(numbers(spark, 0, 10), location, "overwrite", unique_by=["id"])
    assert read_lake(spark, location).count() == 10


def test_overwritten_partitions_do_not_count(spark, location):
    days = numbers(spark, 0, 20).withColumn("day", F.floor(F.col("id") / 10))
    write_lake(days, location, partition_by=["day"], unique_by=["id"])
    write_lake(days.where("day = 1"), location, "overwrite_partitions", unique_by=["id"])
    moved = days.where("id = 3").withColumn("day", F.lit(1).cast("bigint"))
    with pytest.raises(DataQualityError):
        write_lake(moved, location, "overwrite_partitions", unique_by=["id"])
    assert read_lake(spark, location).count() == 20


def test_an_upsert_finds_repeats_in_what_it_writes_and_around_it(spark, location):
    write_lake(numbers(spark, 0, 10).unionAll(numbers(spark, 5, 6)), location, range_by="id", ranges=1)
    change = spark.createDataFrame([(3, 0)], "id bigint, v bigint")
    with pytest.raises(DataQualityError, match="2 rows share a key"):
        merge_lake(change, location, ["id"], unique_by=["id"])
    merge_lake(spark.createDataFrame([(5, 0)], "id bigint, v bigint"), location, ["id"], unique_by=["id"])
    write_lake(numbers(spark, 7, 8), location)  # planted in another folder
    with pytest.raises(DataQualityError, match="1 rows of the table"):
        merge_lake(change, location, ["id"], unique_by=["id"])
    merge_lake(change, location, ["id"])
    with pytest.raises(DuplicateKeyError):
        merge_lake(change.unionAll(change), location, ["id"])


def test_a_planted_repeat_closes_the_gate_of_the_next_delivery(spark, lake):
    raw = "event_id string, payload string, created_at timestamp_ntz, dt string"

    def delivery(*numbers):
        text = '{"user_id": 1, "event_type": "click", "value": 1, "props": "{}"}'
        day = lambda n: 1 + n // 10
        return spark.createDataFrame(
            [(str(n), text, datetime(2024, 1, day(n)), f"2024-01-{day(n):02}") for n in numbers], raw
        )

    load_delivery(spark, delivery(1, 2, 11, 12, 21), lake)
    refined = tables_of(lake).refined
    again = read_lake(spark, refined).where("event_id = 12")
    write_lake(again, refined)
    load_delivery(spark, delivery(1), lake)  # another day, other folders
    with pytest.raises(DataQualityError, match="unique"):
        load_delivery(spark, delivery(11), lake)
    assert read_lake(spark, refined).where("event_id = 12").count() == 2
