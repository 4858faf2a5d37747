"""Lake tables: write modes, upsert, schema evolution, snapshots."""

import glob
from datetime import datetime

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratalake import create_lake_table, evolve_lake, ledger, merge_lake, read_lake, write_lake
from stratalake.operators import DataQualityError, QualityChecker
from stratalake.plans import registry
from stratalake.plans.maintenance import compact_lake
from stratalake.sinks import DuplicateKeyError

SCHEMA = "id bigint, day string, amount double"


def frame(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


def test_append_adds_rows(spark, location):
    assert write_lake(frame(spark, (1, "a", 1.0)), location) == 1
    assert write_lake(frame(spark, (2, "b", 2.0)), location) == 2
    assert rows(read_lake(spark, location)) == [(1, "a", 1.0), (2, "b", 2.0)]


def test_read_by_name(spark, lake):
    name = lake.table("refined", "orders")
    write_lake(frame(spark, (1, "a", 1.0)), name)
    assert name == f"spark_catalog.{lake.database('refined')}.orders"
    assert rows(read_lake(spark, name)) == [(1, "a", 1.0)]
    assert ledger.snapshot_ids(spark, lake.location("refined", "orders")) == [1]


def test_missing_table(spark, location):
    with pytest.raises(ValueError, match="no such table"):
        read_lake(spark, location)


def test_unknown_mode(spark, location):
    with pytest.raises(ValueError, match="mode must be one of"):
        write_lake(frame(spark), location, "upsert")


def test_empty_write(spark, location):
    write_lake(frame(spark), location, partition_by=["day"])
    assert rows(read_lake(spark, location)) == []
    assert read_lake(spark, location).dtypes == frame(spark).dtypes


def test_overwrite_replaces_rows_and_schema(spark, location):
    write_lake(frame(spark, (1, "a", 1.0)), location)
    write_lake(spark.createDataFrame([("x",)], "other string"), location, "overwrite")
    assert rows(read_lake(spark, location)) == [("x",)]


def test_overwrite_a_table_from_itself(spark, location):
    write_lake(frame(spark, (1, "a", 1.0), (2, "b", 2.0)), location)
    write_lake(read_lake(spark, location).where("id = 2"), location, "overwrite")
    assert rows(read_lake(spark, location)) == [(2, "b", 2.0)]


def test_overwrite_partitions_leaves_the_others(spark, location):
    write_lake(
        frame(spark, (1, "a", 1.0), (2, "a", 2.0), (3, "b", 3.0)), location, partition_by=["day"]
    )
    write_lake(frame(spark, (9, "a", 9.0), (8, "c", 8.0)), location, "overwrite_partitions")
    assert rows(read_lake(spark, location)) == [(3, "b", 3.0), (8, "c", 8.0), (9, "a", 9.0)]


def test_overwrite_partitions_with_odd_values(spark, location):
    odd = ["2024-01-01 10:00", "a+b", "a%20b", "ü/{x}", "k=v", None]
    write_lake(
        frame(spark, *[(i, d, 0.0) for i, d in enumerate(odd)]), location, partition_by=["day"]
    )
    write_lake(
        frame(spark, *[(i, d, 1.0) for i, d in enumerate(odd[1:])]),
        location,
        "overwrite_partitions",
    )
    got = {r["day"]: r["amount"] for r in read_lake(spark, location).collect()}
    assert got == {d: float(d != odd[0]) for d in odd}


def test_overwrite_partitions_needs_partitions(spark, location):
    with pytest.raises(ValueError, match="partitioned table"):
        write_lake(frame(spark), location, "overwrite_partitions")


def test_partitioning_of_a_table_is_fixed(spark, location):
    write_lake(frame(spark, (1, "a", 1.0)), location, partition_by=["day"])
    with pytest.raises(ValueError, match="partitioned by"):
        write_lake(frame(spark, (1, "a", 1.0)), location, partition_by=["id"])


def test_overwrite_can_change_the_partitioning(spark, location):
    write_lake(frame(spark, (1, "a", 1.0)), location, partition_by=["day"])
    write_lake(frame(spark, (2, "b", 2.0)), location, "overwrite", partition_by=["id"])
    assert rows(read_lake(spark, location)) == [(2, "b", 2.0)]
    write_lake(frame(spark, (3, "c", 3.0)), location, "overwrite", partition_by=[])
    assert rows(read_lake(spark, location)) == [(3, "c", 3.0)]
    assert rows(read_lake(spark, location, snapshot_id=1)) == [(1, "a", 1.0)]


def test_reading_some_partitions_lists_only_those(spark, location):
    odd = ["2024-01-01 10:00", "a+b", "a%20b", "ü/{x}", "k=v", None]
    write_lake(
        frame(spark, *[(i, d, 0.0) for i, d in enumerate(odd)]), location, partition_by=["day"]
    )
    for number, day in enumerate(odd):
        some = read_lake(spark, location, partitions={"day": [day]})
        assert rows(some) == [(number, day, 0.0)]
        assert len(some.inputFiles()) == 1
    assert rows(read_lake(spark, location, partitions={"day": ["none of them"]})) == []
    with pytest.raises(ValueError, match="not partitioned by id"):
        read_lake(spark, location, partitions={"id": ["1"]})


def test_partition_values_keep_their_type(spark, location):
    both = frame(spark, (1, "2024-01-03", 1.0), (2, "007", 2.0))
    write_lake(both, location, partition_by=["day"])
    table = read_lake(spark, location)
    assert table.dtypes == frame(spark).dtypes
    assert {r["day"] for r in table.collect()} == {"2024-01-03", "007"}


def test_append_checks_columns(spark, location):
    write_lake(frame(spark, (1, "a", 1.0)), location)
    with pytest.raises(ValueError, match="not in the table"):
        write_lake(frame(spark).withColumn("more", F.lit(1)), location)
    with pytest.raises(ValueError, match="amount is string, the table has double"):
        write_lake(frame(spark).withColumn("amount", F.lit("x")), location)
    write_lake(spark.createDataFrame([("b", 2)], "day string, id bigint"), location)
    assert rows(read_lake(spark, location)) == [(1, "a", 1.0), (2, "b", None)]


def test_audit_failure_publishes_nothing(spark, location):
    def no_negative(df):
        return QualityChecker(df).min_value("amount", 0.0)

    write_lake(frame(spark, (1, "a", 1.0)), location, audit=no_negative)
    with pytest.raises(DataQualityError, match="min_value"):
        write_lake(frame(spark, (2, "b", -1.0)), location, audit=no_negative)
    assert rows(read_lake(spark, location)) == [(1, "a", 1.0)]


def test_older_snapshots_stay_readable(spark, location):
    first = write_lake(frame(spark, (1, "a", 1.0)), location)
    write_lake(frame(spark, (2, "b", 2.0)), location, "overwrite")
    assert rows(read_lake(spark, location, snapshot_id=first)) == [(1, "a", 1.0)]
    with pytest.raises(ValueError, match="no such table or snapshot"):
        read_lake(spark, location, snapshot_id=77)


def test_second_writer_of_a_snapshot_fails(spark, location):
    write_lake(frame(spark, (1, "a", 1.0)), location)
    common = dict(
        operation="append",
        dirs=[],
        schema=StructType(),
        partition_by=[],
        at=datetime(2024, 1, 1),
    )
    with pytest.raises(FileExistsError):
        ledger.publish(spark, location, None, **common)


def test_history(spark, location):
    at = datetime(2024, 1, 1, 12, 0, 0, 250000)
    write_lake(frame(spark, (1, "a", 1.0)), location, committed_at=at)
    write_lake(frame(spark, (2, "a", 1.0)), location, committed_at=at)
    got = ledger.snapshots(spark, location).orderBy("snapshot_id").collect()
    assert [(r.snapshot_id, r.committed_at, r.operation, len(r.dirs)) for r in got] == [
        (1, at, "append", 1),
        (2, at, "append", 2),
    ]
    # Folders carry the time of the write, not the time the snapshot was given.
    assert all(ledger.commit_time(d) > datetime(2025, 1, 1) for d in got[1].dirs)


def test_nested_types(spark, location):
    nested = spark.range(2).select(
        "id", F.array(F.lit(1)).alias("list"), F.struct(F.lit("x").alias("a")).alias("pair")
    )
    write_lake(nested, location)
    write_lake(read_lake(spark, location), location)
    merge_lake(nested, location, ["id"])
    assert read_lake(spark, location).count() == 2


def test_odd_column_names(spark, location):
    frame = spark.createDataFrame([(1, 2)], "`a.b` int, `c d` int")
    write_lake(frame.withColumnRenamed("c d", "c-d"), location)
    write_lake(frame.withColumnRenamed("c d", "c-d"), location)
    assert rows(read_lake(spark, location)) == [(1, 2), (1, 2)]


def test_create_if_missing(spark, location):
    columns = [("id", "bigint"), ("day", "string"), ("amount", "double")]
    assert create_lake_table(spark, location, columns, partition_by=["day"])
    assert rows(read_lake(spark, location)) == []
    write_lake(frame(spark, (1, "a", 1.0)), location)
    assert not create_lake_table(spark, location, columns)
    assert rows(read_lake(spark, location)) == [(1, "a", 1.0)]
    assert ledger.latest(spark, location).partition_by == ("day",)
    merge_lake(frame(spark, (1, "b", 2.0)), location, ["id"])
    assert rows(read_lake(spark, location)) == [(1, "b", 2.0)]


def test_merge_into_an_empty_table(spark, location):
    create_lake_table(spark, location, [("id", "bigint"), ("day", "string"), ("amount", "double")])
    merge_lake(frame(spark, (1, "a", 1.0)), location, ["id"])
    assert rows(read_lake(spark, location)) == [(1, "a", 1.0)]


def test_evolve(spark, location):
    write_lake(frame(spark, (1, "a", 1.0)), location)
    evolve_lake(spark, location, StructType.fromDDL("note string"))
    write_lake(frame(spark, (2, "b", 2.0)).withColumn("note", F.lit("new")), location)
    assert rows(read_lake(spark, location)) == [(1, "a", 1.0, None), (2, "b", 2.0, "new")]
    with pytest.raises(ValueError, match="already in the table"):
        evolve_lake(spark, location, StructType.fromDDL("note string"))


# Upsert


def test_merge_updates_and_inserts(spark, location):
    write_lake(frame(spark, (1, "a", 1.0), (2, "b", 2.0)), location)
    merge_lake(frame(spark, (2, "b", 20.0), (3, "c", 30.0)), location, ["id"])
    assert rows(read_lake(spark, location)) == [(1, "a", 1.0), (2, "b", 20.0), (3, "c", 30.0)]


def test_merge_into_nothing_creates(spark, location):
    merge_lake(frame(spark, (1, "a", 1.0)), location, ["id"])
    assert rows(read_lake(spark, location)) == [(1, "a", 1.0)]


def test_first_merge_rejects_repeated_keys(spark, location):
    with pytest.raises(DuplicateKeyError):
        merge_lake(frame(spark, (1, "b", 1.0), (1, "c", 1.0)), location, ["id"])
    assert ledger.snapshot_ids(spark, location) == []


def test_merge_null_keys_match_nothing(spark, location):
    write_lake(frame(spark, (None, "old", 1.0)), location)
    merge_lake(frame(spark, (None, "x", 2.0), (None, "y", 3.0)), location, ["id"])
    assert rows(read_lake(spark, location)) == [
        (None, "old", 1.0),
        (None, "x", 2.0),
        (None, "y", 3.0),
    ]


def test_merge_rejects_repeated_keys(spark, location):
    write_lake(frame(spark, (1, "a", 1.0)), location)
    with pytest.raises(DuplicateKeyError):
        merge_lake(frame(spark, (1, "b", 1.0), (1, "c", 1.0)), location, ["id"])
    assert rows(read_lake(spark, location)) == [(1, "a", 1.0)]


def test_merge_of_new_keys_rewrites_nothing(spark, location):
    write_lake(frame(spark, (1, "a", 1.0)), location)
    before = ledger.latest(spark, location).dirs
    merge_lake(frame(spark, (2, "b", 2.0)), location, ["id"])
    assert set(before) < set(ledger.latest(spark, location).dirs)
    assert rows(read_lake(spark, location)) == [(1, "a", 1.0), (2, "b", 2.0)]


def test_merge_moves_rows_between_partitions(spark, location):
    write_lake(frame(spark, (1, "a", 1.0), (2, "b", 2.0)), location, partition_by=["day"])
    merge_lake(frame(spark, (1, "b", 10.0)), location, ["id"])
    assert rows(read_lake(spark, location)) == [(1, "b", 10.0), (2, "b", 2.0)]


def test_merge_rewrites_only_folders_with_matches(spark, location):
    odd = ["a+b", "10:00", "x y", None]
    write_lake(
        frame(spark, *[(i, d, 0.0) for i, d in enumerate(odd)]), location, partition_by=["day"]
    )
    before = set(ledger.latest(spark, location).dirs)
    merge_lake(frame(spark, (0, "a+b", 1.0), (3, None, 1.0)), location, ["id"])
    after = set(ledger.latest(spark, location).dirs)
    assert len(before & after) == 2
    assert {r["id"]: r["amount"] for r in read_lake(spark, location).collect()} == {
        0: 1.0,
        1: 0.0,
        2: 0.0,
        3: 1.0,
    }


def test_merge_keeps_newer_rows(spark, location):
    write_lake(frame(spark, (1, "a", 5.0), (2, "b", 5.0), (3, "c", None)), location)
    changes = frame(spark, (1, "old", 4.0), (2, "new", 5.0), (3, "known", 1.0), (4, "added", 0.0))
    merge_lake(changes, location, ["id"], newer_by="amount")
    assert rows(read_lake(spark, location)) == [
        (1, "a", 5.0),
        (2, "new", 5.0),
        (3, "known", 1.0),
        (4, "added", 0.0),
    ]


def test_merge_from_the_table_itself(spark, location):
    write_lake(frame(spark, (1, "a", 1.0), (2, "b", 2.0)), location)
    doubled = read_lake(spark, location).withColumn("amount", F.col("amount") * 2)
    merge_lake(doubled, location, ["id"])
    assert rows(read_lake(spark, location)) == [(1, "a", 2.0), (2, "b", 4.0)]


def test_merge_source_is_evaluated_once(spark, location):
    write_lake(frame(spark, (1, "a", 1.0)), location)
    source = spark.range(50).select(
        "id", F.uuid().alias("day"), F.rand().alias("amount")
    )
    merge_lake(source, location, ["id"])
    assert read_lake(spark, location).count() == 50


keyed = st.dictionaries(st.integers(0, 8), st.sampled_from("abc"), max_size=6)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=keyed, source=keyed)
def test_merge_twice_is_merge_once(spark, tmp_path_factory, target, source):
    location = f"file:{tmp_path_factory.mktemp('merge')}/table"
    write_lake(
        frame(spark, *[(k, d, 0.0) for k, d in target.items()]), location, partition_by=["day"]
    )
    change = frame(spark, *[(k, d, 1.0) for k, d in source.items()])
    expected = {k: (d, 0.0) for k, d in target.items()} | {k: (d, 1.0) for k, d in source.items()}
    for _ in range(2):
        merge_lake(change, location, ["id"])
        got = {r["id"]: (r["day"], r["amount"]) for r in read_lake(spark, location).collect()}
        assert got == expected


# Layout


def part_files(location):
    return sorted(glob.glob(f"{location.removeprefix('file:')}/data/**/*.parquet", recursive=True))


def test_sorted_partitions(spark, location):
    df = spark.range(1000).select(
        "id",
        (F.col("id") % 3).cast("string").alias("day"),
        (-F.col("id")).cast("double").alias("amount"),
    )
    write_lake(df, location, partition_by=["day"], sort_by=["amount"])
    assert rows(read_lake(spark, location)) == rows(df)
    for path in part_files(location):
        values = [r[0] for r in spark.read.parquet(path).select("amount").collect()]
        assert values == sorted(values)


def test_global_sort_gives_disjoint_files(spark, location):
    df = spark.range(0, 4000, 1, 8).select(F.hash("id").alias("v"), "id")
    with_conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for key, value in with_conf.items():
        spark.conf.set(key, value)
    try:
        write_lake(df, location, sort_by=["v"])
    finally:
        for key in with_conf:
            spark.conf.set(key, "true")
    ranges = []
    for path in part_files(location):
        values = [r[0] for r in spark.read.parquet(path).select("v").collect()]
        assert values == sorted(values)
        if values:
            ranges.append((values[0], values[-1]))
    ranges.sort()
    assert len(ranges) > 1
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


def test_one_hot_sort_value_is_spread(spark, location):
    df = spark.range(0, 40000, 1, 8).select(F.lit(1).alias("v"), F.lit("same").alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_lake(df, location, sort_by=["v"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [spark.read.parquet(path).count() for path in part_files(location)]
    assert sum(sizes) == 40000
    assert max(sizes) <= 20000


def test_null_times_are_oldest_and_ties_go_by_the_next_column(spark, location):
    schema = "id int, at timestamp_ntz, v int"
    at = datetime(2024, 1, 1)
    write_lake(spark.createDataFrame([(1, at, 5), (2, at, 5), (3, None, 5)], schema), location)
    changes = [(1, None, 9), (2, at, 4), (3, at, 1)]
    merge_lake(spark.createDataFrame(changes, schema), location, ["id"], newer_by=["at", "v"])
    assert rows(read_lake(spark, location)) == [(1, at, 5), (2, at, 5), (3, at, 1)]


def test_one_of_many_writers_of_a_line_is_told_so(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from stratalake import files

    def write(n):
        try:
            files.write_text_once(spark, path, f"writer {n}")
        except FileExistsError:
            return None
        return f"writer {n}"

    for attempt in range(5):
        path = f"file:{tmp_path}/ledger/{attempt}.json"
        with ThreadPoolExecutor(8) as pool:
            told = [x for x in pool.map(write, range(8)) if x]
        assert told == [files.read_text(spark, path)]
    assert not [n for n in files.children(spark, f"file:{tmp_path}/ledger", directories=False) if "pending" in n]


def test_tables_are_in_the_catalog(spark, lake):
    lake.create_databases(spark)
    name = lake.table("refined", "things")
    frame = spark.createDataFrame([(1, "a", "x"), (2, None, "y"), (3, "it's", None)], "id int, part string, v string")
    write_lake(frame, name, partition_by=["part"])
    assert rows(spark.table(name)) == rows(frame)
    write_lake(frame.where("id = 1"), name, "overwrite_partitions")
    evolve_lake(spark, name, StructType.fromDDL("more int"))
    merge_lake(frame.where("id = 3").withColumn("v", F.lit("new")), name, ["id"])
    compact_lake(spark, name)
    assert rows(spark.sql(f"SELECT * FROM {name}")) == rows(read_lake(spark, name))
    assert spark.table(name).columns == ["id", "part", "v", "more"]
    assert "things" in [t.name for t in spark.catalog.listTables(lake.database("refined"))]
    spark.sql(f"CREATE VIEW {lake.table('curated', 'ids')} AS SELECT id FROM {name} WHERE part = 'a'")
    assert rows(spark.table(lake.table("curated", "ids"))) == [(1,)]
    write_lake(frame.select("id"), name, "overwrite", partition_by=[])
    assert rows(spark.table(name)) == [(1,), (2,), (3,)]


def test_other_catalogs_are_refused(spark):
    with pytest.raises(ValueError, match="session catalog"):
        read_lake(spark, "elsewhere.db.t")


@pytest.mark.parametrize("stretch", [2, 3, 1000])
def test_rows_out_of_order_are_found_across_stretches(spark, location, monkeypatch, stretch):
    monkeypatch.setattr(registry, "CHECKED_ROWS", stretch)
    values = {"a": [9, 8, 7, 7, 6, 5, 1], "b": [1, 2, 2, 5, 4, 6, 3, 3]}
    for key, found in values.items():
        rows_ = spark.createDataFrame([(key, v) for v in found], "k string, v int").coalesce(1)
        rows_.write.mode("append").parquet(location)
    got = registry.out_of_order(spark.read.parquet(location), "k", "v", 3)
    assert rows(got) == [("a", 7, 5, 1, 9), ("b", 8, 2, 1, 6)]
