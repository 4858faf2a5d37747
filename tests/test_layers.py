"""The chain raw → refined → curated."""

from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from stratalake import catalog, files, read_lake, register_raw, write_raw
from stratalake.operators import DataQualityError
from stratalake.plans.layers import (
    DELIVERY,
    RAW_EVENTS,
    RAW_PARTITIONS,
    as_raw,
    land,
    load_delivery,
    raw_to_curated,
    tables_of,
)
from stratalake.plans.maintenance import expire_lake
from stratalake.sources import lake_exists

RAW = "event_id string, payload string, created_at timestamp_ntz, dt string"


def event(number, payload, day=1, hour=0):
    return (number, payload, datetime(2024, 1, day, hour), f"2024-01-{day:02}")


def payload(value, kind="click"):
    return f'{{"user_id": 1, "event_type": "{kind}", "value": {value}, "props": "{{}}"}}'


def test_bad_rows_are_set_apart(spark, lake):
    raw = spark.createDataFrame(
        [
            event("1", payload(1.5)),
            event("1", payload(2.5), hour=3),
            event("2", payload('"much"')),
            event("3", "{broken"),
            event("x", payload(1)),
            event(None, payload(1)),
            event("4", payload(4, kind="  ")),
            event("5", payload(7, kind=" view "), day=2),
        ],
        RAW,
    )
    summary = raw_to_curated(spark, raw, lake)
    tables = tables_of(lake)
    assert rows(summary) == [
        (date(2024, 1, 1), Decimal("2.50"), 1),
        (date(2024, 1, 2), Decimal("7.00"), 1),
    ]
    refined = read_lake(spark, tables.refined)
    assert dict(refined.dtypes)["value"] == "decimal(18,2)"
    assert rows(refined.select("event_id", "event_type")) == [(1, "click"), (5, "view")]
    rejected = read_lake(spark, tables.rejects).select("event_id", "failed_columns")
    assert rows(rejected) == [
        ("2", "value"),
        ("3", "payload,event_type"),
        ("4", "event_type"),
        ("x", "event_id"),
        (None, "event_id"),
    ]
    assert spark.table(tables.raw).count() == 8


def test_no_rejects_no_reject_table(spark, lake):
    raw = spark.createDataFrame([event("1", payload(1))], RAW)
    raw_to_curated(spark, raw, lake)
    assert not lake_exists(spark, tables_of(lake).rejects)


def test_nothing_usable_stops_the_chain(spark, lake):
    raw = spark.createDataFrame([event("1", "{broken")], RAW)
    with pytest.raises(DataQualityError, match="row_count_min"):
        raw_to_curated(spark, raw, lake)
    assert not lake_exists(spark, tables_of(lake).refined)
    assert not lake_exists(spark, tables_of(lake).curated)
    rejects = read_lake(spark, tables_of(lake).rejects)
    assert rows(rejects.select("event_id", "failed_columns")) == [("1", "payload,event_type")]


def test_as_raw(spark):
    events = spark.createDataFrame(
        [(1, datetime(2024, 1, 3, 4), 9, "click", 1.25, '{"k": 1}')],
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string",
    )
    row = as_raw(events).first()
    assert row["dt"] == "2024-01-03" and row["event_id"] == "1"
    assert row["payload"] == (
        '{"user_id":9,"event_type":"click","value":1.25,"props":"{\\"k\\": 1}"}'
    )


def test_a_rerun_changes_nothing(spark, lake):
    raw = spark.createDataFrame([event("1", payload(1)), event("2", "{broken"), event("3", payload(3), day=2)], RAW)
    first = rows(raw_to_curated(spark, raw, lake))
    assert rows(raw_to_curated(spark, raw, lake)) == first
    tables = tables_of(lake)
    assert spark.table(tables.raw).count() == 3
    assert read_lake(spark, tables.rejects).count() == 1


def test_landing_again_replaces_that_delivery_alone(spark, lake):
    lake.create_databases(spark)
    one = spark.createDataFrame([event("1", payload(1)), event("2", payload(2), day=2)], RAW)
    two = spark.createDataFrame([event("3", payload(3))], RAW)
    land(spark, one, lake, "one=1/x")
    land(spark, two, lake, "two")
    raw = land(spark, one.where("dt = '2024-01-01'"), lake, "one=1/x")
    assert rows(raw.select("event_id", "delivery")) == [("1", "one=1/x"), ("3", "two")]


def test_deliveries_give_what_the_whole_gives(spark, lake, tmp_path):
    versions = [event("1", payload(9)), event("1", payload(5)), event("1", payload(7)), event("2", payload(2))]
    for part in (versions[:2], versions[2:]):
        load_delivery(spark, spark.createDataFrame(part, RAW), lake)
    refined = read_lake(spark, tables_of(lake).refined)
    assert rows(refined.select("event_id", "value")) == [(1, Decimal("9.00")), (2, Decimal("2.00"))]


def test_a_named_delivery_counts_once(spark, lake):
    part = spark.createDataFrame([event("1", payload(1)), event("2", "{broken")], RAW)
    for _ in range(2):
        summary = load_delivery(spark, part, lake, "monday")
    assert rows(summary) == [(date(2024, 1, 1), Decimal("1.00"), 1)]
    tables = tables_of(lake)
    assert read_lake(spark, tables.deliveries).count() == 2
    assert read_lake(spark, tables.rejects).count() == 1


def test_every_delivery_is_audited(spark, lake, monkeypatch):
    from stratalake.plans import layers

    load_delivery(spark, spark.createDataFrame([event("1", payload(1))], RAW), lake)
    seen = []
    checks = layers.merged_checks
    monkeypatch.setattr(layers, "merged_checks", lambda df: seen.append(1) or checks(df))
    load_delivery(spark, spark.createDataFrame([event("2", payload(2))], RAW), lake)
    assert seen


def test_deliveries_go_on_after_their_history_expired(spark, lake):
    tables = tables_of(lake)
    for number in (1, 2):
        part = spark.createDataFrame([event(str(number), payload(number)), event("x", "{")], RAW)
        load_delivery(spark, part, lake)
    write = spark.createDataFrame([event("3", payload(3))], RAW)
    from stratalake import write_lake

    write_lake(write, tables.deliveries)
    write_lake(write, tables.deliveries)
    expire_lake(spark, tables.deliveries, as_of=datetime(2100, 1, 1), keep=1, dry_run=False)
    summary = load_delivery(spark, spark.createDataFrame([event("4", payload(4))], RAW), lake)
    assert rows(summary) == [(date(2024, 1, 1), Decimal("10.00"), 4)]
    assert read_lake(spark, tables.rejects).count() == 2


def test_rejects_are_kept_by_the_run_after_one_that_died_before_them(spark, lake, monkeypatch):
    from stratalake.plans import layers

    tables = tables_of(lake)
    load_delivery(spark, spark.createDataFrame([event("1", payload(1))], RAW), lake)
    assert read_lake(spark, tables.rejects).count() == 0
    write = layers.write_lake

    def dies(df, table, *args, **kwargs):
        if table == tables.rejects:
            raise OSError("gone")
        return write(df, table, *args, **kwargs)

    monkeypatch.setattr(layers, "write_lake", dies)
    with pytest.raises(OSError):
        load_delivery(spark, spark.createDataFrame([event("2", payload(2)), event("x", "{")], RAW), lake)
    monkeypatch.undo()
    assert read_lake(spark, tables.refined).count() == 2 and read_lake(spark, tables.rejects).count() == 0
    summary = load_delivery(spark, spark.createDataFrame([event("3", payload(3)), event("y", "{")], RAW), lake)
    assert rows(summary) == [(date(2024, 1, 1), Decimal("6.00"), 3)]
    assert rows(read_lake(spark, tables.rejects).select("event_id")) == [("x",), ("y",)]


def test_deliveries_without_rejects_are_parsed_once(spark, lake, tmp_path):
    load_delivery(spark, spark.createDataFrame([event("1", payload(1)), event("x", "{")], RAW), lake)
    parsed = spark.sparkContext.accumulator(0)

    def watched(batches):
        for batch in batches:
            parsed.add(batch.num_rows)
            yield batch

    from stratalake.plans import layers

    check, layers.check_raw = layers.check_raw, lambda raw: check(raw.mapInArrow(watched, raw.schema))
    try:
        load_delivery(spark, spark.createDataFrame([event("2", payload(2)), event("3", payload(3))], RAW), lake)
        assert parsed.value == 2
        load_delivery(spark, spark.createDataFrame([event("4", payload(4)), event("z", "{")], RAW), lake)
        assert parsed.value == 2 + 4
    finally:
        layers.check_raw = check
    assert read_lake(spark, tables_of(lake).rejects).count() == 2


# Landing


def landed_folders(lake):
    root = lake.location("raw", "raw_events").removeprefix("file:")
    return sorted(p.parent.parent.name for p in Path(root).rglob("*.parquet") if "_temporary" not in str(p))


def dying(df):
    """A write of these rows fails after some have been written."""
    late = F.when(F.col("event_id") == "2", F.raise_error(F.lit("dies here"))).otherwise(F.col("payload"))
    return df.withColumn("payload", late.cast("string"))


def test_a_landing_that_dies_leaves_the_rows_of_the_one_before(spark, lake):
    lake.create_databases(spark)
    raw = spark.createDataFrame([event("1", payload(1)), event("2", payload(2), day=2)], RAW)
    table = tables_of(lake).raw
    before = rows(land(spark, raw, lake, "d"))
    with pytest.raises(Exception, match="dies here"):
        land(spark, dying(raw), lake, "d")
    assert rows(spark.table(table)) == before
    changed = raw.withColumn("payload", F.lit("new"))
    land(spark, changed, lake, "d")
    assert {r.payload for r in spark.table(table).collect()} == {"new"}
    assert len(set(landed_folders(lake))) == 1  # what the dead run left is gone too


@pytest.mark.parametrize("step", ["move_partition", "add_partitions", "drop_partitions"])
def test_a_landing_that_dies_between_writing_and_turning(spark, lake, monkeypatch, step):
    lake.create_databases(spark)
    first = spark.createDataFrame([event("1", payload(1)), event("2", payload(2), day=2)], RAW)
    second = spark.createDataFrame([event("1", payload(8)), event("3", payload(9), day=3)], RAW)
    table = tables_of(lake).raw
    land(spark, first, lake, "d")
    land(spark, first.where("event_id = '1'"), lake, "other")

    def dies(*_):
        raise RuntimeError("dies here")

    with monkeypatch.context() as patch:
        patch.setattr(catalog, step, dies)
        with pytest.raises(RuntimeError, match="dies here"):
            land(spark, second, lake, "d")
    # Every day has all rows of the one landing or all of the other.
    left = {r.event_id: r.payload for r in spark.table(table).where("delivery = 'd'").collect()}
    assert left["1"] in (payload(1), payload(8)) and left["2"] == payload(2)
    land(spark, second, lake, "d")
    got = spark.table(table).select("event_id", "payload", "delivery")
    assert rows(got) == [("1", payload(1), "other"), ("1", payload(8), "d"), ("3", payload(9), "d")]
    assert len(landed_folders(lake)) == 3


def test_old_folders_go_last_and_together(spark, lake, monkeypatch):
    lake.create_databases(spark)
    days = spark.createDataFrame([event(str(n), payload(n), day=n) for n in range(1, 9)], RAW)
    land(spark, days, lake, "d")
    calls, delete = [], files.delete
    monkeypatch.setattr(files, "delete", lambda *a: calls.append(spark.table(tables_of(lake).raw).count()) or delete(*a))
    land(spark, days.where("event_id < '4'"), lake, "d")
    assert calls == [3]


def test_landing_over_the_standard_layout(spark, lake):
    """Tables that hold their deliveries in folders of partitions."""
    lake.create_databases(spark)
    location, table = lake.location("raw", "raw_events"), tables_of(lake).raw
    raw = spark.createDataFrame([event("1", payload(1)), event("2", payload(2), day=2)], RAW)
    for name in ("x", "y"):
        write_raw(raw.withColumn("delivery", F.lit(name)), location, partition_by=["dt", "delivery"])
    keys = [*RAW_PARTITIONS, DELIVERY]
    assert register_raw(spark, table, RAW_EVENTS, location=location, partition_by=keys).count() == 4
    got = land(spark, raw.where("event_id = '2'"), lake, "x").select("event_id", "delivery")
    assert rows(got) == [("1", "y"), ("2", "x"), ("2", "y")]
    assert [f for f in landed_folders(lake) if f.startswith("dt=")] == ["dt=2024-01-01", "dt=2024-01-02"]


def test_a_catalog_that_lost_the_table_gets_it_from_the_folders(spark, lake):
    lake.create_databases(spark)
    table = tables_of(lake).raw
    odd = spark.createDataFrame([("1", "p", datetime(2024, 1, 1), None), event("2", payload(2))], RAW)
    land(spark, odd, lake, "a=b/c d")
    land(spark, odd, lake, "a=b/c d")
    with pytest.raises(Exception, match="dies here"):
        land(spark, dying(odd), lake, "a=b/c d")
    before = rows(spark.table(table))
    spark.sql(f"DROP TABLE {table}")
    got = land(spark, odd.where("event_id = '2'"), lake, "z")
    assert rows(got.where("delivery <> 'z'")) == before and got.count() == 3


def test_an_empty_landing(spark, lake):
    lake.create_databases(spark)
    raw = spark.createDataFrame([event("1", payload(1))], RAW)
    land(spark, raw, lake, "d")
    assert land(spark, raw.limit(0), lake, "d").count() == 0
