"""Columns of lake tables renamed, dropped, widened and added."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratalake import alter_lake, evolve_lake, ledger, merge_lake, read_lake, write_lake
from stratalake.plans.maintenance import compact_lake
from stratalake.sinks.lake import WIDER

SCHEMA = "id int, name string, day string"


def frame(spark, schema, *values):
    return spark.createDataFrame(list(values), schema)


def test_rename(spark, lake):
    lake.create_databases(spark)
    table = lake.table("refined", "t")
    first = write_lake(frame(spark, SCHEMA, (1, "a", "x")), table, partition_by=["day"], sort_by=["name"])
    alter_lake(spark, table, rename={"name": "title"})
    renamed = "id int, title string, day string"
    write_lake(frame(spark, renamed, (2, "b", "x")), table)
    merge_lake(frame(spark, renamed, (1, "c", "y"), (3, "d", "x")), table, ["id"])
    compact_lake(spark, table)
    want = [(1, "c", "y"), (2, "b", "x"), (3, "d", "x")]
    assert rows(read_lake(spark, table)) == want == rows(spark.table(table))
    assert read_lake(spark, table).columns == ["id", "title", "day"]
    assert rows(read_lake(spark, table).where("title = 'b'")) == want[1:2]
    assert ledger.latest(spark, lake.location("refined", "t")).sort_by == ("title",)
    assert read_lake(spark, table, snapshot_id=first).columns == ["id", "name", "day"]
    assert rows(read_lake(spark, table, snapshot_id=first)) == [(1, "a", "x")]
    with pytest.raises(ValueError, match="not in the table"):
        write_lake(frame(spark, SCHEMA, (1, "a", "x")), table)


def test_names_can_change_places(spark, location):
    write_lake(frame(spark, "a int, b int, `c.d` int", (1, 2, 3)), location)
    alter_lake(spark, location, rename={"a": "b", "b": "a"})
    write_lake(frame(spark, "a int, b int, `c.d` int", (20, 10, 30)), location)
    alter_lake(spark, location, rename={"a": "c.d", "c.d": "a"})
    read = read_lake(spark, location)
    assert read.columns == ["b", "c.d", "a"] and rows(read) == [(1, 2, 3), (10, 20, 30)]


def test_a_dropped_column_does_not_come_back(spark, lake):
    lake.create_databases(spark)
    table = lake.table("refined", "t")
    write_lake(frame(spark, SCHEMA, (1, "a", "x")), table)
    alter_lake(spark, table, drop=["name"])
    assert rows(read_lake(spark, table)) == [(1, "x")] == rows(spark.table(table))
    evolve_lake(spark, table, StructType.fromDDL("name string"))
    assert rows(read_lake(spark, table)) == [(1, "x", None)] == rows(spark.table(table))
    write_lake(frame(spark, SCHEMA, (2, "b", "y")), table)
    alter_lake(spark, table, drop=["name"], add=StructType.fromDDL("name int, more int"))
    write_lake(frame(spark, "id int, day string, name int, more int", (3, "z", 7, 8)), table)
    compact_lake(spark, table)
    want = [(1, "x", None, None), (2, "y", None, None), (3, "z", 7, 8)]
    assert rows(read_lake(spark, table)) == want == rows(spark.table(table))
    # A name that a column had before it was renamed is free again, but not in the files.
    alter_lake(spark, table, rename={"day": "when"}, add=StructType.fromDDL("day string"))
    assert rows(read_lake(spark, table).select("when", "day")) == [("x", None), ("y", None), ("z", None)]
    assert rows(spark.table(table)) == rows(read_lake(spark, table))


WIDENED = {
    "tinyint": 12, "smallint": -300, "int": 2**31 - 1, "float": 1.5, "date": date(2024, 2, 29),
}


@pytest.mark.parametrize("vectorized", ["true", "false"])
@pytest.mark.parametrize("old,new", [(o, n) for o in WIDER for n in WIDER[o]] + [("decimal(9,2)", "decimal(12,2)"), ("decimal(9,2)", "decimal(20,4)")])
def test_widen(spark, location, old, new, vectorized):
    value = WIDENED.get(old, Decimal("1234567.89"))
    write_lake(frame(spark, f"k int, v {old}", (1, value), (2, None)), location)
    alter_lake(spark, location, widen={"v": new})
    cast = frame(spark, f"v {old}", (value,)).select(F.col("v").cast(new)).first()[0]
    more = {"bigint": 2**40, "double": 1e300, "timestamp_ntz": datetime(2024, 1, 1, 5)}.get(new, cast)
    write_lake(frame(spark, f"k int, v {new}", (3, more)), location)
    spark.conf.set("spark.sql.parquet.enableVectorizedReader", vectorized)
    try:
        read = read_lake(spark, location)
        assert dict(read.dtypes)["v"] == new
        assert rows(read) == sorted([(1, cast), (2, None), (3, more)], key=repr)
        assert read.where(F.col("v") == F.lit(cast).cast(new)).where("k = 1").count() == 1
        merge_lake(frame(spark, f"k int, v {new}", (2, more)), location, ["k"])
        assert {r.k: r.v for r in read_lake(spark, location).collect()} == {1: cast, 2: more, 3: more}
    finally:
        spark.conf.set("spark.sql.parquet.enableVectorizedReader", "true")


def test_ranges_of_altered_columns(spark, location):
    write_lake(frame(spark, "k int, v int", (1, 1), (900, 9)), location, range_by="k", ranges=2)
    alter_lake(spark, location, rename={"k": "key"}, widen={"v": "bigint"})
    known = ledger.latest(spark, location).ranges
    assert known.column == "key" and len(known.folders) == 2
    alter_lake(spark, location, widen={"key": "bigint"})
    assert ledger.latest(spark, location).ranges.folders == {}
    merge_lake(frame(spark, "key bigint, v bigint", (900, 2**40), (2**40, 0)), location, ["key"])
    assert rows(read_lake(spark, location)) == [(1, 1), (2**40, 0), (900, 2**40)]
    with pytest.raises(ValueError, match="ranges of key"):
        alter_lake(spark, location, drop=["key"])


def test_what_cannot_change(spark, location):
    write_lake(frame(spark, SCHEMA, (1, "a", "x")), location, partition_by=["day"], sort_by=["name", "id"])
    for change, message in [
        ({"rename": {"none": "x"}}, "not in the table"),
        ({"drop": ["day"]}, "partition columns"),
        ({"rename": {"day": "d"}}, "partition columns"),
        ({"rename": {"id": "name"}}, "already in the table"),
        ({"widen": {"id": "smallint"}}, "no wider type"),
        ({"widen": {"name": "int"}}, "no wider type"),
        ({"drop": ["id"], "rename": {"id": "x"}}, "dropped and changed"),
        ({"add": StructType.fromDDL("name int")}, "already in the table"),
    ]:
        with pytest.raises(ValueError, match=message):
            alter_lake(spark, location, **change)
    assert ledger.snapshot_ids(spark, location) == [1]
    alter_lake(spark, location, drop=["name"])
    assert ledger.latest(spark, location).sort_by == ()
