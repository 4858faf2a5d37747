"""Queries over the test tables, each with the SQL that gives the same rows.

Every query works on whole tables. Those about writing put their table into the shared folder
and return what a reader finds there.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from stratalake import catalog, ledger
from stratalake.catalog import Column
from stratalake.files import children, partition_dirs
from stratalake.functions import day_string, money
from stratalake.layers import Lake
from stratalake.operators import (
    DataQualityError,
    Dimension,
    QualityChecker,
    clean,
    compaction_plan,
    conform_union,
    daily_summary,
    denormalise,
    drop_missing_keys,
    expired_snapshots,
    extract_payload,
    failure_rules,
    match_rules,
    normalise_text,
    orphan_files,
    rejects,
    typed,
    unreachable_files,
    with_expiry,
)
from stratalake.plans.layers import (
    PAYLOAD_FIELDS,
    RAW_EVENTS,
    RAW_PARTITIONS,
    REFINED_TYPES,
    as_raw,
    land,
    load_delivery,
    raw_to_curated,
    tables_of,
)
from stratalake.operators.maintenance import list_files
from stratalake.plans.maintenance import compact_lake, data_files, expire_lake, remove_orphans
from stratalake.session import MIB, scratch_path
from stratalake.sinks import (
    alter_lake,
    create_lake_table,
    evolve_lake,
    insert_raw,
    merge_lake,
    write_lake,
    write_raw,
)
from stratalake.sources import read_lake, read_new, read_raw, register_raw
from stratalake.streaming import forward_alerts, new_rows, run_incremental

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

AS_OF = datetime(2001, 8, 8)


def query(sql: str, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, by default that of the function."""

    def add(run: Query) -> Query:
        key = name or run.__name__
        QUERIES[key] = run
        ORACLES[key] = sql
        return run

    return add


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_lake(spark: SparkSession) -> Lake:
    """A lake of its own, below the shared folder."""
    root = scratch_path(spark, "lake")
    return Lake(
        abbr=f"q-{uuid.uuid4().hex[:12]}",
        country="xx",
        project="checks",
        buckets={layer: f"{root}/{layer}" for layer in ("raw", "refined", "curated")},
    )


def events_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source(spark, sf_dir, "events").withColumn("dt", day_string("ts"))


EVENTS_BY_DAY_SQL = "SELECT *, strftime(ts, '%Y-%m-%d') AS dt FROM events"


# Layers


@query(
    """SELECT CAST(ts AS DATE) AS date,
              CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total_amount,
              count(*) AS total_count
       FROM events GROUP BY 1""",
    name="raw_to_curated",
)
def raw_to_curated_events(spark, sf_dir):
    return raw_to_curated(spark, as_raw(source(spark, sf_dir, "events")), new_lake(spark))


@query(ORACLES["raw_to_curated"])
def raw_to_curated_twice(spark, sf_dir):
    raw, lake = as_raw(source(spark, sf_dir, "events")), new_lake(spark)
    raw_to_curated(spark, raw, lake)
    return raw_to_curated(spark, raw, lake)


def outdated_versions(raw: DataFrame) -> DataFrame:
    """Every event once more with the same time and a lower value, which loses against it."""
    lower = F.regexp_replace("payload", r'"value":(\d)', r'"value":-$1')
    return raw.withColumn("payload", lower)


@query(ORACLES["raw_to_curated"])
def raw_to_curated_by_delivery(spark, sf_dir):
    raw = as_raw(source(spark, sf_dir, "events"))
    lake = new_lake(spark)
    # Two deliveries that share a day, the first one delivered twice, then tied versions that lose.
    noon = "2024-01-16 12:00:00"
    load_delivery(spark, raw.where(f"created_at < '{noon}'"), lake, "first")
    load_delivery(spark, raw.where(f"created_at < '{noon}'"), lake, "first")
    load_delivery(spark, raw.where(f"created_at >= '{noon}'"), lake, "second")
    return load_delivery(spark, outdated_versions(raw), lake, "late")


RAW_EVENTS_SQL = """SELECT CAST(event_id AS VARCHAR) AS event_id, props AS payload,
                           ts AS created_at, strftime(ts, '%Y-%m-%d') AS dt
                    FROM events"""


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("props").alias("payload"),
        F.col("ts").alias("created_at"),
        day_string("ts").alias("dt"),
    )


@query(f"SELECT *, 'monday' AS delivery FROM ({RAW_EVENTS_SQL})")
def landing_that_died(spark, sf_dir):
    """A delivery is landed; landing other rows in its place dies while they are written."""
    lake, rows = new_lake(spark), raw_events(spark, sf_dir)
    lake.create_databases(spark)
    land(spark, rows, lake, "monday")
    last = rows.agg(F.max("created_at")).first()[0]
    died = F.when(F.col("created_at") == F.lit(last), F.raise_error(F.lit("died"))).otherwise(F.lit(""))
    try:
        land(spark, rows.withColumn("payload", died.cast("string")), lake, "monday")
    except Exception as error:  # which class it is depends on where the task died
        if "died" not in str(error):
            raise
    return spark.table(tables_of(lake).raw)


@query(
    f"""SELECT *, 'monday' AS delivery FROM ({RAW_EVENTS_SQL}) WHERE dt >= '2024-01-16'
        UNION ALL SELECT *, 'tuesday' FROM ({RAW_EVENTS_SQL}) WHERE dt < '2024-01-20'"""
)
def landing_again(spark, sf_dir):
    """A delivery is landed again, with days it did not have, with other rows, and without days it had."""
    lake, rows = new_lake(spark), raw_events(spark, sf_dir)
    lake.create_databases(spark)
    land(spark, rows.where("dt < '2024-01-18'").withColumn("payload", F.lit("old")), lake, "monday")
    land(spark, rows.where("dt < '2024-01-20'"), lake, "tuesday")
    return land(spark, rows.where("dt >= '2024-01-16'"), lake, "monday")


# Sources


@query("SELECT * FROM customer")
def scan_table(spark, sf_dir):
    lake = new_lake(spark)
    lake.create_databases(spark)
    name = lake.table("refined", "customer")
    write_lake(source(spark, sf_dir, "customer"), name)
    return read_lake(spark, name)


@query("SELECT * FROM customer")
def scan_table_sql(spark, sf_dir):
    lake = new_lake(spark)
    lake.create_databases(spark)
    name = lake.table("refined", "customer")
    rows = source(spark, sf_dir, "customer")
    write_lake(rows.where("c_nationkey < 12"), name, partition_by=["c_mktsegment"])
    write_lake(rows.where("c_nationkey >= 12"), name)
    return spark.sql(f"SELECT {', '.join(rows.columns)} FROM {name}")


@query(RAW_EVENTS_SQL)
def scan_raw_typed(spark, sf_dir):
    path = scratch_path(spark, "raw-events")
    write_raw(raw_events(spark, sf_dir), path, partition_by=["dt"])
    declared = ", ".join(f"{c.name} {c.type}" for c in [*RAW_EVENTS, *RAW_PARTITIONS])
    return read_raw(spark, path, schema=declared)


@query(RAW_EVENTS_SQL)
def scan_raw_json(spark, sf_dir):
    path = scratch_path(spark, "raw-events-json")
    write_raw(raw_events(spark, sf_dir), path, fmt="json", partition_by=["dt"])
    declared = ", ".join(f"{c.name} {c.type}" for c in [*RAW_EVENTS, *RAW_PARTITIONS])
    return read_raw(spark, path, schema=declared, fmt="json")


@query(f"SELECT *, 'all' AS delivery FROM ({RAW_EVENTS_SQL})")
def scan_external_table(spark, sf_dir):
    lake = new_lake(spark)
    lake.create_databases(spark)
    return land(spark, raw_events(spark, sf_dir), lake)


@query(f"SELECT * FROM ({EVENTS_BY_DAY_SQL}) WHERE dt = '2024-01-03'")
def scan_partition_pruned(spark, sf_dir):
    path = scratch_path(spark, "events")
    write_lake(events_by_day(spark, sf_dir), path, partition_by=["dt"])
    return read_lake(spark, path).where("dt = '2024-01-03'")


@query(f"SELECT * FROM ({EVENTS_BY_DAY_SQL}) WHERE dt IN ('2024-01-03', '2024-01-04')")
def scan_listed_partitions(spark, sf_dir):
    path = scratch_path(spark, "events")
    write_lake(events_by_day(spark, sf_dir), path, partition_by=["dt"])
    return read_lake(spark, path, partitions={"dt": ["2024-01-03", "2024-01-04"]})


@query("SELECT * FROM events")
def incremental_scan(spark, sf_dir):
    events = source(spark, sf_dir, "events")
    root = scratch_path(spark, "incremental")
    arrivals = [F.col("ts") < "2024-01-16", F.col("ts") >= "2024-01-16"]
    for arrival in arrivals:
        write_raw(events.where(arrival), f"{root}/in")
        rows = new_rows(spark, f"{root}/in", events.schema)
        run_incremental(rows, f"{root}/out", f"{root}/checkpoint")
    return read_raw(spark, f"{root}/out", schema=events.schema)


@query(
    """SELECT event_type, strftime(ts, '%Y-%m-%d') AS dt, count(*) AS n,
              max(event_id) AS newest FROM events GROUP BY ALL"""
)
def scan_view(spark, sf_dir):
    lake = new_lake(spark)
    lake.create_databases(spark)
    events, view = lake.table("refined", "events"), lake.table("curated", "by_type_and_day")
    write_lake(events_by_day(spark, sf_dir), events, partition_by=["dt"])
    spark.sql(
        f"""CREATE OR REPLACE VIEW {view} AS
            SELECT event_type, dt, count(*) AS n, max(event_id) AS newest
            FROM {events} GROUP BY event_type, dt"""
    )
    return read_raw(spark, view)


@query("SELECT * FROM events")
def incremental_lake_scan(spark, sf_dir):
    events = source(spark, sf_dir, "events")
    root = scratch_path(spark, "incremental")
    for arrival in (F.col("ts") < "2024-01-16", F.col("ts") >= "2024-01-16"):
        write_lake(events.where(arrival), f"{root}/in")
        new = read_new(spark, f"{root}/in", f"{root}/out")
        write_lake(new.rows, f"{root}/out", new.mode, bookmark=new.bookmark)
    return read_lake(spark, f"{root}/out")


# Writes


@query("SELECT * FROM orders")
def append(spark, sf_dir):
    orders = source(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders")
    for status in ("F", "O", "P"):
        write_lake(orders.where(F.col("o_orderstatus") == status), path, "append")
    return read_lake(spark, path)


@query("SELECT * FROM orders")
def read_older_snapshot(spark, sf_dir):
    orders = source(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders")
    first = write_lake(orders, path)
    write_lake(orders.where("o_orderstatus = 'O'"), path)
    write_lake(orders.where("o_orderstatus <> 'O'"), path, "overwrite")
    return read_lake(spark, path, snapshot_id=first)


@query(EVENTS_BY_DAY_SQL)
def append_registered(spark, sf_dir):
    events = events_by_day(spark, sf_dir)
    lake = new_lake(spark)
    lake.create_databases(spark)
    name = lake.table("raw", "events")
    types = [Column(field, kind) for field, kind in events.dtypes]
    catalog.create_external_table(
        spark,
        name,
        types[:-1],
        location=lake.location("raw", "events"),
        partition_by=types[-1:],
    )
    clicks = F.col("event_type") == "click"
    for part in (clicks, ~clicks):
        insert_raw(events.where(part), name)
    return spark.table(name)


@query("SELECT * FROM orders")
def overwrite(spark, sf_dir):
    orders = source(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders")
    write_lake(changed_orders(orders), path)
    write_lake(orders, path, "overwrite")
    return read_lake(spark, path)


ONE_DAY_REPLACED_SQL = f"""SELECT * FROM ({EVENTS_BY_DAY_SQL})
                           WHERE dt <> '2024-01-03' OR event_type = 'purchase'"""


def purchases_of_one_day(events: DataFrame) -> DataFrame:
    return events.where("dt = '2024-01-03' AND event_type = 'purchase'")


@query(ONE_DAY_REPLACED_SQL)
def overwrite_partitions(spark, sf_dir):
    events = events_by_day(spark, sf_dir)
    path = scratch_path(spark, "events")
    write_lake(events, path, partition_by=["dt"])
    write_lake(purchases_of_one_day(events), path, "overwrite_partitions")
    return read_lake(spark, path)


@query(ONE_DAY_REPLACED_SQL)
def overwrite_raw_partitions(spark, sf_dir):
    events = events_by_day(spark, sf_dir)
    path = scratch_path(spark, "events")
    write_raw(events, path, partition_by=["dt"])
    day = purchases_of_one_day(events)
    write_raw(day, path, mode="overwrite_partitions", partition_by=["dt"])
    return read_raw(spark, path, schema=events.schema)


# Rows of a file that are looked at together, and those that a task looks at, about.
CHECKED_ROWS = 2**15
TASK_ROWS = 2**19


def out_of_order(table: DataFrame, key: str, column: str, tasks: int) -> DataFrame:
    """Per key: its rows, those that come after a later one in their file, the first and last value.

    Files are cut into stretches of ``CHECKED_ROWS``, each with the row before it, and the stretches
    are dealt over the tasks, so that no task sorts more as the table grows.
    """
    rows = table.select(
        key,
        column,
        # In place of the path, which is longer than all the rest.
        F.unhex(F.md5("_metadata.file_path")).alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.row_index").alias("at"),
    )
    own = F.floor(F.col("at") / CHECKED_ROWS)
    last = (F.col("at") + 1) % CHECKED_ROWS == 0
    dealt = rows.withColumn("stretch", F.explode(F.when(last, F.array(own, own + 1)).otherwise(F.array(own))))
    dealt = dealt.repartition(tasks, "file", "block", "stretch")
    place = Window.partitionBy("file", "block", "stretch").orderBy("at")
    return (
        dealt.withColumn("back", F.col(column) < F.lag(column).over(place))
        .where(F.col("stretch") == own)
        .groupBy(key)
        .agg(
            F.count("*").alias("n"),
            F.count_if("back").cast("int").alias("out_of_order"),
            F.min(column).alias("first"),
            F.max(column).alias("last"),
        )
    )


@query(
    """SELECT l_returnflag, count(*) AS n, 0 AS out_of_order,
              min(l_shipdate) AS first, max(l_shipdate) AS last
       FROM lineitem GROUP BY l_returnflag"""
)
def write_sorted(spark, sf_dir):
    lineitem, path = source(spark, sf_dir, "lineitem"), scratch_path(spark, "lineitem")
    keys, order = ["l_returnflag"], ["l_shipdate"]
    write_lake(lineitem.where("l_linenumber < 3"), path, partition_by=keys, sort_by=order)
    write_lake(lineitem.where("l_linenumber >= 3"), path)  # by the order the table has
    rows = read_lake(spark, path)
    return out_of_order(rows, "l_returnflag", "l_shipdate", -(-rows.count() // TASK_ROWS) or 1)


MERGED_ORDERS_SQL = """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderstatus = 'O' THEN o_totalprice ELSE o_totalprice + 100 END
           AS o_totalprice,
       o_orderdate, o_orderpriority
FROM orders"""


def changed_orders(orders: DataFrame) -> DataFrame:
    """Orders with a new price: those of status F are in the target, those of status P are not."""
    return orders.where("o_orderstatus <> 'O'").withColumn(
        "o_totalprice", F.col("o_totalprice") + 100
    )


@query(MERGED_ORDERS_SQL)
def merge_upsert(spark, sf_dir):
    orders = source(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders")
    write_lake(orders.where("o_orderstatus <> 'P'"), path)
    merge_lake(changed_orders(orders), path, ["o_orderkey"])
    return read_lake(spark, path)


@query(MERGED_ORDERS_SQL)
def merge_into_partitions(spark, sf_dir):
    orders = source(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders")
    write_lake(orders.where("o_orderstatus <> 'P'"), path, partition_by=["o_orderstatus"])
    merge_lake(changed_orders(orders), path, ["o_orderkey"])
    return read_lake(spark, path)


@query(
    f"""SELECT *, true AS few_rewritten FROM ({MERGED_ORDERS_SQL}) WHERE o_orderkey IN (SELECT max(o_orderkey) FROM orders WHERE o_orderstatus <> 'O')
        UNION ALL SELECT *, true FROM orders
        WHERE o_orderkey NOT IN (SELECT max(o_orderkey) FROM orders WHERE o_orderstatus <> 'O')"""
)
def merge_into_ranges(spark, sf_dir):
    """An upsert of one key into a table without partitions, in a hundred ranges of the key."""
    orders, path = source(spark, sf_dir, "orders"), scratch_path(spark, "orders")
    write_lake(orders, path, range_by="o_orderkey", ranges=100)
    before = set(ledger.latest(spark, path).dirs)
    changed = changed_orders(orders)
    last = changed.agg(F.max("o_orderkey")).first()[0]
    merge_lake(changed.where(F.col("o_orderkey") == last), path, ["o_orderkey"])
    gone = before - set(ledger.latest(spark, path).dirs)
    return read_lake(spark, path).withColumn("few_rewritten", F.lit(len(gone) == 1 < len(before)))


@query(
    """SELECT *, true AS refused FROM orders"""
)
def unique_across_deliveries(spark, sf_dir):
    """Deliveries of orders, and one that repeats a key of an earlier one, which is refused."""
    orders, path = source(spark, sf_dir, "orders"), scratch_path(spark, "orders")
    keys = ["o_orderkey"]
    half = orders.agg(F.max("o_orderkey")).first()[0] // 2
    for part in (F.col("o_orderkey") <= half, F.col("o_orderkey") > half):
        write_lake(orders.where(part), path, range_by="o_orderkey", unique_by=keys)
    first = orders.agg(F.min("o_orderkey")).first()[0]
    try:
        write_lake(orders.where(F.col("o_orderkey") == first), path, unique_by=keys)
    except DataQualityError:
        refused = True
    else:
        refused = False
    return read_lake(spark, path).withColumn("refused", F.lit(refused))


# Catalog


@query("SELECT * FROM part")
def create_table_if_not_exists(spark, sf_dir):
    parts = source(spark, sf_dir, "part")
    path = scratch_path(spark, "part")
    columns = [Column(name, kind) for name, kind in parts.dtypes]
    create_lake_table(spark, path, columns, partition_by=["p_brand"])
    write_lake(parts, path)
    create_lake_table(spark, path, columns)
    return read_lake(spark, path)


@query(
    """SELECT s_suppkey AS party_key, s_name AS name, s_nationkey AS nationkey,
              s_acctbal AS acctbal, CAST(NULL AS VARCHAR) AS mktsegment
       FROM supplier
       UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"""
)
def schema_evolve(spark, sf_dir):
    path = scratch_path(spark, "parties")
    suppliers = source(spark, sf_dir, "supplier")
    customers = source(spark, sf_dir, "customer")
    names = ["party_key", "name", "nationkey", "acctbal", "mktsegment"]
    write_lake(suppliers.toDF(*names[:-1]), path)
    evolve_lake(spark, path, StructType.fromDDL("mktsegment string"))
    write_lake(customers.toDF(*names), path)
    return read_lake(spark, path)


@query(
    """SELECT o_orderkey, o_custkey AS customer, o_orderstatus, o_totalprice, o_orderdate,
              o_orderpriority, o_totalprice AS o_custkey
       FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
              o_orderpriority, NULL FROM orders WHERE o_orderstatus <> 'F'"""
)
def rename_column(spark, sf_dir):
    """A column gets another name, and its old name goes to a new column."""
    orders, path = source(spark, sf_dir, "orders"), scratch_path(spark, "orders")
    write_lake(orders.where("o_orderstatus <> 'F'"), path)
    alter_lake(spark, path, rename={"o_custkey": "customer"}, add=StructType.fromDDL("o_custkey double"))
    finished = orders.where("o_orderstatus = 'F'").withColumnRenamed("o_custkey", "customer")
    write_lake(finished.withColumn("o_custkey", F.col("o_totalprice")), path)
    return read_lake(spark, path)


@query(
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority,
              CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS o_totalprice
       FROM orders"""
)
def drop_column(spark, sf_dir):
    """A column is dropped and added again: older rows do not have it."""
    orders, path = source(spark, sf_dir, "orders"), scratch_path(spark, "orders")
    write_lake(orders.where("o_orderstatus <> 'F'"), path, partition_by=["o_orderstatus"])
    alter_lake(spark, path, drop=["o_totalprice"])
    evolve_lake(spark, path, StructType.fromDDL("o_totalprice double"))
    write_lake(orders.where("o_orderstatus = 'F'"), path)
    return read_lake(spark, path)


@query(
    """SELECT l_orderkey, CASE WHEN l_linenumber > 2 THEN l_linenumber * 10000000000
                               ELSE l_linenumber END AS line,
              CAST(CAST(l_quantity AS DECIMAL(9,2)) AS DECIMAL(18,4)) AS quantity
       FROM lineitem"""
)
def widen_column(spark, sf_dir):
    """Columns get wider types, and rows that need them."""
    path = scratch_path(spark, "lineitem")

    def lines(line: str, quantity: str) -> DataFrame:
        return source(spark, sf_dir, "lineitem").select(
            "l_orderkey", F.col("l_linenumber").cast(line).alias("line"), F.col("l_quantity").cast(quantity).alias("quantity")
        )

    write_lake(lines("int", "decimal(9,2)").where("line <= 2"), path)
    alter_lake(spark, path, widen={"line": "bigint", "quantity": "decimal(18,4)"})
    more = lines("bigint", "decimal(9,2)").where("line > 2").withColumn("line", F.col("line") * 10**10)
    write_lake(more.withColumn("quantity", F.col("quantity").cast("decimal(18,4)")), path)
    return read_lake(spark, path)


@query("SELECT *, CAST(NULL AS VARCHAR) AS region_name FROM supplier")
def add_columns(spark, sf_dir):
    suppliers = source(spark, sf_dir, "supplier")
    lake = new_lake(spark)
    lake.create_databases(spark)
    name = lake.table("raw", "supplier")
    columns = [Column(field, kind) for field, kind in suppliers.dtypes]
    register_raw(spark, name, columns, location=lake.location("raw", "supplier"))
    insert_raw(suppliers, name)
    catalog.add_columns(spark, name, [Column("region_name", "string")])
    return spark.table(name)


def registered_events(spark: SparkSession, sf_dir: str) -> str:
    lake = new_lake(spark)
    lake.create_databases(spark)
    land(spark, raw_events(spark, sf_dir), lake)
    return tables_of(lake).raw


@query(
    "SELECT DISTINCT 'dt=' || strftime(ts, '%Y-%m-%d') || '/delivery=all' AS partition FROM events"
)
def list_partitions(spark, sf_dir):
    return spark.sql(f"SHOW PARTITIONS {registered_events(spark, sf_dir)}")


@query(f"SELECT *, 'all' AS delivery FROM ({RAW_EVENTS_SQL}) WHERE dt <> '2024-01-03'")
def drop_partition(spark, sf_dir):
    name = registered_events(spark, sf_dir)
    catalog.drop_partitions(spark, name, [{"dt": "2024-01-03", "delivery": "all"}])
    return spark.table(name)


@query(RAW_EVENTS_SQL)
def add_partition(spark, sf_dir):
    path = scratch_path(spark, "delivered")
    write_raw(raw_events(spark, sf_dir), path, partition_by=["dt"])
    lake = new_lake(spark)
    lake.create_databases(spark)
    name = lake.table("raw", "picked_days")
    register_raw(
        spark,
        name,
        RAW_EVENTS,
        location=lake.location("raw", "picked_days"),
        partition_by=RAW_PARTITIONS,
    )
    found = partition_dirs(spark, path, 1)
    days = [({"dt": d.removeprefix("dt=")}, f"{path}/{d}") for d in found]
    catalog.add_partitions(spark, name, days)
    return spark.table(name)


# Maintenance


@query("SELECT * FROM documents")
def compact(spark, sf_dir):
    documents = source(spark, sf_dir, "documents")
    path = scratch_path(spark, "documents")
    for part in (F.col("lang") == "en", F.col("lang") != "en"):
        write_lake(documents.where(part), path, partition_by=["source"])
    compact_lake(spark, path)
    return read_lake(spark, path)


@query(
    """SELECT *, CAST(1 AS BIGINT) AS snapshots, CAST(1 AS BIGINT) AS commits,
              CAST(1 AS BIGINT) AS files
       FROM orders"""
)
def table_maintenance(spark, sf_dir):
    orders = source(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders")
    days = [datetime(2001, 7, day) for day in (1, 2, 3, 4)]
    write_lake(changed_orders(orders), path, committed_at=days[0])
    write_lake(orders.where("o_orderstatus = 'F'"), path, "overwrite", committed_at=days[1])
    write_lake(orders.where("o_orderstatus <> 'F'"), path, committed_at=days[2])
    compact_lake(spark, path, committed_at=days[3])
    # What a write that died leaves behind: a folder that no snapshot knows.
    orders.write.parquet(f"{path}/data/{ledger.new_commit_dir(datetime(2001, 7, 5))}")
    expire_lake(spark, path, as_of=AS_OF, keep=1, dry_run=False)
    remove_orphans(spark, path, as_of=AS_OF, dry_run=False)
    left = list_files(spark, f"{path}/data").agg(
        F.count_distinct(F.regexp_extract("path", f"({ledger.COMMIT}=[^/]+)", 1)).alias("commits"),
        F.count("*").alias("files"),
    )
    counts = left.first()
    return read_lake(spark, path).withColumns(
        {
            "snapshots": F.lit(ledger.snapshots(spark, path).count()).cast("bigint"),
            "commits": F.lit(counts["commits"]).cast("bigint"),
            "files": F.lit(counts["files"]).cast("bigint"),
        }
    )


@query(
    """SELECT 'documents' AS lake_table, 'source=' || source AS partition,
              CAST(1 AS BIGINT) AS n_files FROM documents GROUP BY source
       UNION ALL SELECT DISTINCT 'orders', '', CAST(1 AS BIGINT) FROM orders"""
)
def compact_file_counts(spark, sf_dir):
    counts = []
    for name, keys in (("documents", ["source"]), ("orders", [])):
        rows = source(spark, sf_dir, name)
        path = scratch_path(spark, name)
        for part in range(3):
            write_lake(rows.where(F.pmod(F.xxhash64(*rows.columns), F.lit(3)) == part), path, partition_by=keys)
        compact_lake(spark, path)
        files = data_files(spark, path).groupBy("partition").agg(F.count("*").alias("n_files"))
        counts.append(files.select(F.lit(name).alias("lake_table"), "partition", "n_files"))
    return counts[0].unionByName(counts[1])


LARGE_FILE_BYTES = 64 * MIB


@query(
    """SELECT *, true AS mixed, true AS as_planned, true AS at_rest FROM lineitem"""
)
def compact_mixed_folder(spark, sf_dir):
    """A commit with large files, one for every ``LARGE_FILE_BYTES`` of the table, and 40 small ones for
    each of them: compacted, and not again."""
    lineitem, path = source(spark, sf_dir, "lineitem"), scratch_path(spark, "lineitem")
    stored = list_files(spark, f"{sf_dir}/lineitem.parquet").agg(F.sum("length")).first()[0] or 0
    large = -(-stored // LARGE_FILE_BYTES) or 1
    rest = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(10)) == 0
    write_lake(lineitem.where(~rest).repartition(large).unionByName(lineitem.where(rest).repartition(40 * large)), path)

    def files():
        found = data_files(spark, path).agg(F.count("*"), F.sum("length"), F.max("length"))
        return found.first()

    n, total, largest = files()
    target = largest + 1
    n_large = data_files(spark, path).where(F.col("length") > target // 2).count()
    first = compact_lake(spark, path, target_bytes=target)
    planned = files()[0] <= -(-total // target)
    second = compact_lake(spark, path, target_bytes=target)
    return read_lake(spark, path).withColumns(
        {
            "mixed": F.lit(n == 41 * large and n_large == large),
            "as_planned": F.lit(first is not None and planned),
            "at_rest": F.lit(second is None),
        }
    )


@query(
    """SELECT *, 3 AS folders_before, CAST(1 AS BIGINT) AS folders_after FROM orders"""
)
def maintenance_after_a_dead_run(spark, sf_dir):
    """Expiry that died when it had forgotten the snapshots, finished by the next run."""
    orders, path = source(spark, sf_dir, "orders"), scratch_path(spark, "orders")
    days = [datetime(2001, 7, day) for day in (1, 2, 3)]
    for day, rows in zip(days, (changed_orders(orders), orders.where("o_orderstatus = 'O'"), orders)):
        write_lake(rows, path, "overwrite", committed_at=day)
    before = len(children(spark, f"{path}/data", directories=True))
    listed, folders = expire_lake(spark, path, as_of=AS_OF, keep=1)
    # What such a run leaves behind: its table of folders, and snapshots that are gone.
    folders.write.parquet(f"{path}/deletions/{uuid.uuid4().hex}")
    for snapshot_id in listed:
        ledger.forget(spark, path, snapshot_id)
    remove_orphans(spark, path, as_of=AS_OF, dry_run=False)
    left = list_files(spark, f"{path}/data").agg(
        F.count_distinct(F.regexp_extract("path", f"({ledger.COMMIT}=[^/]+)", 1)).alias("folders_after")
    )
    return read_lake(spark, path).withColumns(
        {"folders_before": F.lit(before), "folders_after": F.lit(left.first()[0]).cast("bigint")}
    )


@query(
    """SELECT source, count(*) AS n_files, CAST(sum(n_chars) AS BIGINT) AS bytes,
              CAST(ceil(sum(n_chars) / 65536) AS BIGINT) AS target_files
       FROM documents GROUP BY source""",
    name="compaction_plan",
)
def compaction_plan_documents(spark, sf_dir):
    return compaction_plan(source(spark, sf_dir, "documents"), ["source"], "n_chars", 65536)


RETENTION = {
    "table": "o_custkey",
    "snapshot": "o_orderkey",
    "committed_at": "o_orderdate",
    "as_of": AS_OF,
    "days": 7,
    "keep": 3,
}

EXPIRY_SQL = """SELECT o_custkey, o_orderkey, o_orderdate,
                       o_orderdate < TIMESTAMP '2001-08-01' AND row_number() OVER (
                           PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC
                       ) > 3 AS expired
                FROM orders"""


def snapshots_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers stand for tables, their orders for snapshots."""
    return source(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")


@query(f"SELECT o_custkey, o_orderkey, o_orderdate FROM ({EXPIRY_SQL}) WHERE expired")
def snapshot_retention(spark, sf_dir):
    return expired_snapshots(snapshots_of_orders(spark, sf_dir), **RETENTION)


@query(
    f"""SELECT o_custkey, l_partkey
        FROM ({EXPIRY_SQL}) JOIN lineitem ON l_orderkey = o_orderkey
        GROUP BY o_custkey, l_partkey HAVING bool_and(expired)"""
)
def expired_file_cleanup(spark, sf_dir):
    flagged = with_expiry(snapshots_of_orders(spark, sf_dir), **RETENTION)
    files = source(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    references = files.join(flagged, F.col("l_orderkey") == F.col("o_orderkey"))
    return unreachable_files(
        references, file=["o_custkey", "l_partkey"], expired=F.col("expired")
    )


@query(
    """SELECT o_orderkey, o_orderdate FROM orders
       WHERE o_orderdate < TIMESTAMP '2001-08-01'
         AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
    name="orphan_files",
)
def orphan_files_of_orders(spark, sf_dir):
    return orphan_files(
        source(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"),
        source(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")),
        path="o_orderkey",
        modified="o_orderdate",
        as_of=AS_OF,
        days=7,
    )


# Transforms


@query(
    """SELECT * EXCLUDE (version) FROM (
           SELECT *, row_number() OVER (
               PARTITION BY l_orderkey, l_linenumber
               ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC,
                        l_quantity DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
                        l_linestatus DESC) AS version
           FROM lineitem) WHERE version = 1"""
)
def clean_dedupe_latest(spark, sf_dir):
    lineitem = source(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
    order += [c for c in lineitem.columns if c not in keys + order]
    return clean(lineitem, keys, [F.desc(c) for c in order], ["l_returnflag", "l_linestatus"])


@query(
    r"""SELECT doc_id, source, lang, n_chars,
               nullif(trim(regexp_replace(text, '[ \t\n\x0B\f\r]+', ' ', 'g')), '') AS text
        FROM documents"""
)
def clean_text_documents(spark, sf_dir):
    documents = source(spark, sf_dir, "documents")
    return normalise_text(drop_missing_keys(documents, ["doc_id"]), ["text"])


@query(
    """SELECT o_orderkey, o_totalprice, CAST(NULL AS VARCHAR) AS failed_columns FROM orders
       WHERE o_orderkey % 3 <> 0
       UNION ALL SELECT o_orderkey, NULL, 'price' FROM orders WHERE o_orderkey % 3 = 0"""
)
def typed_cast_of_rounded_values(spark, sf_dir):
    # Every third price gets a third decimal, which money would lose.
    price = F.format_string("%.2f", "o_totalprice")
    texts = source(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 3 == 0, F.concat(price, F.lit("9"))).otherwise(price).alias("price"),
    )
    types = {"price": "decimal(18,2)"}
    return (
        typed(texts, types)
        .select("o_orderkey", F.col("price").cast("double").alias("o_totalprice"))
        .withColumn("failed_columns", F.lit(None).cast("string"))
        .unionByName(
            rejects(texts, types).select(
                "o_orderkey", F.lit(None).cast("double").alias("o_totalprice"), "failed_columns"
            )
        )
    )


TEXT_IDS_SQL = """SELECT CASE WHEN event_type = 'error' THEN 'bad-' ELSE '' END
                         || CAST(event_id AS VARCHAR) AS event_id,
                         event_type, CAST(user_id AS VARCHAR) AS user_id
                  FROM events"""

TEXT_ID_TYPES = {"event_id": "bigint", "user_id": "bigint"}


def text_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ids as text, which is no number for errors."""
    prefix = F.when(F.col("event_type") == "error", "bad-").otherwise("")
    return source(spark, sf_dir, "events").select(
        F.concat(prefix, F.col("event_id").cast("string")).alias("event_id"),
        "event_type",
        F.col("user_id").cast("string").alias("user_id"),
    )


@query(
    f"""SELECT TRY_CAST(event_id AS BIGINT) AS event_id, event_type,
               TRY_CAST(user_id AS BIGINT) AS user_id
        FROM ({TEXT_IDS_SQL}) WHERE TRY_CAST(event_id AS BIGINT) IS NOT NULL"""
)
def typed_cast(spark, sf_dir):
    return typed(text_ids(spark, sf_dir), TEXT_ID_TYPES)


@query(
    f"""SELECT *, 'event_id' AS failed_columns
        FROM ({TEXT_IDS_SQL}) WHERE TRY_CAST(event_id AS BIGINT) IS NULL"""
)
def typed_cast_rejects(spark, sf_dir):
    return rejects(text_ids(spark, sf_dir), TEXT_ID_TYPES)


@query(
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"""
)
def payload_extract(spark, sf_dir):
    events = source(spark, sf_dir, "events").select("event_id", "props")
    return extract_payload(events, "props", "k bigint")


@query(
    """SELECT CAST(event_id AS BIGINT) AS event_id, user_id, event_type,
              CAST(value AS DECIMAL(18,2)) AS value, props, ts AS created_at
       FROM events"""
)
def refined_events(spark, sf_dir):
    raw = as_raw(source(spark, sf_dir, "events"))
    rows = typed(extract_payload(raw, "payload", PAYLOAD_FIELDS), REFINED_TYPES)
    return clean(
        rows.drop("dt"), ["event_id"], [F.desc("created_at"), F.desc("value")], ["event_type"]
    )


@query(
    """SELECT 'customer' AS party_type, c_custkey AS party_key, c_name AS name,
              c_nationkey AS nationkey, CAST(c_acctbal AS DECIMAL(18,2)) AS acctbal,
              c_mktsegment AS mktsegment
       FROM customer
       UNION ALL
       SELECT 'supplier', s_suppkey, s_name, s_nationkey, CAST(s_acctbal AS DECIMAL(18,2)), NULL
       FROM supplier""",
    name="conform_union",
)
def conform_parties(spark, sf_dir):
    customer = {
        "party_type": F.lit("customer"),
        "party_key": F.col("c_custkey"),
        "name": F.col("c_name"),
        "nationkey": F.col("c_nationkey"),
        "acctbal": money("c_acctbal"),
        "mktsegment": F.col("c_mktsegment"),
    }
    supplier = {
        "party_type": F.lit("supplier"),
        "party_key": F.col("s_suppkey"),
        "name": F.col("s_name"),
        "nationkey": F.col("s_nationkey"),
        "acctbal": money("s_acctbal"),
    }
    return conform_union(
        [
            (source(spark, sf_dir, "customer"), customer),
            (source(spark, sf_dir, "supplier"), supplier),
        ]
    )


@query(
    """SELECT CAST(o_orderdate AS DATE) AS date,
              CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total_amount,
              count(*) AS total_count
       FROM orders GROUP BY 1""",
    name="daily_summary",
)
def daily_summary_orders(spark, sf_dir):
    return daily_summary(source(spark, sf_dir, "orders"), "o_orderdate", "o_totalprice")


@query(
    """SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
              o_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, n_name, n_regionkey, r_name
       FROM orders LEFT JOIN customer ON c_custkey = o_custkey
            LEFT JOIN nation ON n_nationkey = c_nationkey
            LEFT JOIN region ON r_regionkey = n_regionkey"""
)
def denormalise_orders(spark, sf_dir):
    return denormalise(
        source(spark, sf_dir, "orders"),
        [
            Dimension(source(spark, sf_dir, "customer"), "c_custkey", "o_custkey"),
            Dimension(source(spark, sf_dir, "nation"), "n_nationkey", "c_nationkey"),
            Dimension(source(spark, sf_dir, "region"), "r_regionkey", "n_regionkey"),
        ],
    )


# Quality


def check_sql(name: str, broken: str, what: str, table: str) -> str:
    """A row check as SQL."""
    return f"""SELECT '{name}' AS name, n = 0 AS passed, n AS failed_rows,
                      CASE WHEN n > 0 THEN n || ' rows {what}' ELSE '' END AS detail
               FROM (SELECT count(*) FILTER (WHERE {broken}) AS n FROM {table})"""


def unique_sql(keys: str, table: str) -> str:
    return f"""SELECT 'unique({keys})' AS name, n = 0 AS passed, n AS failed_rows,
                      CASE WHEN n > 0 THEN n || ' rows share a key' ELSE '' END AS detail
               FROM (SELECT CAST(coalesce(sum(c), 0) AS BIGINT) AS n
                     FROM (SELECT count(*) AS c FROM {table} GROUP BY {keys}
                           HAVING count(*) > 1))"""


def row_count_sql(rows: int, table: str) -> str:
    return f"""SELECT 'row_count_min({rows})' AS name, n >= {rows} AS passed,
                      greatest({rows} - n, 0) AS failed_rows,
                      CASE WHEN n < {rows} THEN n || ' rows, at least {rows} expected'
                           ELSE '' END AS detail
               FROM (SELECT count(*) AS n FROM {table})"""


def union_sql(*parts: str) -> str:
    return " UNION ALL ".join(f"({part})" for part in parts)


FINISHED_SQL = """(SELECT *, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS final_price
                   FROM orders)"""


def finished_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a price that is final, hence present, only for status F."""
    final = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))
    return source(spark, sf_dir, "orders").withColumn("final_price", final)


@query(
    union_sql(
        check_sql("not_null(final_price)", "final_price IS NULL", "are null", FINISHED_SQL),
        check_sql("not_null(o_custkey)", "o_custkey IS NULL", "are null", "orders"),
    )
)
def dq_not_null(spark, sf_dir):
    checker = QualityChecker(finished_orders(spark, sf_dir))
    return checker.not_null("final_price").not_null("o_custkey").run()


@query(union_sql(unique_sql("l_orderkey,l_linenumber", "lineitem")))
def dq_unique(spark, sf_dir):
    return QualityChecker(source(spark, sf_dir, "lineitem")).unique(
        "l_orderkey", "l_linenumber"
    ).run()


@query(
    union_sql(
        check_sql(
            "value_in_set(event_type)",
            "event_type NOT IN ('click', 'view', 'purchase', 'signup')",
            "are outside the set",
            "events",
        )
    )
)
def dq_value_in_set(spark, sf_dir):
    known = ["click", "view", "purchase", "signup"]
    return QualityChecker(source(spark, sf_dir, "events")).value_in_set("event_type", known).run()


@query(
    union_sql(
        check_sql("min_value(value)", "value < 1.0", "are below 1.0", "events"),
        check_sql("min_value(user_id)", "user_id < 0", "are below 0", "events"),
    )
)
def dq_min_value(spark, sf_dir):
    checker = QualityChecker(source(spark, sf_dir, "events"))
    return checker.min_value("value", 1.0).min_value("user_id", 0).run()


@query(union_sql(check_sql("max_value(value)", "value > 400.0", "are above 400.0", "events")))
def dq_max_value(spark, sf_dir):
    return QualityChecker(source(spark, sf_dir, "events")).max_value("value", 400.0).run()


@query(union_sql(row_count_sql(1, "events"), row_count_sql(1000000000, "events")))
def dq_row_count_min(spark, sf_dir):
    checker = QualityChecker(source(spark, sf_dir, "events"))
    return checker.row_count_min(1).row_count_min(1000000000).run()


@query(
    """SELECT 'schema_match' AS name, false AS passed, count(*) AS failed_rows,
              'event_id is bigint instead of string; amount is absent; ts is not declared; '
              || 'user_id is not declared; event_type is not declared; props is not declared'
                  AS detail
       FROM events"""
)
def dq_schema_match(spark, sf_dir):
    expected = {"event_id": "string", "value": "double", "amount": "decimal(18,2)"}
    checker = QualityChecker(source(spark, sf_dir, "events"))
    return checker.schema_match(expected, allow_extra_columns=False).run()


@query(
    union_sql(
        check_sql("not_null(final_price)", "final_price IS NULL", "are null", FINISHED_SQL),
        unique_sql("o_orderkey", "orders"),
        unique_sql("o_custkey", "orders"),
        check_sql(
            "value_in_set(o_orderstatus)",
            "o_orderstatus NOT IN ('F', 'O', 'P')",
            "are outside the set",
            "orders",
        ),
        check_sql(
            "min_value(final_price)", "final_price < 1000.0", "are below 1000.0", FINISHED_SQL
        ),
        check_sql(
            "max_value(o_totalprice)", "o_totalprice > 450000.0", "are above 450000.0", "orders"
        ),
        row_count_sql(1, "orders"),
        "SELECT 'schema_match' AS name, true AS passed, 0 AS failed_rows, '' AS detail",
    )
)
def dq_report(spark, sf_dir):
    return (
        QualityChecker(finished_orders(spark, sf_dir))
        .not_null("final_price")
        .unique("o_orderkey")
        .unique("o_custkey")
        .value_in_set("o_orderstatus", ["F", "O", "P"])
        .min_value("final_price", 1000.0)
        .max_value("o_totalprice", 450000.0)
        .row_count_min(1)
        .schema_match({"o_orderkey": "bigint", "o_totalprice": "double"})
        .run()
    )


# Alerts


RUN_EVENTS_SQL = """SELECT event_id, ts,
                           CASE WHEN event_type IN ('purchase', 'signup')
                                THEN 'pipeline' ELSE 'job' END AS origin,
                           CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'ABORTED'
                                           ELSE 'SUCCEEDED' END AS status
                    FROM events"""

FAILURES_SQL = f"""SELECT *, origin || '_failure' AS rule FROM ({RUN_EVENTS_SQL})
                   WHERE (origin = 'pipeline' AND status IN ('FAILED', 'TIMED_OUT', 'ABORTED'))
                      OR (origin = 'job' AND status IN ('FAILED', 'TIMEOUT', 'ERROR'))"""

FAILURE_RULES = failure_rules("origin", "status", pipeline="pipeline", job="job")


def run_events(events: DataFrame) -> DataFrame:
    """Events read as state changes of pipeline runs and job runs."""
    kind = F.col("event_type")
    status = F.when(kind == "error", "ERROR").when(kind == "signup", "ABORTED")
    return events.select(
        "event_id",
        "ts",
        F.when(kind.isin("purchase", "signup"), "pipeline").otherwise("job").alias("origin"),
        status.otherwise("SUCCEEDED").alias("status"),
    )


@query(FAILURES_SQL)
def failure_filter(spark, sf_dir):
    return match_rules(run_events(source(spark, sf_dir, "events")), FAILURE_RULES)


@query(FAILURES_SQL)
def failure_filter_stream(spark, sf_dir):
    events = run_events(source(spark, sf_dir, "events"))
    root = scratch_path(spark, "alerts")
    write_raw(events, f"{root}/in")
    stream = new_rows(spark, f"{root}/in", events.schema)
    forward_alerts(stream, FAILURE_RULES, f"{root}/out", f"{root}/checkpoint")
    declared = StructType(events.schema.fields).add("rule", "string")
    return read_raw(spark, f"{root}/out", schema=declared)
