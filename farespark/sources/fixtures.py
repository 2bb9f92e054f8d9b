"""Fare quotes derived from the driver's test tables (FIXTURES.md).

The test data holds no fares, so two mappings feed the RAW schema:

* FX1 (primary): ``events`` -> one quote per event.
* FX2 (volume): ``lineitem`` joined to ``orders``; origin is the customer's
  region, destination the supplier's region.

Each builder has a DuckDB text twin (``*_SQL``) used by the SQL oracle, so
the two engines start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farespark.schemas import RAW


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_to_raw(events: DataFrame) -> DataFrame:
    """FX1 mapping of ``events`` rows to RAW quotes (narrow, no shuffle)."""
    k = F.get_json_object("props", "$.k").cast("int")
    ts = F.col("ts").cast("timestamp_ntz")
    out = events.select(
        F.lit("synthetic").alias("provider"),
        F.concat(F.lit("r"), (F.col("user_id") % 5).cast("string")).alias("route_origin"),
        F.col("event_type").alias("route_destination"),
        (ts + F.make_dt_interval(days=k)).alias("departure_at"),
        ts.alias("captured_at"),
        F.when(F.col("event_id") % 10 == 0, "business").otherwise("economy").alias("ticket_class"),
        F.when(F.col("event_id") % 20 == 7, "USD").otherwise("RUB").alias("currency"),
        F.col("value").cast("double").alias("price"),
        (ts + F.expr("INTERVAL 1 HOUR")).alias("ingested_at"),
        F.col("event_id"),
    )
    return out


def fx1_raw(spark: SparkSession, sf_dir: str, keep_event_id: bool = False) -> DataFrame:
    df = events_to_raw(read_table(spark, sf_dir, "events"))
    return df if keep_event_id else df.select(*RAW.fieldNames())


def fx2_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX2: lineitem x orders -> quotes between customer and supplier regions.

    nation (25 rows) and region (5 rows) are fixed by the TPC-H spec, so
    broadcasting their join is size-bounded. customer and supplier grow with
    the scale factor: their joins are left to the planner, which broadcasts
    only under ``autoBroadcastJoinThreshold`` and otherwise shuffles on the
    key (AQE re-plans with run-time sizes). lineitem x orders is a
    fact-to-fact join and is always a sort-merge join.
    """
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    nation_region = F.broadcast(
        nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey).select(
            "n_nationkey", "r_name"
        )
    )
    cust = (
        read_table(spark, sf_dir, "customer")
        .select("c_custkey", "c_nationkey")
        .join(nation_region, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", F.col("r_name").alias("origin_region"))
    )
    supp = (
        read_table(spark, sf_dir, "supplier")
        .select("s_suppkey", "s_nationkey")
        .join(nation_region, F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_suppkey", F.col("r_name").alias("destination_region"))
    )
    # orders (4x smaller than lineitem) take their origin region first, so the
    # lineitem-sized side is shuffled once, on the order key
    orders = (
        read_table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_custkey", "o_orderdate")
        .join(cust, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "o_orderdate", "origin_region")
    )
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_shipdate"
    )
    # fact-to-fact: always a shuffle (sort-merge) join on the order key,
    # whatever the size estimates say (a small estimate once made the planner
    # broadcast the whole lineitem side).
    j = li.hint("merge").join(orders, li.l_orderkey == orders.o_orderkey).join(
        supp, F.col("l_suppkey") == F.col("s_suppkey")
    )
    captured = F.col("o_orderdate").cast("timestamp_ntz") + F.make_dt_interval(
        hours=(F.col("o_orderkey") % 24).cast("int")
    )
    return j.select(
        F.lit("synthetic").alias("provider"),
        F.col("origin_region").alias("route_origin"),
        F.col("destination_region").alias("route_destination"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("departure_at"),
        captured.alias("captured_at"),
        F.when(F.col("l_linenumber") == 1, "business").otherwise("economy").alias("ticket_class"),
        F.lit("RUB").alias("currency"),
        F.col("l_extendedprice").cast("double").alias("price"),
        (captured + F.expr("INTERVAL 1 HOUR")).alias("ingested_at"),
    )


# DuckDB twins (the driver pre-registers the tables as views).
FX1_RAW_SQL = """
SELECT 'synthetic' AS provider,
       'r' || CAST(user_id % 5 AS VARCHAR) AS route_origin,
       event_type AS route_destination,
       CAST(ts AS TIMESTAMP) + to_days(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS departure_at,
       CAST(ts AS TIMESTAMP) AS captured_at,
       CASE WHEN event_id % 10 = 0 THEN 'business' ELSE 'economy' END AS ticket_class,
       CASE WHEN event_id % 20 = 7 THEN 'USD' ELSE 'RUB' END AS currency,
       CAST(value AS DOUBLE) AS price,
       CAST(ts AS TIMESTAMP) + INTERVAL 1 HOUR AS ingested_at,
       event_id
FROM events
"""

FX2_RAW_SQL = """
SELECT 'synthetic' AS provider,
       rc.r_name AS route_origin,
       rs.r_name AS route_destination,
       CAST(l.l_shipdate AS TIMESTAMP) AS departure_at,
       CAST(o.o_orderdate AS TIMESTAMP) + to_hours(CAST(o.o_orderkey % 24 AS INTEGER)) AS captured_at,
       CASE WHEN l.l_linenumber = 1 THEN 'business' ELSE 'economy' END AS ticket_class,
       'RUB' AS currency,
       CAST(l.l_extendedprice AS DOUBLE) AS price,
       CAST(o.o_orderdate AS TIMESTAMP) + to_hours(CAST(o.o_orderkey % 24 AS INTEGER)) + INTERVAL 1 HOUR AS ingested_at
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation nc ON c.c_nationkey = nc.n_nationkey
JOIN region rc ON nc.n_regionkey = rc.r_regionkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation ns ON s.s_nationkey = ns.n_nationkey
JOIN region rs ON ns.n_regionkey = rs.r_regionkey
"""
