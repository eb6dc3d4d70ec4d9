"""Views of the driver tables in the shape the operators work on, in Spark and as SQL for DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clock

ZONE = "Australia/Melbourne"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def v_hourly(spark, sf_dir) -> DataFrame:
    """Events by sensor and hour, less one so that some are zero; missing hours are gaps."""
    e = table(spark, sf_dir, "events")
    h = e.groupBy((F.col("user_id") % 8).cast("int").alias("location_id"), clock.trunc("HOUR", "ts").alias("ts_utc")).agg((F.count("*") - 1).alias("pedestriancount"))
    day = F.dayofmonth("ts_utc")
    return h.withColumn("source", F.when(day <= 10, "archive").when(day <= 20, "wayback").otherwise("live"))


def v_local(spark, sf_dir) -> DataFrame:
    """Orders as counts at a local time: six years of clock changes."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("row_id"), (F.col("o_custkey") % 12).cast("int").alias("location_id"),
        clock.add_hours(F.col("o_orderdate"), (F.col("o_orderkey") % 24).cast("int")).alias("ts_local"), (F.col("o_orderkey") % 997).cast("long").alias("pedestriancount"),
    )


def v_minute(spark, sf_dir) -> DataFrame:
    """Events as polls of minute counts; every tenth is published again later, half of those revised."""
    e = table(spark, sf_dir, "events")
    own = e.select(
        (F.col("user_id") % 8).cast("int").alias("location_id"), clock.trunc("MINUTE", "ts").alias("sensing_datetime"),
        (F.col("event_id") % 3).alias("direction_1"), (F.col("event_id") % 5).alias("direction_2"), (F.col("event_id") % 3 + F.col("event_id") % 5).alias("total_of_directions"),
        F.timestamp_add("MINUTE", (F.col("event_id") % 3 * 15).cast("int"), clock.trunc("MINUTE", "ts")).alias("polled_at"), "event_id",
    )
    again = own.where("event_id % 10 = 0").withColumn("polled_at", F.timestamp_add("MINUTE", F.lit(60), "polled_at")).withColumn("direction_1", F.col("direction_1") + F.col("event_id") % 20 / 10)
    again = again.withColumn("direction_1", F.col("direction_1").cast("long"))
    again = again.withColumn("total_of_directions", F.col("direction_1") + F.col("direction_2"))
    return own.unionByName(again).drop("event_id")


def v_scored(spark, sf_dir) -> DataFrame:
    """Line items as predictions: y and pred of a sensor in a fold, with two dimensions."""
    i = table(spark, sf_dir, "lineitem")
    return i.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_id"), F.col("l_suppkey").cast("int").alias("location_id"), F.col("l_shipdate").alias("ts_utc"), F.col("l_quantity").alias("y"),
        (F.col("l_quantity") * (1 + (F.col("l_partkey") % 7 - 3) / 10)).alias("pred"), (F.col("l_suppkey") % 5).cast("int").alias("fold"), "l_returnflag", "l_linestatus",
    )


def _points(df: DataFrame, key: str) -> DataFrame:
    return df.select(F.col(key).alias("id"), (F.col(key) * 37 % 1000).cast("double").alias("x"), (F.col(key) * 91 % 1000).cast("double").alias("y"))


def v_sites(spark, sf_dir) -> DataFrame:
    return _points(table(spark, sf_dir, "supplier"), "s_suppkey")


def v_places(spark, sf_dir) -> DataFrame:
    return _points(table(spark, sf_dir, "customer"), "c_custkey")


def v_lattice(spark, sf_dir) -> DataFrame:
    """Nations as a 5 x 5 grid of streets."""
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("u"))
    right = n.where("u % 5 < 4").select("u", (F.col("u") + 1).alias("v"))
    down = n.where("u < 20").select("u", (F.col("u") + 5).alias("v"))
    return right.unionByName(down).select((F.col("u") * 100 + F.col("v")).alias("segment_id"), "u", "v", (100 + F.col("u") * 7 % 13).cast("double").alias("length_m"))


def v_streets(spark, sf_dir) -> DataFrame:
    """Customers as a grid of streets, 25 wide and as long as there are customers."""
    n = table(spark, sf_dir, "customer").select((F.col("c_custkey") - 1).cast("bigint").alias("u"))
    to = n.select(F.col("u").alias("v"))
    right = n.where("u % 25 < 24").select("u", (F.col("u") + 1).alias("v"), (F.col("u") * 2).alias("segment_id"))
    down = n.select("u", (F.col("u") + 25).alias("v"), (F.col("u") * 2 + 1).alias("segment_id"))
    return right.unionByName(down).join(to, "v", "left_semi").select("segment_id", "u", "v", (100 + F.col("u") * 7 % 13).cast("double").alias("length_m"))


def v_years(spark, sf_dir) -> DataFrame:
    """Orders of each nation and year."""
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).select(F.col("c_nationkey").cast("int").alias("property"), F.year("o_orderdate").alias("year"), "o_orderkey")


def v_events(spark, sf_dir) -> DataFrame:
    """Urgent orders as timed events at four venues."""
    o = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'")
    start = clock.add_hours(F.col("o_orderdate"), (F.col("o_orderkey") % 24).cast("int"))
    return o.select(
        F.col("o_orderkey").alias("event_id"), F.concat(F.lit("venue"), F.col("o_custkey") % 4).alias("venue"),
        F.when(F.col("o_orderkey") % 3 == 0, "concert").when(F.col("o_orderkey") % 3 == 1, "football").otherwise("cricket").alias("kind"), start.alias("start_local"),
        F.when(F.col("o_orderkey") % 2 == 0, F.timestamp_add("MINUTE", F.lit(150), start)).alias("end_local"),
    )


#: The same views for DuckDB.
VIEW_SQL = {
    "v_hourly": """SELECT CAST(user_id % 8 AS INTEGER) AS location_id, date_trunc('hour', ts) AS ts_utc, count(*) - 1 AS pedestriancount,
  CASE WHEN day(date_trunc('hour', ts)) <= 10 THEN 'archive' WHEN day(date_trunc('hour', ts)) <= 20 THEN 'wayback' ELSE 'live' END AS source
  FROM events GROUP BY ALL""",
    "v_local": """SELECT o_orderkey AS row_id, CAST(o_custkey % 12 AS INTEGER) AS location_id,
  o_orderdate + CAST(o_orderkey % 24 AS INTEGER) * INTERVAL 1 HOUR AS ts_local, o_orderkey % 997 AS pedestriancount FROM orders""",
    "v_minute": """SELECT location_id, sensing_datetime, direction_1, direction_2, direction_1 + direction_2 AS total_of_directions, polled_at FROM (
  SELECT CAST(user_id % 8 AS INTEGER) AS location_id, date_trunc('minute', ts) AS sensing_datetime, event_id % 3 AS direction_1, event_id % 5 AS direction_2,
    date_trunc('minute', ts) + CAST(event_id % 3 * 15 AS INTEGER) * INTERVAL 1 MINUTE AS polled_at FROM events
  UNION ALL
  SELECT CAST(user_id % 8 AS INTEGER), date_trunc('minute', ts), event_id % 3 + (event_id % 20) // 10, event_id % 5,
    date_trunc('minute', ts) + CAST(event_id % 3 * 15 + 60 AS INTEGER) * INTERVAL 1 MINUTE FROM events WHERE event_id % 10 = 0)""",
    "v_scored": """SELECT l_orderkey * 8 + l_linenumber AS row_id, CAST(l_suppkey AS INTEGER) AS location_id, l_shipdate AS ts_utc, l_quantity AS y,
  l_quantity * (1 + (l_partkey % 7 - 3) / 10) AS pred, CAST(l_suppkey % 5 AS INTEGER) AS fold, l_returnflag, l_linestatus FROM lineitem""",
    "v_sites": "SELECT s_suppkey AS id, CAST(s_suppkey * 37 % 1000 AS DOUBLE) AS x, CAST(s_suppkey * 91 % 1000 AS DOUBLE) AS y FROM supplier",
    "v_places": "SELECT c_custkey AS id, CAST(c_custkey * 37 % 1000 AS DOUBLE) AS x, CAST(c_custkey * 91 % 1000 AS DOUBLE) AS y FROM customer",
    "v_lattice": """SELECT CAST(u * 100 + v AS BIGINT) AS segment_id, CAST(u AS BIGINT) AS u, CAST(v AS BIGINT) AS v, CAST(100 + u * 7 % 13 AS DOUBLE) AS length_m FROM (
  SELECT n_nationkey AS u, n_nationkey + 1 AS v FROM nation WHERE n_nationkey % 5 < 4 UNION ALL SELECT n_nationkey, n_nationkey + 5 FROM nation WHERE n_nationkey < 20)""",
    "v_streets": """SELECT CAST(segment_id AS BIGINT) AS segment_id, CAST(u AS BIGINT) AS u, CAST(v AS BIGINT) AS v, CAST(100 + u * 7 % 13 AS DOUBLE) AS length_m FROM (
  SELECT c_custkey - 1 AS u, c_custkey AS v, (c_custkey - 1) * 2 AS segment_id FROM customer WHERE (c_custkey - 1) % 25 < 24 UNION ALL SELECT c_custkey - 1, c_custkey + 24, (c_custkey - 1) * 2 + 1 FROM customer)
  WHERE v IN (SELECT c_custkey - 1 FROM customer)""",
    "v_years": "SELECT CAST(c_nationkey AS INTEGER) AS property, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey",
    "v_events": """SELECT o_orderkey AS event_id, 'venue' || CAST(o_custkey % 4 AS VARCHAR) AS venue,
  CASE o_orderkey % 3 WHEN 0 THEN 'concert' WHEN 1 THEN 'football' ELSE 'cricket' END AS kind,
  o_orderdate + CAST(o_orderkey % 24 AS INTEGER) * INTERVAL 1 HOUR AS start_local,
  CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate + CAST(o_orderkey % 24 AS INTEGER) * INTERVAL 1 HOUR + INTERVAL 150 MINUTE END AS end_local
  FROM orders WHERE o_orderpriority = '1-URGENT'""",
}


def sql(body: str, **ctes: str) -> str:
    """The statement with the views it names, and further CTEs, before it."""
    text = body + " ".join(ctes.values())
    parts = [f"{n} AS ({v})" for n, v in VIEW_SQL.items() if re.search(rf"\b{n}\b", text)] + [f"{n} AS ({v})" for n, v in ctes.items()]
    return f"WITH {'RECURSIVE ' if 'RECURSIVE_STEP' in text else ''}{', '.join(parts)} {body}".replace("/*RECURSIVE_STEP*/", "") if parts else body
