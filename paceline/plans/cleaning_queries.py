"""Queries of cleaning, reconciling and runs of hours."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clock
from ..operators import cleaning, islands
from .views import ZONE, sql, table, v_hourly, v_local, v_minute

QUERIES, ORACLES = {}, {}


def query(oracle: str | None, **ctes: str):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = sql(oracle, **ctes)
        return f

    return add


@query("SELECT location_id, ts_utc, pedestriancount, source FROM v_hourly")
def hourly_counts(spark, sf):
    return v_hourly(spark, sf).select("location_id", "ts_utc", "pedestriancount", "source")


@query("SELECT row_id, location_id, ts_local, pedestriancount FROM (SELECT *, count(*) OVER (PARTITION BY location_id, ts_local) AS n FROM v_local) WHERE n = 1")
def dedup_drop_all(spark, sf):
    return cleaning.drop_ambiguous(v_local(spark, sf), ["location_id", "ts_local"])


_SOURCES = {
    "s_archive": "SELECT * FROM v_local WHERE ts_local < TIMESTAMP '1997-01-01'",
    "s_live": "SELECT * FROM v_local WHERE ts_local >= TIMESTAMP '1999-01-01'",
    "s_wayback": "SELECT * FROM v_local WHERE ts_local >= TIMESTAMP '1996-06-01' AND ts_local < TIMESTAMP '1999-06-01'",
}


def _sources(spark, sf):
    v = v_local(spark, sf)
    return v.where("ts_local < timestamp_ntz'1997-01-01'"), v.where("ts_local >= timestamp_ntz'1999-01-01'"), v.where("ts_local >= timestamp_ntz'1996-06-01' and ts_local < timestamp_ntz'1999-06-01'")


@query(
    """SELECT row_id, 'archive' AS source FROM s_archive UNION ALL SELECT row_id, 'live' FROM s_live UNION ALL
SELECT row_id, 'wayback' FROM s_wayback WHERE ts_local > (SELECT max(ts_local) FROM s_archive) AND ts_local < (SELECT min(ts_local) FROM s_live)""",
    **_SOURCES,
)
def gap_fill_union(spark, sf):
    archive, live, wayback = _sources(spark, sf)
    gap = cleaning.fill_gap(wayback, archive, live, "ts_local")
    return archive.select("row_id", F.lit("archive").alias("source")).unionByName(live.select("row_id", F.lit("live").alias("source"))).unionByName(gap.select("row_id", F.lit("wayback").alias("source")))


@query(
    """SELECT location_id, ts_local, pedestriancount FROM (SELECT *, row_number() OVER (PARTITION BY location_id, ts_local ORDER BY p DESC) AS r FROM (
  SELECT location_id, ts_local, max(pedestriancount) AS pedestriancount, 0 AS p FROM s_wayback GROUP BY ALL
  UNION ALL SELECT location_id, ts_local, max(pedestriancount) + 1, 1 FROM s_live GROUP BY ALL)) WHERE r = 1""",
    **_SOURCES,
)
def dedup_fresh_wins(spark, sf):
    _, live, wayback = _sources(spark, sf)
    held = wayback.groupBy("location_id", "ts_local").agg(F.max("pedestriancount").alias("pedestriancount"))
    fresh = live.groupBy("location_id", "ts_local").agg((F.max("pedestriancount") + 1).alias("pedestriancount"))
    return cleaning.upsert(held, fresh, ["location_id", "ts_local"])


@query(
    """SELECT location_id, ts_local, source FROM (SELECT *, row_number() OVER (PARTITION BY location_id, ts_local ORDER BY p) AS r FROM (
  SELECT DISTINCT location_id, ts_local, 'live' AS source, 0 AS p FROM s_live UNION ALL SELECT DISTINCT location_id, ts_local, 'archive', 1 FROM s_archive
  UNION ALL SELECT DISTINCT location_id, ts_local, 'wayback', 2 FROM s_wayback)) WHERE r = 1""",
    **_SOURCES,
)
def unify_by_priority(spark, sf):
    archive, live, wayback = (s.select("location_id", "ts_local").distinct() for s in _sources(spark, sf))
    tagged = [s.withColumn("source", F.lit(n)) for s, n in ((live, "live"), (archive, "archive"), (wayback, "wayback"))]
    return cleaning.prefer(tagged, ["location_id", "ts_local"])


@query("SELECT location_id, sensing_datetime, direction_1, direction_2, total_of_directions, min(polled_at) AS polled_at FROM v_minute GROUP BY ALL")
def dedup_first_poll(spark, sf):
    v = v_minute(spark, sf)
    return cleaning.merge_polls(v.where("minute(polled_at) < 30"), v.where("minute(polled_at) >= 30"))


_LATEST = """SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY location_id, sensing_datetime ORDER BY polled_at DESC, direction_1 DESC, direction_2 DESC) AS r FROM v_minute) WHERE r = 1"""


@query(_LATEST)
def dedup_latest_poll(spark, sf):
    return cleaning.latest_poll(v_minute(spark, sf), ["location_id", "sensing_datetime"], "polled_at", ["direction_1", "direction_2"])


def _midnight(spark, sf):
    """Every hour of four days at one sensor stamped midnight, beside ordinary rows."""
    v = v_local(spark, sf).select("row_id", "location_id", "ts_local")
    hours = spark.range(24).crossJoin(spark.range(4).withColumnRenamed("id", "d"))
    lost = hours.select((1_000_000 + F.col("d") * 100 + (F.col("id") * 7 + F.col("d")) % 24).alias("row_id"), F.lit(99).alias("location_id"), F.timestamp_add("DAY", F.col("d").cast("int"), F.lit("2001-09-01").cast("timestamp_ntz")).alias("ts_local"))
    return v.unionByName(lost)


@query(
    """SELECT row_id, location_id, CASE WHEN whole THEN ts_local + CAST(place AS INTEGER) * INTERVAL 1 HOUR ELSE ts_local END AS ts_local FROM (
  SELECT *, ts_local = date_trunc('day', ts_local) AND count(*) OVER (PARTITION BY location_id, ts_local) = 24 AS whole,
    row_number() OVER (PARTITION BY location_id, ts_local ORDER BY row_id) - 1 AS place FROM (
    SELECT row_id, location_id, ts_local FROM v_local UNION ALL
    SELECT 1000000 + d * 100 + (h * 7 + d) % 24, 99, TIMESTAMP '2001-09-01' + CAST(d AS INTEGER) * INTERVAL 1 DAY FROM range(24) AS a(h), range(4) AS b(d)))"""
)
def rehour_midnight(spark, sf):
    return cleaning.rehour_midnight(_midnight(spark, sf), "location_id", "ts_local", "row_id")


@query(
    """SELECT row_id, location_id, ts_local FROM v_local v WHERE NOT EXISTS (SELECT 1 FROM (VALUES (3, DATE '1996-01-01', DATE '1997-06-30'), (7, DATE '1995-05-05', DATE '1995-12-05')) AS r(k, a, z)
  WHERE v.location_id = k AND CAST(ts_local AS DATE) BETWEEN a AND z)"""
)
def drop_listed_ranges(spark, sf):
    rules = spark.createDataFrame([(3, "1996-01-01", "1997-06-30"), (7, "1995-05-05", "1995-12-05")], "location_id int, a string, z string")
    rules = rules.select("location_id", F.to_date("a").alias("from_day"), F.to_date("z").alias("to_day"))
    return cleaning.drop_listed(v_local(spark, sf), rules, "location_id", F.to_date("ts_local")).select("row_id", "location_id", "ts_local")


#: The first of the two UTC hours that show the local one.
_UTC = """(SELECT min(u) FROM (VALUES (ts_local - INTERVAL 11 HOUR), (ts_local - INTERVAL 10 HOUR)) AS c(u) WHERE timezone('Australia/Melbourne', timezone('UTC', u)) = ts_local)"""
_PLACED = {"placed": f"SELECT *, {_UTC} AS ts_utc FROM v_local"}


@query("SELECT row_id, location_id, ts_local, ts_utc FROM placed WHERE ts_utc IS NOT NULL", **_PLACED)
def localize_dst(spark, sf):
    return cleaning.localize(v_local(spark, sf), "ts_local", ZONE).select("row_id", "location_id", "ts_local", "ts_utc")


@query("SELECT row_id, ts_local FROM placed WHERE ts_utc IS NULL", **_PLACED)
def localize_dropped(spark, sf):
    return cleaning.skipped_hours(v_local(spark, sf), "ts_local", ZONE).select("row_id", "ts_local")


@query("SELECT row_id, timezone('Australia/Melbourne', timezone('UTC', ts_local)) AS ts_there FROM v_local")
def utc_to_local(spark, sf):
    return v_local(spark, sf).select("row_id", clock.to_local(F.col("ts_local"), ZONE).alias("ts_there"))


@query("SELECT v.row_id, v.ts_local FROM v_local v, (SELECT CAST(max(ts_local) AS DATE) - 30 AS since FROM v_local) WHERE CAST(v.ts_local AS DATE) >= since")
def recent_window(spark, sf):
    v = v_local(spark, sf).withColumn("day", F.to_date("ts_local"))
    return cleaning.recent(v, v, "day", 30).select("row_id", "ts_local")


@query("SELECT CAST(y AS INTEGER) AS year FROM range(1995, 2003) AS t(y) WHERE y NOT IN (SELECT DISTINCT year(ts_local) FROM v_local) OR y > 2000")
def years_to_fetch(spark, sf):
    held = [r[0] for r in v_local(spark, sf).select(F.year("ts_local")).distinct().collect()]
    return cleaning.years_to_fetch(spark, 1995, 2002, held, 2)


@query(
    """SELECT s.s_suppkey AS id, s.s_name AS name, 'current' AS provenance, CAST(NULL AS VARCHAR) AS location_type FROM supplier s WHERE s_suppkey % 3 <> 0
UNION ALL SELECT s_suppkey, s_name, 'retired', 'Outdoor' FROM supplier WHERE s_suppkey % 3 = 0 AND s_suppkey % 2 = 0"""
)
def sensor_master_union(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return cleaning.with_retired(s.where("id % 3 <> 0"), s.where("id % 2 = 0"), "id", "Outdoor")


@query("SELECT location_id, ts_utc, pedestriancount FROM v_hourly WHERE pedestriancount >= 0 AND location_id IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 2 = 0)")
def clean_located_counts(spark, sf):
    located = table(spark, sf, "supplier").where("s_suppkey % 2 = 0").select(F.col("s_suppkey").cast("int").alias("location_id"))
    return cleaning.clean_counts(v_hourly(spark, sf), located, "location_id", "pedestriancount").select("location_id", "ts_utc", "pedestriancount")


@query(
    """SELECT CAST(d AS DATE) AS day FROM generate_series((SELECT min(CAST(o_orderdate AS DATE)) FROM orders WHERE o_orderpriority = '1-URGENT'), DATE '2001-08-05', INTERVAL 1 DAY) AS t(d)
WHERE CAST(d AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderpriority = '1-URGENT')"""
)
def missing_days(spark, sf):
    days = table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select(F.to_date("o_orderdate").alias("day"))
    return cleaning.missing_days(days, "day", F.to_date(F.lit("2001-08-06")))


@query(
    """SELECT CAST(sum(d) AS BIGINT) AS n_duplicates, CAST(sum(v - 1) AS BIGINT) AS n_revised FROM (SELECT sum(n - 1) AS d, count(*) AS v FROM (
  SELECT location_id, sensing_datetime, polled_at, count(*) AS n FROM v_minute GROUP BY ALL) GROUP BY location_id, sensing_datetime)"""
)
def archive_duplicates(spark, sf):
    return cleaning.duplicates_and_revisions(v_minute(spark, sf), ["location_id", "sensing_datetime"], "polled_at")


def _snapshots(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("way_id"), F.col("p_size").alias("shape"), F.when(F.col("p_partkey") % 11 != 0, F.col("p_brand")).alias("tag"))
    new = p.where("way_id % 7 <> 0").withColumns({"shape": F.when(F.col("way_id") % 5 == 0, F.col("shape") + 1).otherwise(F.col("shape")), "tag": F.when(F.col("way_id") % 4 == 0, "other").otherwise(F.col("tag"))})
    return p.where("way_id % 13 <> 0"), new


@query(
    """SELECT coalesce(o.way_id, n.way_id) AS way_id, CASE WHEN o.way_id IS NULL THEN 'added' WHEN n.way_id IS NULL THEN 'removed'
  WHEN o.shape IS DISTINCT FROM n.shape THEN 'rerouted' ELSE 'retagged' END AS change FROM a o FULL JOIN b n ON o.way_id = n.way_id
WHERE o.way_id IS NULL OR n.way_id IS NULL OR o.shape IS DISTINCT FROM n.shape OR o.tag IS DISTINCT FROM n.tag""",
    a="SELECT p_partkey AS way_id, p_size AS shape, CASE WHEN p_partkey % 11 <> 0 THEN p_brand END AS tag FROM part WHERE p_partkey % 13 <> 0",
    b="""SELECT p_partkey AS way_id, CASE WHEN p_partkey % 5 = 0 THEN p_size + 1 ELSE p_size END AS shape,
  CASE WHEN p_partkey % 4 = 0 THEN 'other' WHEN p_partkey % 11 <> 0 THEN p_brand END AS tag FROM part WHERE p_partkey % 7 <> 0""",
)
def set_changes(spark, sf):
    return cleaning.set_changes(*_snapshots(spark, sf), "way_id", "shape", ["tag"])


_LAGGED = {
    "lagged": """SELECT *, lag(ts_utc) OVER w AS before, lag(pedestriancount = 0) OVER w AS was FROM v_hourly WINDOW w AS (PARTITION BY location_id ORDER BY ts_utc)""",
}
_NEW = "CASE WHEN before IS NULL OR ts_utc - before <> INTERVAL 1 HOUR OR was IS DISTINCT FROM (pedestriancount = 0) THEN 1 ELSE 0 END"


@query(
    """SELECT location_id, ts_utc, pedestriancount, pedestriancount = 0 AND count(*) OVER w >= 3 AND max(CASE WHEN hour(ts_utc) BETWEEN 8 AND 19 THEN 1 ELSE 0 END) OVER w = 1 AS suspect_outage_zero
FROM numbered WINDOW w AS (PARTITION BY location_id, run)""",
    **_LAGGED,
    numbered=f"SELECT *, sum({_NEW}) OVER (PARTITION BY location_id ORDER BY ts_utc) AS run FROM lagged",
)
def outage_runs(spark, sf):
    return islands.flag_outages(v_hourly(spark, sf), "location_id", "ts_utc", "pedestriancount", F.hour("ts_utc")).select("location_id", "ts_utc", "pedestriancount", "suspect_outage_zero")


@query(
    """SELECT location_id, ts_utc FROM (SELECT *, count(*) OVER (PARTITION BY location_id, run) AS n FROM numbered) WHERE pedestriancount = 0 AND n >= 5""",
    **_LAGGED,
    numbered=f"SELECT *, sum({_NEW}) OVER (PARTITION BY location_id ORDER BY ts_utc) AS run FROM lagged",
)
def outage_runs_any_hour(spark, sf):
    flagged = islands.flag_outages(v_hourly(spark, sf), "location_id", "ts_utc", "pedestriancount", F.hour("ts_utc"), 5, None)
    return flagged.where("suspect_outage_zero").select("location_id", "ts_utc")


@query(
    """SELECT location_id, pedestriancount, min(ts_utc) AS start_ts, max(ts_utc) AS end_ts, count(*) AS n_hours FROM numbered GROUP BY location_id, pedestriancount, run HAVING count(*) >= 3""",
    held="SELECT *, lag(ts_utc) OVER w AS before, lag(pedestriancount) OVER w AS was FROM v_hourly WHERE pedestriancount >= 1 WINDOW w AS (PARTITION BY location_id ORDER BY ts_utc)",
    numbered="SELECT *, sum(CASE WHEN before IS NULL OR ts_utc - before <> INTERVAL 1 HOUR OR was <> pedestriancount THEN 1 ELSE 0 END) OVER (PARTITION BY location_id ORDER BY ts_utc) AS run FROM held",
)
def stuck_runs(spark, sf):
    return islands.stuck_runs(v_hourly(spark, sf), "location_id", "ts_utc", "pedestriancount", 3, 1)


@query(
    """SELECT location_id, before + INTERVAL 1 HOUR AS gap_from, ts_utc - INTERVAL 1 HOUR AS gap_to, date_diff('hour', before, ts_utc) - 1 AS n_missing FROM lagged WHERE date_diff('hour', before, ts_utc) > 1""",
    **_LAGGED,
)
def missing_gaps(spark, sf):
    return islands.gaps(v_hourly(spark, sf), "location_id", "ts_utc")


@query(
    """SELECT location_id, ts_utc, pedestriancount, usual_high FROM v_hourly JOIN (SELECT location_id AS k, quantile_cont(pedestriancount, 0.9) AS usual_high FROM v_hourly GROUP BY 1) ON location_id = k
WHERE usual_high > 0 AND pedestriancount > 1.5 * usual_high"""
)
def outliers_high(spark, sf):
    return islands.outliers(v_hourly(spark, sf), "location_id", "ts_utc", "pedestriancount", 1.5, 0.9)


@query("SELECT location_id, count(*) AS n_rows FROM v_hourly WHERE pedestriancount >= 2 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5")
def top_sensors(spark, sf):
    return islands.top_counts(v_hourly(spark, sf).where("pedestriancount >= 2"), "location_id", 5)


@query(
    """SELECT a, b, n_same, (SELECT count(*) FROM o x JOIN o y ON x.ts_utc = y.ts_utc WHERE x.location_id = a AND y.location_id = b) AS n_common,
  n_same / greatest((SELECT count(*) FROM o x JOIN o y ON x.ts_utc = y.ts_utc WHERE x.location_id = a AND y.location_id = b), 1) AS share
FROM (SELECT x.location_id AS a, y.location_id AS b, count(*) AS n_same FROM o x JOIN o y ON x.ts_utc = y.ts_utc AND x.pedestriancount = y.pedestriancount AND x.location_id < y.location_id GROUP BY 1, 2) WHERE n_same >= 20""",
    o="SELECT * FROM v_hourly WHERE pedestriancount >= 1",
)
def duplicate_series(spark, sf):
    return islands.duplicate_series(v_hourly(spark, sf), "location_id", "ts_utc", "pedestriancount", 20, 0.0, 1)


@query(
    """SELECT location_id, n_present, n_expected, n_present / greatest(n_expected, 1) AS share,
  CASE WHEN n_present = 0 AND before THEN 'silent' WHEN n_present / greatest(n_expected, 1) < 0.9 THEN 'low' ELSE 'ok' END AS state
FROM (SELECT location_id, count(DISTINCT CASE WHEN day THEN ts_utc END) AS n_present, bool_or(ts_utc <= since) AS before FROM m
  WHERE ts_utc > since - INTERVAL 30 DAY AND (day OR ts_utc <= since) GROUP BY 1), (SELECT count(DISTINCT ts_utc) AS n_expected FROM m WHERE day)""",
    m="SELECT v.*, e AS until, e - INTERVAL 7 DAY AS since, ts_utc > e - INTERVAL 7 DAY AND hour(ts_utc) BETWEEN 8 AND 19 AS day FROM v_hourly v, (SELECT max(ts_utc) AS e FROM v_hourly)",
)
def recent_completeness(spark, sf):
    return islands.recent_completeness(v_hourly(spark, sf), "location_id", "ts_utc", F.hour("ts_utc"))


@query("SELECT max(ts_utc) - INTERVAL 7 DAY AS since FROM v_hourly")
def new_since(spark, sf):
    return islands.new_since(v_hourly(spark, sf), "ts_utc", None, 7)


@query(
    """SELECT location_id, 1 - sum(n) / sum(s) AS missing_hours_share FROM (SELECT location_id, source, date_diff('hour', min(ts_utc), max(ts_utc)) + 1 AS s, count(*) AS n FROM v_hourly GROUP BY 1, 2) GROUP BY 1"""
)
def missing_hours_share(spark, sf):
    return islands.missing_share(v_hourly(spark, sf), "location_id", "ts_utc", "source")


@query("SELECT count(*) = date_diff('hour', min(ts_utc), max(ts_utc)) + 1 AS is_contiguous, count(*) = count(DISTINCT ts_utc) AS is_unique FROM (SELECT DISTINCT ts_utc FROM v_hourly)")
def spine_contiguous(spark, sf):
    return islands.contiguous(v_hourly(spark, sf).select("ts_utc").distinct(), "ts_utc")
