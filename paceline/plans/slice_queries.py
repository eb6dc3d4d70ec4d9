"""Queries of calendar features, weather, slices, representation and within-hour profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clock, sun
from ..operators import calendar, minutes, representation, slices
from ..operators.islands import flag_outages, missing_share
from .views import ZONE, sql, table, v_hourly, v_local, v_minute, v_years

QUERIES, ORACLES = {}, {}


def query(oracle: str | None, **ctes: str):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = sql(oracle, **ctes)
        return f

    return add


CALENDAR = calendar.Calendar(
    holidays=("1995-12-25", "1996-12-25", "1997-12-25", "1998-01-26", "1999-01-01"), terms=(("1996-01-29", "1996-04-02"), ("1996-04-15", "1996-06-28"), ("1997-01-29", "1997-03-27")), term_years=(1996, 1997),
    teaching=(("1996-02-26", "1996-06-01"), ("1998-03-01", "1998-05-30")), breaks=(("1996-04-05", "1996-04-14"),), exams=(("1996-06-08", "1996-06-26"),), university_years=(1996, 1998),
    covid=("1997-03-16", "1998-10-21"), periods={"metro_tunnel": "2000-11-30"},
)

_UTC = "(SELECT min(u) FROM (VALUES (ts_local - INTERVAL 11 HOUR), (ts_local - INTERVAL 10 HOUR)) AS c(u) WHERE timezone('Australia/Melbourne', timezone('UTC', u)) = ts_local)"
_D = "CAST(ts_local AS DATE)"


def _between(ranges) -> str:
    return "(" + " OR ".join(f"{_D} BETWEEN DATE '{a}' AND DATE '{z}'" for a, z in ranges) + ")"


@query(
    f"""SELECT row_id, {_D} AS date_local, CAST(hour(ts_local) AS TINYINT) AS hour_local, CAST(isodow(ts_local) - 1 AS TINYINT) AS weekday, CAST((isodow(ts_local) - 1) * 24 + hour(ts_local) AS SMALLINT) AS hour_of_week,
  isodow(ts_local) >= 6 AS is_weekend, {_D} IN ({", ".join(f"DATE '{h}'" for h in CALENDAR.holidays)}) AS is_public_holiday,
  CASE WHEN year(ts_local) IN (1996, 1997) THEN {_between(CALENDAR.terms)} END AS school_term,
  CASE WHEN year(ts_local) IN (1996, 1998) THEN {_between(CALENDAR.teaching)} AND NOT {_between(CALENDAR.breaks)} END AS uni_teaching,
  CASE WHEN year(ts_local) IN (1996, 1998) THEN {_between(CALENDAR.exams)} END AS uni_exams,
  {_between([CALENDAR.covid])} AS covid_period, {_D} >= DATE '2000-11-30' AS post_metro_tunnel FROM (SELECT *, {_UTC} AS ts_utc FROM v_local) WHERE ts_utc IS NOT NULL"""
)
def calendar_flags(spark, sf):
    placed = v_local(spark, sf).withColumn("ts_utc", clock.to_utc(F.col("ts_local"), ZONE)).where("ts_utc is not null")
    out = calendar.time_features(placed, "ts_utc", "ts_local", CALENDAR)
    return out.select("row_id", "date_local", "hour_local", "weekday", "hour_of_week", "is_weekend", "is_public_holiday", "school_term", "uni_teaching", "uni_exams", "covid_period", "post_metro_tunnel")


_SUN = {
    "g": """SELECT DISTINCT ts_utc, 2 * pi() / 365 * (dayofyear(m) - 1 + (hour(m) + minute(m) / 60 - 12) / 24) AS g, hour(m) * 60 + minute(m) AS mins FROM (SELECT ts_utc, ts_utc + INTERVAL 30 MINUTE AS m FROM v_hourly)""",
    "d": """SELECT *, 0.006918 - 0.399912 * cos(g) + 0.070257 * sin(g) - 0.006758 * cos(2 * g) + 0.000907 * sin(2 * g) - 0.002697 * cos(3 * g) + 0.00148 * sin(3 * g) AS dec,
  radians((mins + 229.18 * (0.000075 + 0.001868 * cos(g) - 0.032077 * sin(g) - 0.014615 * cos(2 * g) - 0.040849 * sin(2 * g)) + 4 * 144.9631) / 4 - 180) AS ha FROM g""",
    "p": """SELECT ts_utc, 90 - degrees(acos(greatest(least(sin(radians(-37.8136)) * sin(dec) + cos(radians(-37.8136)) * cos(dec) * cos(ha), 1), -1))) AS elevation,
  (degrees(atan2(sin(ha), cos(ha) * sin(radians(-37.8136)) - tan(dec) * cos(radians(-37.8136)))) + 180 + 360) % 360 AS azimuth FROM d""",
}


@query("SELECT ts_utc, round(elevation, 5) AS elevation, round(azimuth, 5) AS azimuth FROM p", **_SUN)
def solar_position(spark, sf):
    mid = F.timestamp_add("MINUTE", F.lit(30), F.col("ts_utc"))
    c = CALENDAR
    return v_hourly(spark, sf).select("ts_utc").distinct().select("ts_utc", F.round(sun.elevation(mid, c.lat, c.lon), 5).alias("elevation"), F.round(sun.azimuth(mid, c.lat, c.lon), 5).alias("azimuth"))


@query(
    """SELECT DISTINCT CASE WHEN elevation < 5 THEN -1 ELSE CAST(floor(azimuth / 30) AS INTEGER) % 12 * 5 + CASE WHEN elevation >= 60 THEN 4 WHEN elevation >= 45 THEN 3 WHEN elevation >= 30 THEN 2 WHEN elevation >= 15 THEN 1 ELSE 0 END END AS sun_bin FROM p""",
    **_SUN,
)
def reachable_sun_bins(spark, sf):
    mid = F.timestamp_add("MINUTE", F.lit(30), F.col("ts_utc"))
    c = CALENDAR
    return v_hourly(spark, sf).select("ts_utc").distinct().select(sun.sun_bin(sun.elevation(mid, c.lat, c.lon), sun.azimuth(mid, c.lat, c.lon)).alias("sun_bin")).distinct()


def _weather(spark, sf):
    e = table(spark, sf, "events")
    return e.where("user_id % 3 <> 0").groupBy(clock.trunc("HOUR", "ts").alias("ts_utc")).agg(F.max("event_id").alias("temperature"), F.count("*").alias("rain"))


_WEATHER = "SELECT date_trunc('hour', ts) AS ts_utc, max(event_id) AS temperature, count(*) AS rain FROM events WHERE user_id % 3 <> 0 GROUP BY 1"


@query(
    """SELECT v.location_id, v.ts_utc, v.pedestriancount, a.temperature AS wx_temperature, b.rain AS wx_rain FROM v_hourly v LEFT JOIN w a ON v.ts_utc = a.ts_utc LEFT JOIN w b ON b.ts_utc = v.ts_utc + INTERVAL 1 HOUR""",
    w=_WEATHER,
)
def weather_lag_join(spark, sf):
    out = calendar.weather_for(v_hourly(spark, sf), _weather(spark, sf), "ts_utc", ["temperature"], ["rain"])
    return out.select("location_id", "ts_utc", "pedestriancount", "wx_temperature", "wx_rain")


@query("SELECT ts_utc, temperature, lead(rain) OVER (ORDER BY ts_utc) AS rain FROM w", w=_WEATHER)
def weather_spine(spark, sf):
    return calendar.weather_spine(_weather(spark, sf), "ts_utc", ["temperature"], ["rain"])


@query(
    "SELECT ts_utc, value FROM (SELECT date_trunc('hour', ts) AS ts_utc, event_id AS value, row_number() OVER (PARTITION BY date_trunc('hour', ts) ORDER BY event_id DESC) AS r FROM events) WHERE r = 1"
)
def weather_last_file_wins(spark, sf):
    e = table(spark, sf, "events").select(clock.trunc("HOUR", "ts").alias("ts_utc"), F.col("event_id").alias("value"), F.col("event_id").alias("file"))
    return calendar.weather_dedup(e, "ts_utc", "file")


@query(
    """SELECT v.location_id, v.ts_utc, s.s_name AS sensor_name, p.p_retailprice AS slope_pct, s.s_name IS NOT NULL AS has_location
FROM v_hourly v LEFT JOIN supplier s ON s.s_suppkey = v.location_id AND s.s_suppkey % 4 <> 0 LEFT JOIN part p ON p.p_partkey = v.location_id"""
)
def fact_with_dimensions(spark, sf):
    sensors = table(spark, sf, "supplier").where("s_suppkey % 4 <> 0").select(F.col("s_suppkey").cast("int").alias("location_id"), F.col("s_name").alias("sensor_name"))
    steep = table(spark, sf, "part").select(F.col("p_partkey").cast("int").alias("location_id"), F.col("p_retailprice").alias("slope_pct"))
    return calendar.fact_table(v_hourly(spark, sf), sensors, steep, "location_id", "sensor_name").select("location_id", "ts_utc", "sensor_name", "slope_pct", "has_location")


@query("SELECT v.location_id, v.ts_utc, h.pedestriancount AS same FROM v_hourly v LEFT JOIN v_hourly h ON v.location_id = h.location_id AND v.ts_utc = h.ts_utc AND h.pedestriancount > 0")
def one_to_one_join(spark, sf):
    v = v_hourly(spark, sf)
    other = v.where("pedestriancount > 0").select("location_id", "ts_utc", F.col("pedestriancount").alias("same"))
    return calendar.one_to_one(v.select("location_id", "ts_utc"), other, ["location_id", "ts_utc"])


@query("SELECT h AS ts_utc, timezone('Australia/Melbourne', timezone('UTC', h)) AS ts_local FROM generate_series(TIMESTAMP '2024-03-30', TIMESTAMP '2024-04-12', INTERVAL 1 HOUR) AS t(h)")
def reference_hour_spine(spark, sf):
    return calendar.reference_hours(spark, "2024-03-30", "2024-04-12", ZONE, CALENDAR).select("ts_utc", "ts_local")


@query("SELECT location_id, ts_utc FROM v_hourly WHERE ts_utc >= TIMESTAMP '2024-01-14 13:00:00'")
def training_window(spark, sf):
    return calendar.trainable(v_hourly(spark, sf), "ts_utc", "2024-01-15", ZONE).select("location_id", "ts_utc")


@query("SELECT location_id, ts_utc, pedestriancount FROM v_hourly WHERE pedestriancount >= 2 AND source <> 'live'")
def condition_filter(spark, sf):
    return v_hourly(spark, sf).where(calendar.condition("pedestriancount", ">=", 2) & calendar.condition("source", "!=", "live")).select("location_id", "ts_utc", "pedestriancount")


_ERAS = {"first": "2024-01-05", "second": "2024-01-12", "third": "2024-01-21"}
_CUTS = {"count_band": ("pedestriancount", (0, 1, 3), ("none", "few", "many"))}


def _sliced(spark, sf):
    v = flag_outages(v_hourly(spark, sf), "location_id", "ts_utc", "pedestriancount", F.hour("ts_utc"))
    own = v.withColumns({"hour_local": F.hour("ts_utc"), "is_weekend": F.weekday("ts_utc") >= 5, "date_local": F.to_date("ts_utc"), "is_live": F.when(F.col("source") != "wayback", F.col("source") == "live")})
    return slices.row_slices(own, "hour_local", "is_weekend", "date_local", _ERAS, {"live": ("is_live", "live", "other")}, _CUTS)


_SLICED = {
    "lagged": "SELECT *, lag(ts_utc) OVER w AS before, lag(pedestriancount = 0) OVER w AS was FROM v_hourly WINDOW w AS (PARTITION BY location_id ORDER BY ts_utc)",
    "numbered": "SELECT *, sum(CASE WHEN before IS NULL OR ts_utc - before <> INTERVAL 1 HOUR OR was IS DISTINCT FROM (pedestriancount = 0) THEN 1 ELSE 0 END) OVER (PARTITION BY location_id ORDER BY ts_utc) AS run FROM lagged",
    "sliced": """SELECT location_id, ts_utc, pedestriancount, source, pedestriancount = 0 AND count(*) OVER w >= 3 AND max(CASE WHEN hour(ts_utc) BETWEEN 8 AND 19 THEN 1 ELSE 0 END) OVER w = 1 AS outage,
  CASE WHEN hour(ts_utc) < 6 THEN 'night' WHEN hour(ts_utc) < 10 THEN 'morning_peak' WHEN hour(ts_utc) < 16 THEN 'midday' WHEN hour(ts_utc) < 20 THEN 'evening_peak' ELSE 'late_evening' END AS time_of_day,
  CASE WHEN isodow(ts_utc) >= 6 THEN 'weekend' ELSE 'weekday' END AS day_type,
  CASE WHEN ts_utc >= TIMESTAMP '2024-01-21' THEN 'third' WHEN ts_utc >= TIMESTAMP '2024-01-12' THEN 'second' WHEN ts_utc >= TIMESTAMP '2024-01-05' THEN 'first' ELSE 'unknown' END AS era,
  CASE source WHEN 'live' THEN 'live' WHEN 'archive' THEN 'other' ELSE 'unknown' END AS live,
  CASE WHEN pedestriancount >= 3 THEN 'many' WHEN pedestriancount >= 1 THEN 'few' ELSE 'none' END AS count_band FROM numbered WINDOW w AS (PARTITION BY location_id, run)""",
    "long": "SELECT location_id, ts_utc, pedestriancount, outage, dimension, \"group\" FROM sliced UNPIVOT (\"group\" FOR dimension IN (time_of_day, day_type, era, live, count_band))",
}
_DIMS = ("time_of_day", "day_type", "era", "live", "count_band")


@query("SELECT location_id, ts_utc, time_of_day, day_type, era, live, count_band, outage AS suspect_outage_zero FROM sliced", **_SLICED)
def row_slices(spark, sf):
    return _sliced(spark, sf).select("location_id", "ts_utc", *_DIMS, "suspect_outage_zero")


_SUMMARY = """SELECT dimension, "group", count(DISTINCT location_id) FILTER (WHERE NOT outage) AS n_sensors, count(*) FILTER (WHERE NOT outage) AS n_rows,
  CAST(sum(pedestriancount) FILTER (WHERE NOT outage) AS BIGINT) AS pedestrians, avg(pedestriancount) FILTER (WHERE NOT outage) AS mean_count,
  quantile_cont(pedestriancount, 0.5) FILTER (WHERE NOT outage) AS median_count, quantile_cont(pedestriancount, 0.9) FILTER (WHERE NOT outage) AS p90_count,
  avg(CASE WHEN pedestriancount = 0 THEN 1 ELSE 0 END) FILTER (WHERE NOT outage) AS zero_share, avg(CASE WHEN outage THEN 1 ELSE 0 END) AS outage_share FROM long GROUP BY 1, 2"""
_R = {n: f"round({n}, 9) AS {n}" for n in ("mean_count", "median_count", "p90_count", "zero_share", "outage_share", "row_share", "sensor_share", "pedestrian_share", "reference_share", "ratio")}


def _rounded(df):
    return df.withColumns({c: F.round(c, 9) for c, t in df.dtypes if t == "double"})


@query(
    f"""SELECT dimension, "group", n_sensors, n_rows, pedestrians, {", ".join(_R.values())}, n_sensors < 5 OR coalesce(ratio < 0.5, false) AS thin FROM (
  SELECT s.*, n_rows / sum(n_rows) OVER d AS row_share, n_sensors / (SELECT count(DISTINCT location_id) FROM sliced WHERE NOT outage) AS sensor_share,
    pedestrians / nullif(sum(pedestrians) OVER d, 0) AS pedestrian_share, r.share AS reference_share,
    CASE WHEN r.share IS NOT NULL THEN n_rows END / sum(CASE WHEN r.share IS NOT NULL THEN n_rows END) OVER d / r.share AS ratio
  FROM s LEFT JOIN (SELECT 'time_of_day' AS dimension, g, w / 24 AS share FROM (VALUES ('night', 6), ('morning_peak', 4), ('midday', 6), ('evening_peak', 4), ('late_evening', 4)) AS v(g, w)) r
    ON r.dimension = s.dimension AND r.g = s."group" WINDOW d AS (PARTITION BY s.dimension))""",
    **_SLICED, s=_SUMMARY,
)
def slice_representation(spark, sf):
    ref = spark.createDataFrame([("time_of_day", n, float(z - a)) for n, (a, z) in slices.TIMES.items()], "dimension string, group string, weight double")
    return _rounded(representation.summarize(_sliced(spark, sf), _DIMS, "location_id", "pedestriancount", "suspect_outage_zero", ref))


@query('SELECT time_of_day AS group_a, day_type AS group_b, count(*) AS n_rows, quantile_cont(pedestriancount, 0.5) AS median_count, count(*) / sum(count(*)) OVER () AS row_share FROM sliced WHERE NOT outage GROUP BY 1, 2', **_SLICED)
def slice_crosstab(spark, sf):
    return representation.crosstab(_sliced(spark, sf).where("not suspect_outage_zero"), "time_of_day", "day_type", "pedestriancount")


@query("SELECT location_id, " + ", ".join(f"quantile_cont(pedestriancount, 0.5) FILTER (WHERE hour(ts_utc) = {h}) AS \"{h}\"" for h in (6, 12, 18)) + " FROM v_hourly GROUP BY 1")
def heat_map_pivot(spark, sf):
    return representation.heat_map(v_hourly(spark, sf).withColumn("hour", F.hour("ts_utc")), "location_id", "hour", (6, 12, 18), "pedestriancount")


@query("SELECT year, count(*) AS n_rows, count(DISTINCT property) AS n_sensors, CAST(sum(o_orderkey) AS BIGINT) AS pedestrians, count(*) / sum(count(*)) OVER () AS row_share FROM v_years GROUP BY 1")
def coverage_by_year(spark, sf):
    return representation.coverage_by_year(v_years(spark, sf), "year", "property", "o_orderkey")


@query("SELECT 'f' || CAST(u % 3 AS VARCHAR) AS \"group\", sum(length_m) AS weight FROM v_lattice GROUP BY 1")
def length_reference(spark, sf):
    from .views import v_lattice

    return representation.length_reference(v_lattice(spark, sf).withColumn("f", F.concat(F.lit("f"), F.col("u") % 3)), "f", "length_m")


@query("SELECT source, sum(pedestriancount) / (sum(pedestriancount) + sum(location_id)) AS completeness FROM v_hourly GROUP BY 1")
def band_completeness(spark, sf):
    return representation.completeness(v_hourly(spark, sf), "source", "pedestriancount", "location_id")


_TIER = "CASE WHEN 3 * (row_number() OVER (ORDER BY v, k) - 1) <= count(*) OVER () - 1 THEN 'low' WHEN 3 * (row_number() OVER (ORDER BY v, k) - 1) <= 2 * (count(*) OVER () - 1) THEN 'medium' ELSE 'high' END"


@query(f"SELECT k AS property, v AS n_orders, {_TIER} AS tier FROM (SELECT property AS k, count(*) AS v FROM v_years GROUP BY 1)")
def volume_tiers(spark, sf):
    return slices.tiers(v_years(spark, sf).groupBy("property").agg(F.count("*").alias("n_orders")), "property", "n_orders")


@query(f"SELECT k AS location_id, round(v, 9) AS mean_count, first_year, {_TIER} AS tier FROM (SELECT location_id AS k, avg(pedestriancount) FILTER (WHERE NOT outage) AS v, CAST(year(min(ts_utc)) AS INTEGER) AS first_year FROM sliced GROUP BY 1)", **_SLICED)
def sensor_slices(spark, sf):
    return _rounded(slices.sensor_slices(_sliced(spark, sf), "location_id", "ts_utc", "pedestriancount", "suspect_outage_zero"))


@query("SELECT location_id, ts_utc, CASE WHEN h > -1 AND h <= 5 THEN 'night' WHEN h > 5 AND h <= 9 THEN 'morning' WHEN h > 9 AND h <= 23 THEN 'day' END AS band FROM (SELECT *, hour(ts_utc) AS h FROM v_hourly)")
def right_closed_bands(spark, sf):
    return v_hourly(spark, sf).select("location_id", "ts_utc", slices.right_closed(F.hour("ts_utc"), (-1, 5, 9, 23), ("night", "morning", "day")).alias("band"))


@query("SELECT CAST(o_orderdate AS DATE) AS day, CASE WHEN count(DISTINCT o_orderstatus) > 1 THEN 'both' WHEN min(o_orderstatus) = 'F' THEN 'north' ELSE 'south' END AS stadium FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1")
def stadium_days(spark, sf):
    games = table(spark, sf, "orders").withColumn("day", F.to_date("o_orderdate"))
    return slices.stadium_days(games, "day", "o_orderstatus", {"F": "north", "O": "south"})


_M = {
    "m": "SELECT *, date_trunc('hour', sensing_datetime) AS ts_utc, minute(sensing_datetime) AS minute, minute(sensing_datetime) // 5 AS block FROM (SELECT *, row_number() OVER (PARTITION BY location_id, sensing_datetime ORDER BY polled_at DESC, direction_1 DESC, direction_2 DESC) AS r FROM v_minute) WHERE r = 1",
}
_HOURLY = "SELECT location_id, date_trunc('hour', ts_utc) AS ts_utc, pedestriancount + (location_id + hour(ts_utc)) % 3 AS pedestriancount FROM (SELECT location_id, date_trunc('hour', sensing_datetime) AS ts_utc, sum(total_of_directions) AS pedestriancount FROM m GROUP BY 1, 2)"
_STATUS = _M | {
    "h": "SELECT location_id, ts_utc, CAST(pedestriancount AS BIGINT) AS pedestriancount FROM (" + _HOURLY + ")",
    "edge": "SELECT CASE WHEN min(sensing_datetime) = min(ts_utc) THEN min(ts_utc) ELSE min(ts_utc) + INTERVAL 1 HOUR END AS first, least(max(ts_utc), (SELECT max(ts_utc) FROM h)) AS last FROM m",
    "status": """SELECT location_id, ts_utc, n AS count, s AS minute_sum, s IS NOT NULL AS in_archive, coalesce(abs(s - n) <= greatest(0.05 * n, 2), false) AS adds_up, true AS usable_sensor, coalesce(abs(s - n) <= greatest(0.05 * n, 2), false) AND n >= 4 AS kept FROM (
  SELECT h.location_id, h.ts_utc, h.pedestriancount AS n, CASE WHEN h.pedestriancount = 0 AND x.s IS NULL THEN 0 ELSE x.s END AS s FROM h JOIN edge ON h.ts_utc >= first AND h.ts_utc < last
  LEFT JOIN (SELECT location_id, ts_utc, CAST(sum(total_of_directions) AS BIGINT) AS s FROM m GROUP BY 1, 2) x ON x.location_id = h.location_id AND x.ts_utc = h.ts_utc)""",
    "grid": "SELECT location_id, ts_utc, " + ", ".join(f"CAST(coalesce(sum(total_of_directions) FILTER (WHERE block = {b}), 0) AS BIGINT) AS b{b}" for b in range(12)) + " FROM m JOIN (SELECT location_id, ts_utc FROM status WHERE kept) USING (location_id, ts_utc) GROUP BY 1, 2",
    "summary": "SELECT *, hour(l) AS hour_local, CASE WHEN isodow(l) >= 6 THEN 'weekend' ELSE 'weekday' END AS day_type, " + " + ".join(f"b{b}" for b in range(12)) + " AS total FROM (SELECT *, timezone('Australia/Melbourne', timezone('UTC', ts_utc)) AS l FROM grid)",
}
_S = minutes.Settings(min_count=4)


def _minutes(spark, sf):
    m = minutes.archive_minutes(v_minute(spark, sf), ZONE)
    sums = m.groupBy("location_id", "ts_utc").agg(F.sum("total_of_directions").alias("pedestriancount"))
    return m, sums.withColumn("pedestriancount", F.col("pedestriancount") + (F.col("location_id") + F.hour("ts_utc")) % 3)


def _summary(spark, sf):
    m, h = _minutes(spark, sf)
    kept = minutes.hour_status(m, h, None, _S).where("kept").select("location_id", "ts_utc")
    return minutes.hour_summary(minutes.minute_grid(m, kept), ZONE)


_REPORT = """SELECT location_id, n_rows, CASE WHEN on_start >= 0.99 THEN '5min' ELSE '1min' END AS resolution, array_to_string([CAST(b * 5 AS VARCHAR) || '-' || CAST(b * 5 + 4 AS VARCHAR) FOR b IN range(12) IF n_rows >= 300 AND NOT list_contains(blocks, b)], ',') AS missing_blocks,
  n_rows < 300 OR len([b FOR b IN range(12) IF NOT list_contains(blocks, b)]) = 0 AS usable FROM (SELECT location_id, count(*) AS n_rows, avg(CASE WHEN minute % 5 = 0 THEN 1 ELSE 0 END) AS on_start, list(DISTINCT block) AS blocks FROM m2 GROUP BY 1)"""


@query(_REPORT, **_M, m2="SELECT * FROM m WHERE NOT (location_id = 3 AND block IN (2, 7)) AND NOT (location_id = 5 AND minute % 5 <> 0)")
def sensor_reporting(spark, sf):
    m, _ = _minutes(spark, sf)
    return minutes.sensor_reporting(m.where("not (location_id = 3 and block in (2, 7)) and not (location_id = 5 and minute % 5 <> 0)"))


_NEED = _STATUS


@query("SELECT * FROM status", **_NEED)
def hour_status(spark, sf):
    m, h = _minutes(spark, sf)
    return minutes.hour_status(m, h, None, _S)


@query("SELECT * FROM grid", **_NEED)
def minute_grid(spark, sf):
    m, h = _minutes(spark, sf)
    return minutes.minute_grid(m, minutes.hour_status(m, h, None, _S).where("kept").select("location_id", "ts_utc"))


@query(
    """SELECT location_id, ts_utc, round(4 * greatest(b0 + b1 + b2, b3 + b4 + b5, b6 + b7 + b8, b9 + b10 + b11) / greatest(total, 1), 9) AS peak15, round(greatest(b0, b1, b2, b3, b4, b5, b6, b7, b8, b9, b10, b11) / greatest(total, 1), 9) AS top_block_share,
  CAST(hour_local AS INTEGER) AS hour_local, day_type FROM summary""",
    **_NEED,
)
def hour_summary(spark, sf):
    return _rounded(_summary(spark, sf).select("location_id", "ts_utc", "peak15", "top_block_share", "hour_local", "day_type"))


_LONG = "SELECT location_id, day_type, hour_local, total, 5 * CAST(substr(name, 2) AS INTEGER) AS block_start, n FROM summary UNPIVOT (n FOR name IN (b0, b1, b2, b3, b4, b5, b6, b7, b8, b9, b10, b11))"


@query("SELECT location_id, day_type, CAST(hour_local AS INTEGER) AS hour_local, block_start, round(avg(n / greatest(total, 1)), 9) AS share, count(*) AS n_hours FROM u GROUP BY ALL", **_NEED, u=_LONG)
def minute_profiles(spark, sf):
    return _rounded(minutes.profiles(_summary(spark, sf), ["location_id", "day_type", "hour_local"]))


@query(
    """SELECT day_type, CAST(hour_local AS INTEGER) AS hour_local, block_start, round(sum(n) / nullif(sum(sum(n)) OVER c, 0), 9) AS share, CAST(sum(sum(n)) OVER c AS BIGINT) AS people, count(*) AS n_hours,
  count(DISTINCT location_id) AS n_sensors, sum(sum(n)) OVER c >= 100 AS usable FROM u GROUP BY day_type, hour_local, block_start WINDOW c AS (PARTITION BY day_type, hour_local)""",
    **_NEED, u=_LONG,
)
def pooled_profiles(spark, sf):
    return _rounded(minutes.pooled_profiles(_summary(spark, sf), ["day_type", "hour_local"]))


@query(
    """SELECT dimension, "group", count(*) AS sensor_hours, count(DISTINCT location_id) AS sensors, round(avg(in_archive::INT), 9) AS in_archive_share, round(avg(adds_up::INT), 9) AS adds_up_share, round(avg(kept::INT), 9) AS kept_share,
  round(avg(kept::INT) / (SELECT avg(kept::INT) FROM status), 9) AS kept_ratio, count(*) >= 48 AND avg(kept::INT) / (SELECT avg(kept::INT) FROM status) < 0.5 AS under
FROM (SELECT *, CASE WHEN hour(ts_utc) < 6 THEN 'early' ELSE 'late' END AS part, 'l' || CAST(location_id % 3 AS VARCHAR) AS place FROM status) UNPIVOT ("group" FOR dimension IN (part, place)) GROUP BY 1, 2""",
    **_NEED,
)
def coverage_by_slice(spark, sf):
    m, h = _minutes(spark, sf)
    status = minutes.hour_status(m, h, None, _S).withColumns({"part": F.when(F.hour("ts_utc") < 6, "early").otherwise("late"), "place": F.concat(F.lit("l"), F.col("location_id") % 3)})
    return _rounded(minutes.coverage(status, ["part", "place"]))


@query(
    """SELECT count(*) AS n_compared, coalesce(avg(CASE WHEN abs(x.s - h.pedestriancount) > greatest(0.05 * h.pedestriancount, 2) THEN 1 ELSE 0 END), 0) AS mismatch_share
FROM (SELECT location_id, ts_utc, sum(total_of_directions) AS s FROM m GROUP BY 1, 2) x JOIN edge ON x.ts_utc >= first AND x.ts_utc < last JOIN hh h ON x.location_id = h.location_id AND x.ts_utc = h.ts_utc""",
    **{k: _NEED[k] for k in ("m", "h", "edge")}, hh="SELECT location_id, ts_utc, pedestriancount + CASE WHEN location_id = 2 THEN 3 ELSE 0 END AS pedestriancount FROM h",
)
def archive_reconcile(spark, sf):
    m, h = _minutes(spark, sf)
    return minutes.reconcile(m, h.withColumn("pedestriancount", F.col("pedestriancount") + F.when(F.col("location_id") == 2, 3).otherwise(0)))


@query(
    """SELECT CAST(l AS DATE) AS day, strftime(max(l), '%H:%M') AS last_local FROM (
  SELECT CASE WHEN day(l) % 4 = 0 AND hour(l) >= 20 THEN l - INTERVAL 5 HOUR ELSE l END AS l FROM (SELECT timezone('Australia/Melbourne', timezone('UTC', sensing_datetime)) AS l FROM m))
WHERE CAST(l AS DATE) < DATE '2024-01-28' GROUP BY 1 HAVING strftime(max(l), '%H:%M') < '23:00'""",
    **_M,
)
def late_polls(spark, sf):
    """Of every sensor; the evenings of some days are moved back, so that these end early."""
    m, _ = _minutes(spark, sf)
    local = clock.to_local(F.col("sensing_datetime"), ZONE)
    early = F.timestamp_add("HOUR", F.lit(-5), "sensing_datetime")
    m = m.withColumn("sensing_datetime", F.when((F.dayofmonth(local) % 4 == 0) & (F.hour(local) >= 20), early).otherwise(F.col("sensing_datetime")))
    return minutes.late_days(m, F.to_date(F.lit("2024-01-28")), ZONE)


@query("SELECT location_id, round(1 - sum(n) / sum(s), 9) AS missing_hours_share, CASE WHEN 1 - sum(n) / sum(s) >= 0.2 THEN 'gappy' WHEN 1 - sum(n) / sum(s) >= 0.05 THEN 'some' ELSE 'full' END AS band FROM (SELECT location_id, source, date_diff('hour', min(ts_utc), max(ts_utc)) + 1 AS s, count(*) AS n FROM v_hourly GROUP BY 1, 2) GROUP BY 1")
def missing_hours_band(spark, sf):
    share = missing_share(v_hourly(spark, sf), "location_id", "ts_utc", "source")
    return _rounded(share.withColumn("band", slices.bins(F.col("missing_hours_share"), (-1, 0.05, 0.2), ("full", "some", "gappy"))))
