"""Queries of events and egress, scores, drift and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import checks, cleaning, drift, events, metrics
from .slice_queries import _M
from .views import sql, table, v_events, v_hourly, v_minute, v_scored

QUERIES, ORACLES = {}, {}


def query(oracle: str | None, **ctes: str):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = sql(oracle, **ctes)
        return f

    return add


_TIMED = {
    "timed": """SELECT event_id, venue, kind, start_local, coalesce(end_local, start_local + CASE kind WHEN 'concert' THEN 180 WHEN 'football' THEN 120 ELSE 420 END * INTERVAL 1 MINUTE) AS end_local FROM v_events""",
}
_HOURS = _TIMED | {
    "spans": """SELECT venue, 'pre' AS phase, start_local - INTERVAL 2 HOUR AS a, start_local AS z FROM timed UNION ALL SELECT venue, 'during', start_local, end_local FROM timed UNION ALL SELECT venue, 'post', end_local, end_local + INTERVAL 2 HOUR FROM timed""",
    "vh": "SELECT DISTINCT unnest(generate_series(date_trunc('hour', a), date_trunc('hour', z - INTERVAL 1 SECOND), INTERVAL 1 HOUR)) AS hour, venue, phase FROM spans",
}


def _timed(spark, sf):
    return events.timed_events(v_events(spark, sf), "start_local", "end_local", "kind")


@query("SELECT event_id, venue, kind, start_local, end_local FROM timed", **_TIMED)
def timed_events(spark, sf):
    return _timed(spark, sf)


@query("SELECT hour, venue, phase FROM vh", **_HOURS)
def venue_hours(spark, sf):
    return events.venue_hours(_timed(spark, sf), "start_local", "end_local")


@query("SELECT DISTINCT CAST(start_local AS DATE) AS day, venue FROM v_events")
def venue_days(spark, sf):
    return events.venue_days(v_events(spark, sf), "start_local")


_DIST = {"dist": "SELECT 'venue' || CAST(v AS VARCHAR) AS venue, s AS segment_id, CAST((v * 1100 + s * 700) % 4000 AS DOUBLE) AS dist_m FROM range(4) AS a(v), range(6) AS b(s)"}


def _dist(spark):
    return spark.range(4).withColumnRenamed("id", "v").crossJoin(spark.range(6).withColumnRenamed("id", "s")).select(
        F.concat(F.lit("venue"), F.col("v")).alias("venue"), F.col("s").alias("segment_id"), ((F.col("v") * 1100 + F.col("s") * 700) % 4000).cast("double").alias("dist_m")
    )


_ROWS = {"rr": "SELECT o_orderkey AS row_id, o_orderdate + CAST(o_orderkey % 24 AS INTEGER) * INTERVAL 1 HOUR AS hour, o_custkey % 6 AS segment FROM orders"}


@query(
    """SELECT row_id, hour, segment, """
    + ", ".join(f"coalesce(bool_or(dist_m < 3000) FILTER (WHERE phase = '{p}'), false) AS event_{p}" for p in ("pre", "during", "post"))
    + """, least(coalesce(min(dist_m) FILTER (WHERE phase IS NOT NULL), 3000), 3000) AS event_dist_m,
  least(coalesce((SELECT min(d.dist_m) FROM (SELECT DISTINCT CAST(start_local AS DATE) AS day, venue FROM v_events) e JOIN dist d ON d.venue = e.venue WHERE e.day = CAST(j.hour AS DATE) AND d.segment_id = j.segment), 3000), 3000) AS event_day_dist_m
FROM (SELECT r.row_id, r.hour, r.segment, vh.phase, d.dist_m FROM rr r LEFT JOIN vh ON vh.hour = r.hour LEFT JOIN dist d ON d.venue = vh.venue AND d.segment_id = r.segment) j GROUP BY row_id, hour, segment""",
    **_HOURS, **_DIST, **_ROWS,
)
def event_features(spark, sf):
    o = table(spark, sf, "orders")
    rows = o.select(F.col("o_orderkey").alias("row_id"), F.timestamp_add("HOUR", (F.col("o_orderkey") % 24).cast("int"), "o_orderdate").alias("hour"), (F.col("o_custkey") % 6).alias("segment"))
    hours = events.venue_hours(_timed(spark, sf), "start_local", "end_local")
    return events.event_features(rows, ["row_id"], "hour", "segment", hours, events.venue_days(v_events(spark, sf), "start_local"), _dist(spark))


@query("SELECT CAST(start_local AS DATE) AS date_local, string_agg(DISTINCT kind, ',' ORDER BY kind) AS kinds, string_agg(DISTINCT venue, ',' ORDER BY venue) AS venues FROM v_events GROUP BY 1")
def event_days(spark, sf):
    return events.event_calendar(v_events(spark, sf), "start_local", "kind")


@query("SELECT event_id, count(*) OVER (PARTITION BY CAST(start_local AS DATE)) - 1 AS n_others FROM v_events")
def concurrent_events(spark, sf):
    return events.concurrent(v_events(spark, sf).withColumn("day", F.to_date("start_local")), "day").select("event_id", "n_others")


_BLOCKS = _M | {
    "blocks": "SELECT location_id, time_bucket(INTERVAL 5 MINUTE, sensing_datetime) AS block, CAST(sum(total_of_directions) AS BIGINT) AS total FROM m GROUP BY 1, 2",
    "nights": "SELECT CAST(h AS DATE) AS night, 'show' || CAST(day(h) AS VARCHAR) AS event, h AS start_local FROM generate_series(TIMESTAMP '2024-01-02 18:30:00', TIMESTAMP '2024-01-28 18:30:00', INTERVAL 2 DAY) AS t(h)",
    "series": "SELECT night, event, location_id, block, total, date_diff('minute', start_local, block) AS minutes_after_start FROM blocks JOIN nights ON block >= start_local + INTERVAL 150 MINUTE AND block < start_local + INTERVAL 300 MINUTE",
}


def _blocks(spark, sf):
    m = cleaning.latest_poll(v_minute(spark, sf), ["location_id", "sensing_datetime"], "polled_at", ["direction_1", "direction_2"])
    return events.blocks(m, "location_id", "sensing_datetime", ["total_of_directions"]).withColumnRenamed("total_of_directions", "total")


def _series(spark, sf):
    nights = spark.range(14).select(F.timestamp_add("DAY", (F.col("id") * 2).cast("int"), F.lit("2024-01-02 18:30:00").cast("timestamp_ntz")).alias("start_local"))
    nights = nights.select(F.to_date("start_local").alias("night"), F.concat(F.lit("show"), F.dayofmonth("start_local")).alias("event"), "start_local")
    return events.egress_series(_blocks(spark, sf), nights, "start_local").select("night", "event", "location_id", "block", "total", "minutes_after_start")


@query("SELECT * FROM blocks", **_BLOCKS)
def five_minute_blocks(spark, sf):
    return _blocks(spark, sf)


@query("SELECT * FROM series", **_BLOCKS)
def egress_series(spark, sf):
    return _series(spark, sf)


@query(
    """SELECT s.*, date_diff('minute', l.lead, s.peak_block) AS peak_delay_min FROM e s LEFT JOIN (SELECT night, max(peak_block) AS lead FROM e WHERE location_id = 1 GROUP BY 1) l ON l.night = s.night""",
    **_BLOCKS,
    e="""SELECT night, event, location_id, count(*) AS n_blocks, CAST(sum(total) AS BIGINT) AS total, first(block ORDER BY total DESC, block) AS peak_block, max(total) AS peak_count FROM series GROUP BY 1, 2, 3""",
)
def egress_summary(spark, sf):
    return events.egress_summary(_series(spark, sf), "night", "event", "location_id", "total", F.col("location_id") == 1)


@query(
    "SELECT location_id, CAST(hour(ts_utc) AS INTEGER) AS hour, quantile_cont(pedestriancount, 0.25) AS usual FROM v_hourly WHERE CAST(ts_utc AS DATE) IN (DATE '2024-01-22', DATE '2024-01-15', DATE '2024-01-01') AND hour(ts_utc) IN (20, 21, 22) GROUP BY 1, 2"
)
def usual_background(spark, sf):
    return events.background(v_hourly(spark, sf), "location_id", "ts_utc", "pedestriancount", "2024-01-29", (20, 21, 22), 4, ["2024-01-08"], 0.25)


@query(
    """SELECT location_id, CAST(sum(o) AS BIGINT) AS observed_total, CAST(sum(s) AS BIGINT) AS simulated_total, CASE WHEN sum(o) > 0 THEN first(block ORDER BY o DESC, block) END AS obs_peak_block, CASE WHEN sum(s) > 0 THEN first(block ORDER BY s DESC, block) END AS sim_peak_block,
  CASE WHEN stddev_samp(o) > 0 AND stddev_samp(s) > 0 THEN round(corr(o, s), 3) END AS correlation FROM (
  SELECT coalesce(a.location_id, b.location_id) AS location_id, coalesce(a.block, b.block) AS block, coalesce(CAST(a.total AS DOUBLE), 0) AS o, coalesce(CAST(b.total AS DOUBLE), 0) AS s
  FROM (SELECT * FROM blocks WHERE CAST(block AS DATE) < DATE '2024-01-06') a FULL JOIN (SELECT * FROM blocks WHERE minute(block) < 30 AND CAST(block AS DATE) < DATE '2024-01-07') b ON a.location_id = b.location_id AND a.block = b.block) GROUP BY 1""",
    **_BLOCKS,
)
def compare_series(spark, sf):
    b = _blocks(spark, sf)
    return events.compare_series(b.where("minute(block) < 30 and to_date(block) < date'2024-01-07'"), b.where("to_date(block) < date'2024-01-06'"), "location_id", "block", "total")


@query(
    """SELECT coalesce(a.video, b.video) AS video, coalesce(a.w, b.w) AS "window", coalesce(n_in_view, 0) AS n_in_view, coalesce(n_first_seen, 0) AS n_first_seen FROM
  (SELECT video, w, count(DISTINCT track_id) AS n_in_view FROM t GROUP BY 1, 2) a FULL JOIN (SELECT video, w, count(*) AS n_first_seen FROM (SELECT video, track_id, min(w) AS w FROM t GROUP BY 1, 2) GROUP BY 1, 2) b ON a.video = b.video AND a.w = b.w""",
    t="SELECT event_type AS video, user_id AS track_id, event_id // 500 AS w FROM events WHERE event_id % 7 <> 0",
)
def track_windows(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_type").alias("video"), F.col("user_id").alias("track_id"), F.col("event_id").alias("frame"))
    return events.window_counts(e, 500, F.col("frame") % 7 == 0)


_DIMS = ("l_returnflag", "l_linestatus")
_LONG = {"long": 'SELECT location_id, y, pred, dimension, "group" FROM v_scored UNPIVOT ("group" FOR dimension IN (l_returnflag, l_linestatus))'}
_SCORE = """round(sum(abs(ln(1 + pred) - ln(1 + y))) / count(*), 7) AS log_mae, round(sum(abs(pred - y)) / sum(y), 7) AS wape, round(avg(abs(pred - y)), 7) AS mae, round(sqrt(avg((pred - y) ** 2)), 7) AS rmse, round((sum(pred) - sum(y)) / sum(y), 7) AS bias"""


def _r7(df):
    return df.withColumns({c: F.round(c, 7) for c, t in df.dtypes if t == "double"})


def _score_sql(source: str, by: str) -> str:
    """Scores of `source` by a column, from their definitions."""
    return f"""SELECT a.*, b.sensor_rank_corr, b.sensor_wape_median, b.sensor_wape_worst, b.n_sensors FROM (SELECT {by}, {_SCORE}, count(*) AS n_rows FROM {source} GROUP BY {by}) a JOIN (
  SELECT {by}, CASE WHEN count(*) >= 3 AND count(DISTINCT my) > 1 AND count(DISTINCT mp) > 1 THEN round(corr(ry, rp), 7) END AS sensor_rank_corr, round(quantile_cont(w, 0.5), 7) AS sensor_wape_median, round(max(w), 7) AS sensor_wape_worst, count(*) AS n_sensors FROM (
    SELECT {by}, w, my, mp, rank() OVER (PARTITION BY {by} ORDER BY my) + (count(*) OVER (PARTITION BY {by}, my) - 1) / 2 AS ry, rank() OVER (PARTITION BY {by} ORDER BY mp) + (count(*) OVER (PARTITION BY {by}, mp) - 1) / 2 AS rp FROM (
      SELECT {by}, location_id, sum(y) / count(*) AS my, round(sum(pred) / count(*), 9) AS mp, CASE WHEN sum(y) > 0 THEN sum(abs(pred - y)) / sum(y) END AS w FROM {source} GROUP BY {by}, location_id)) GROUP BY {by}) b USING ({by})"""


@query(_score_sql("(SELECT *, 1 AS part FROM v_scored)", "part"))
def score_overall(spark, sf):
    return _r7(metrics.score(v_scored(spark, sf).withColumn("part", F.lit(1)), ["part"], "location_id", "y", "pred"))


@query(
    f"""SELECT fold, {", ".join(f"round({c}, 7) AS {c}" for c in metrics.CV_METRICS)} FROM s UNION ALL SELECT NULL, {", ".join(f"round(avg({c}), 7)" for c in metrics.CV_METRICS)} FROM s""",
    s=_score_sql("v_scored", "fold").replace(", 7)", ", 15)"),
)
def cv_metrics(spark, sf):
    per = metrics.cv_metrics(v_scored(spark, sf), "fold", "location_id", "y", "pred")
    return per.withColumns({c: F.round(c, 7) for c in metrics.CV_METRICS})


@query(
    _score_sql("parts", "part") + " UNION ALL SELECT 'never', NULL, NULL, NULL, NULL, NULL, 0, NULL, NULL, NULL, 0",
    parts="SELECT *, 'all' AS part FROM v_scored UNION ALL SELECT *, 'old' FROM v_scored WHERE ts_utc < TIMESTAMP '1997-01-01' UNION ALL SELECT *, 'returned' FROM v_scored WHERE l_returnflag = 'R'",
)
def score_parts(spark, sf):
    parts = {"all": F.lit(True), "old": F.col("ts_utc") < F.lit("1997-01-01").cast("timestamp_ntz"), "returned": F.col("l_returnflag") == "R", "never": F.lit(False)}
    return _r7(metrics.score_parts(v_scored(spark, sf), parts, "location_id", "y", "pred"))


@query(
    """SELECT dimension, "group", round(wape, 7) AS wape, round(bias, 7) AS bias, round(mae, 7) AS mae, n_rows, n_sensors, round(min(wape) OVER d / max(wape) OVER d, 7) AS disparity_ratio FROM (
  SELECT dimension, "group", sum(abs(pred - y)) / sum(y) AS wape, (sum(pred) - sum(y)) / sum(y) AS bias, avg(abs(pred - y)) AS mae, count(*) AS n_rows, count(DISTINCT location_id) AS n_sensors FROM long GROUP BY 1, 2) WINDOW d AS (PARTITION BY dimension)""",
    **_LONG,
)
def slice_wape(spark, sf):
    return _r7(metrics.cell_metrics(metrics.cell_sums(v_scored(spark, sf), _DIMS, "location_id", "y", "pred"), "location_id"))


def _drawn_sql(rep: str, nth: str, below: str, seed: int = 7) -> str:
    """`metrics.random_number` in SQL: three squares modulo a prime."""
    x = f"(({rep} * 48271 + {nth} * 69621 + {seed * 16807 + 12345})::BIGINT % 2147483647)"
    for _ in range(3):
        x = f"(list_transform([{x}], lambda z: (z * z + {nth} * 40692 + {rep} + 1) % 2147483647)[1])"
    return f"({x} % {below})"


def _errors_ctes(reps: int) -> dict[str, str]:
    return _LONG | {
        "cells": """SELECT dimension, "group" AS g, location_id, sum(y)::DOUBLE AS y, sum(abs(pred - y)) AS e, row_number() OVER (PARTITION BY dimension, "group" ORDER BY location_id) - 1 AS nth, count(*) OVER (PARTITION BY dimension, "group") AS below FROM long GROUP BY 1, 2, 3""",
        "picks": f"SELECT dimension, g, rep, {_drawn_sql('rep', 'nth', 'below')} AS pick FROM cells, range({reps}) AS t(rep)",
        "boot": "SELECT p.dimension, p.g, rep, sum(e) / sum(y) AS w FROM picks p JOIN cells c ON c.dimension = p.dimension AND c.g = p.g AND c.nth = pick GROUP BY 1, 2, 3",
        "ci": "SELECT dimension, g, quantile_cont(w, 0.025) AS lo, quantile_cont(w, 0.975) AS hi FROM boot GROUP BY 1, 2",
        "errs": """SELECT *, min(wape) OVER d / max(wape) OVER d AS disparity_ratio, wape / overall AS wape_vs_overall, lo > overall AS worse FROM (
  SELECT dimension, "group" AS g, sum(abs(pred - y)) / sum(y) AS wape, (sum(pred) - sum(y)) / sum(y) AS bias, avg(abs(pred - y)) AS mae, count(*) AS n_rows, count(DISTINCT location_id) AS n_sensors FROM long GROUP BY 1, 2
  ) JOIN ci USING (dimension, g), (SELECT sum(abs(pred - y)) / sum(y) AS overall FROM v_scored) WINDOW d AS (PARTITION BY dimension)""",
    }


@query(
    """SELECT dimension, g AS "group", round(wape, 7) AS wape, round(bias, 7) AS bias, round(mae, 7) AS mae, n_rows, n_sensors, round(disparity_ratio, 7) AS disparity_ratio, round(lo, 7) AS wape_lo, round(hi, 7) AS wape_hi, round(wape_vs_overall, 7) AS wape_vs_overall, worse FROM errs""",
    **_errors_ctes(100),
)
def slice_errors_bootstrap(spark, sf):
    return _r7(metrics.slice_errors(v_scored(spark, sf), _DIMS, "location_id", "y", "pred", reps=100))


@query(
    """SELECT round(wape, 7) AS wape, round(bias, 7) AS bias, round(mae, 7) AS mae, 'none' AS mitigation, (SELECT count(*) FROM errs WHERE worse) AS groups_worse,
  (SELECT coalesce(string_agg(dimension || '=' || g, '; ' ORDER BY dimension || '=' || g), '') FROM errs WHERE worse) AS worse_groups,
  (SELECT string_agg(dimension || '=' || g || ' (' || printf('%.2f', wape) || ')', '; ' ORDER BY wape DESC) FROM (SELECT *, row_number() OVER (PARTITION BY dimension ORDER BY wape DESC, g) AS r FROM errs) WHERE r = 1) AS max_wape_group
FROM (SELECT sum(abs(pred - y)) / sum(y) AS wape, (sum(pred) - sum(y)) / sum(y) AS bias, avg(abs(pred - y)) AS mae FROM v_scored)""",
    **_errors_ctes(50),
)
def mitigation_summary(spark, sf):
    v = v_scored(spark, sf)
    overall = v.agg(metrics.wape("y", "pred").alias("wape"), metrics.bias_share("y", "pred").alias("bias"), metrics.mae("y", "pred").alias("mae"))
    return _r7(metrics.summarize_mitigation(metrics.slice_errors(v, _DIMS, "location_id", "y", "pred", reps=50), "none", overall))


_CAL = {
    "c": "SELECT *, ts_utc - min(ts_utc) OVER (PARTITION BY location_id) < INTERVAL 400 DAY AS in_window FROM v_scored",
    "k": "SELECT location_id AS l, CASE WHEN sum(pred) FILTER (WHERE in_window) > 0 THEN sum(y) FILTER (WHERE in_window) / sum(pred) FILTER (WHERE in_window) ELSE 1 END AS scale FROM c GROUP BY 1",
}


def _calibrated(spark, sf):
    return metrics.calibrate(metrics.calibration_window(v_scored(spark, sf), "location_id", "ts_utc", 400), "location_id", "y", "pred")


@query("SELECT row_id, location_id, in_window, round(pred * scale, 7) AS calibrated FROM c JOIN k ON l = location_id", **_CAL)
def calibrate(spark, sf):
    return _r7(_calibrated(spark, sf).select("row_id", "location_id", "in_window", "calibrated"))


@query("SELECT fold, round(sum(abs(pred * scale - y)) / sum(y), 7) AS wape, count(*) AS n_rows FROM c JOIN k ON l = location_id WHERE NOT in_window GROUP BY 1", **_CAL)
def calibrated_cv(spark, sf):
    return _r7(metrics.scored_rows(_calibrated(spark, sf)).groupBy("fold").agg(metrics.wape("y", "calibrated").alias("wape"), F.count("*").alias("n_rows")))


@query("SELECT row_id, round(w / avg(w) OVER (), 7) AS weight FROM (SELECT row_id, 1 / count(*) OVER (PARTITION BY location_id) AS w FROM v_scored)")
def weights_sensor_equal(spark, sf):
    return _r7(metrics.weights(v_scored(spark, sf), "sensor_equal", "location_id").select("row_id", "weight"))


@query("SELECT row_id, round(w / avg(w) OVER (), 7) AS weight FROM (SELECT row_id, 1 / count(*) OVER (PARTITION BY l_returnflag) AS w FROM v_scored)")
def weights_group_equal(spark, sf):
    return _r7(metrics.weights(v_scored(spark, sf), "group_equal", "location_id", "l_returnflag").select("row_id", "weight"))


@query(
    """SELECT row_id, round(w / avg(w) OVER (), 7) AS weight FROM (SELECT row_id, coalesce(CASE l_returnflag WHEN 'A' THEN 0.75 WHEN 'N' THEN 0.25 END, count(*) OVER g / count(*) OVER ()) / count(*) OVER g AS w FROM v_scored WINDOW g AS (PARTITION BY l_returnflag))"""
)
def weights_reference(spark, sf):
    ref = spark.createDataFrame([("A", 3.0), ("N", 1.0)], "group string, weight double")
    return _r7(metrics.weights(v_scored(spark, sf), "reference", "location_id", "l_returnflag", ref).select("row_id", "weight"))


_BAND = {"band": "SELECT *, pred * 0.9 AS lo, pred * 1.1 AS hi FROM v_scored"}


def _band(spark, sf):
    return v_scored(spark, sf).withColumns({"lo": F.col("pred") * 0.9, "hi": F.col("pred") * 1.1})


@query("SELECT fold, avg(CASE WHEN y BETWEEN lo AND hi THEN 1 ELSE 0 END) AS coverage, count(*) AS n_rows FROM band GROUP BY 1", **_BAND)
def interval_coverage(spark, sf):
    return metrics.interval_coverage(_band(spark, sf), ["fold"], "y", "lo", "hi")


@query("SELECT fold, round(quantile_cont(ln(1 + lo) - ln(1 + y), 0.9), 7) AS margin_low, round(quantile_cont(ln(1 + y) - ln(1 + hi), 0.9), 7) AS margin_high FROM band GROUP BY 1", **_BAND)
def interval_margins(spark, sf):
    return _r7(metrics.interval_margins(_band(spark, sf), ["fold"], "y", "lo", "hi"))


@query(
    "SELECT f AS for_fold, round(quantile_cont(ln(1 + lo) - ln(1 + y), 0.9), 7) AS margin_low, round(quantile_cont(ln(1 + y) - ln(1 + hi), 0.9), 7) AS margin_high FROM band JOIN (SELECT DISTINCT fold AS f FROM v_scored) ON f <> fold GROUP BY 1", **_BAND
)
def cross_fold_margins(spark, sf):
    return _r7(metrics.cross_fold_margins(_band(spark, sf), "fold", "y", "lo", "hi"))


@query("SELECT row_id, round(least(greatest(exp(ln(1 + lo) - 0.1) - 1, 0), pred), 6) AS lower, round(greatest(greatest(exp(ln(1 + hi) + 0.2) - 1, 0), pred), 6) AS upper FROM band", **_BAND)
def widened_bundle(spark, sf):
    a, z = metrics.widen(F.col("lo"), F.col("hi"), F.lit(0.1), F.lit(0.2))
    a, z = metrics.bounded(a, F.col("pred"), z)
    return _band(spark, sf).select("row_id", F.round(a, 6).alias("lower"), F.round(z, 6).alias("upper"))


@query("SELECT l_returnflag, round(2 * avg(CASE WHEN y > 0 THEN y * ln(y / greatest(pred, 1e-6)) ELSE 0 END - y + greatest(pred, 1e-6)), 6) AS deviance FROM v_scored GROUP BY 1")
def poisson_deviance(spark, sf):
    return v_scored(spark, sf).groupBy("l_returnflag").agg(F.round(metrics.poisson_deviance("y", "pred"), 6).alias("deviance"))


@query("SELECT l_returnflag, round(avg(greatest(0.9 * (y - pred), -0.1 * (y - pred))), 7) AS loss FROM v_scored GROUP BY 1")
def pinball(spark, sf):
    return v_scored(spark, sf).groupBy("l_returnflag").agg(F.round(metrics.pinball("y", "pred", 0.9), 7).alias("loss"))


@query(
    """SELECT k, round(quantile_cont(wape, 0.5), 7) AS median, round(quantile_cont(wape, 0.25), 7) AS lower, round(quantile_cont(wape, 0.75), 7) AS upper FROM (
  SELECT k, rep, sum(abs(pred * scale - y)) / sum(y) AS wape FROM v_scored v JOIN (SELECT * FROM ranked WHERE place > k) r ON r.location_id = v.location_id JOIN scales USING (k, rep) GROUP BY 1, 2) GROUP BY 1""",
    per="SELECT location_id, sum(y)::DOUBLE AS sy, sum(pred) AS sp FROM v_scored GROUP BY 1",
    ranked=f"SELECT *, row_number() OVER (PARTITION BY k, rep ORDER BY {_drawn_sql('rep', 'location_id', '2147483647')}, location_id) AS place FROM per, (VALUES (1), (3), (5)) AS a(k), range(10) AS t(rep)",
    scales="SELECT k, rep, sum(sy) / sum(sp) AS scale FROM ranked WHERE place <= k GROUP BY 1, 2",
)
def calibration_curve(spark, sf):
    return _r7(metrics.calibration_curve(v_scored(spark, sf), "location_id", "y", "pred", (1, 3, 5), 10))


_CAND = {"cand": "SELECT 'm' || CAST(fold AS VARCHAR) AS model, avg(abs(ln(1 + pred) - ln(1 + y))) AS log_mae, max(pred / y) - min(location_id) / 100 AS ratio FROM v_scored GROUP BY 1"}


def _candidates(spark, sf):
    return v_scored(spark, sf).groupBy(F.concat(F.lit("m"), F.col("fold")).alias("model")).agg(metrics.log_mae("y", "pred").alias("log_mae"), (F.max(F.col("pred") / F.col("y")) - F.min("location_id") / 100).alias("ratio"))


@query("SELECT model, round(log_mae, 7) AS log_mae, round(ratio, 7) AS ratio FROM cand WHERE log_mae <= 1.03 * (SELECT min(log_mae) FROM cand)", **_CAND)
def candidate_shortlist(spark, sf):
    return _r7(metrics.shortlist(_candidates(spark, sf)))


@query("SELECT model, round(log_mae, 7) AS log_mae, round(ratio, 7) AS ratio FROM cand ORDER BY cand.ratio, cand.log_mae LIMIT 1", **_CAND)
def candidate_choice(spark, sf):
    return _r7(metrics.choose(_candidates(spark, sf), "ratio"))


_NUM = ("l_quantity", "l_extendedprice", "l_discount")


_DECILES = "[0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]"


@query(
    "SELECT column_name, kind, place, round(value, 7) AS value, round(null_share, 7) AS null_share, n_distinct FROM (" + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, kind, unnest(range(len(l))) AS place, unnest(l) AS value, null_share, n_distinct FROM (
  SELECT 'quantile' AS kind, quantile_cont({c}, [0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99]) AS l, avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS null_share, count(DISTINCT {c}) AS n_distinct FROM lineitem
  UNION ALL SELECT 'edge', list_sort(list_distinct(quantile_cont({c}, {_DECILES}))), avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END), count(DISTINCT {c}) FROM lineitem)""" for c in _NUM) + ")"
)
def reference_quantiles(spark, sf):
    """A row for each quantile and each edge of a column."""
    got = drift.reference_quantiles(table(spark, sf, "lineitem"), _NUM)
    parts = [got.select("column_name", F.lit(kind).alias("kind"), F.posexplode(values).alias("place", "value"), "null_share", "n_distinct") for kind, values in (("quantile", "quantiles"), ("edge", "edges"))]
    out = parts[0].unionByName(parts[1])
    return out.select("column_name", "kind", F.col("place").cast("long").alias("place"), F.round("value", 7).alias("value"), F.round("null_share", 7).alias("null_share"), "n_distinct")


def _psi_sql(c: str, many: bool) -> str:
    cell = f"(SELECT count(*) FROM unnest((SELECT list_slice(e, 2, len(e) - 1) FROM (SELECT list_sort(list_distinct(quantile_cont({c}, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]))) AS e FROM ref))) AS t(x) WHERE x <= {c})" if many else c
    return f"""SELECT '{c}' AS column_name, sum((greatest(a, 1e-4) - greatest(e, 1e-4)) * ln(greatest(a, 1e-4) / greatest(e, 1e-4))) AS psi FROM (
  SELECT coalesce(max(x.s), 0) AS e, coalesce(sum(y.s), 0) AS a FROM (SELECT {cell} AS k, count(*) / (SELECT count(*) FROM ref) AS s FROM ref GROUP BY 1) x
  FULL JOIN (SELECT {cell} AS k, count(*) / (SELECT count(*) FROM cur) AS s FROM cur GROUP BY 1) y ON x.k = y.k GROUP BY x.k)"""


@query(
    f"SELECT column_name, round(psi, 7) AS psi, psi > 0.25 AS drifted FROM ({_psi_sql('l_quantity', True)} UNION ALL {_psi_sql('l_extendedprice', True)} UNION ALL {_psi_sql('l_discount', False)})",
    ref="SELECT * FROM lineitem WHERE l_discount < 0.09", cur="SELECT * FROM lineitem WHERE l_quantity > 20 AND l_linenumber < 4",
)
def psi_drift(spark, sf):
    i = table(spark, sf, "lineitem")
    return _r7(drift.drift(i.where("l_discount < 0.09"), i.where("l_quantity > 20 and l_linenumber < 4"), _NUM))


def _profile_sql(c: str, kind: str) -> str:
    d = "CAST(NULL AS DOUBLE)"
    nums = f"round(min({c})::DOUBLE, 4), round(max({c})::DOUBLE, 4), round(avg({c}), 4), round(stddev_samp({c}), 4), round(quantile_cont({c}, 0.5), 4)" if kind in ("int", "bigint", "double") else ", ".join([d] * 5)
    times = f"CAST(min({c}) AS VARCHAR), CAST(max({c}) AS VARCHAR)" if kind.startswith("timestamp") else "CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR)"
    n = f"count(DISTINCT {c})" if kind == "string" else "CAST(NULL AS BIGINT)"
    return f"SELECT '{c}', '{kind}', round(avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END), 4), {d}, {nums}, {times}, {n} FROM v_hourly"


@query(
    "SELECT * FROM (" + " UNION ALL ".join(_profile_sql(c, k) for c, k in (("location_id", "int"), ("ts_utc", "timestamp_ntz"), ("pedestriancount", "bigint"), ("source", "string"))) + ") AS t(column_name, data_type, null_share, true_share, min, max, mean, std, median, first, last, n_distinct)"
)
def column_profile(spark, sf):
    return drift.profile(v_hourly(spark, sf).select("location_id", "ts_utc", "pedestriancount", "source"))


@query(
    """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n_rows DESC, value) AS place FROM (SELECT column_name, value, count(*) AS n_rows FROM (SELECT p_brand, p_type FROM part) UNPIVOT (value FOR column_name IN (p_brand, p_type)) GROUP BY 1, 2)) WHERE place <= 5"""
)
def top_values(spark, sf):
    return drift.top_values(table(spark, sf, "part"), ["p_brand", "p_type"]).withColumn("place", F.col("place").cast("bigint"))


@query("SELECT '2024-02-01' AS run_at, count(*) AS n_rows, count(DISTINCT location_id) AS n_sensors, min(ts_utc) AS first_hour, max(ts_utc) AS last_hour, round(avg(pedestriancount), 4) AS mean_count FROM v_hourly")
def run_summary(spark, sf):
    return drift.history_row(v_hourly(spark, sf), "2024-02-01", "location_id", "ts_utc", "pedestriancount")


@query(
    """SELECT 'drift: rows dropped' AS name, 'error' AS severity, (p.n - c.n) / p.n <= 0.01 AS passed, CAST(p.n AS DOUBLE) AS previous, CAST(c.n AS DOUBLE) AS "current" FROM p, c
UNION ALL SELECT 'drift: no fewer sensors', 'warning', c.s >= p.s, p.s, c.s FROM p, c UNION ALL SELECT 'drift: mean count changed', 'warning', abs(c.m - p.m) / p.m <= 0.2, p.m, c.m FROM p, c""",
    p="SELECT count(*) AS n, count(DISTINCT location_id) AS s, round(avg(pedestriancount), 4) AS m FROM v_hourly",
    c="SELECT count(*) AS n, count(DISTINCT location_id) AS s, round(avg(pedestriancount), 4) AS m FROM v_hourly WHERE location_id < 7",
)
def run_drift(spark, sf):
    v = v_hourly(spark, sf)
    now, before = (drift.history_row(d, "r", "location_id", "ts_utc", "pedestriancount") for d in (v.where("location_id < 7"), v))
    return checks.run_drift(now, before)


_SUITE = checks.Suite(
    keys=("location_id", "ts_utc"), never_missing=("location_id", "source"), required_when={"source": ("pedestriancount", ">", 2)}, ranges={"pedestriancount": (0, 5), "absent": (0, 1)}, allowed={"source": ("archive", "live")}, mostly={"seen": 0.9},
)
_HELD = {"held": "SELECT *, CASE WHEN location_id <> 2 THEN 1 END AS seen FROM v_hourly UNION ALL SELECT *, 1 FROM v_hourly WHERE location_id = 3 AND hour(ts_utc) = 5"}


def _held(spark, sf):
    v = v_hourly(spark, sf)
    return v.withColumn("seen", F.when(F.col("location_id") != 2, 1)).unionByName(v.where("location_id = 3 and hour(ts_utc) = 5").withColumn("seen", F.lit(1)))


def _check(name: str, severity: str, bad: str, look: str = "true", share: float = 0.0) -> str:
    b, n = f"count(*) FILTER (WHERE ({look}) AND ({bad}))", f"count(*) FILTER (WHERE {look})"
    return f"SELECT '{name}' AS name, '{severity}' AS severity, {b} <= {share} * {n} AS passed, {b} AS n_bad, {n} AS n_rows FROM held"


@query(
    " UNION ALL ".join([
        _check("present: location_id", "error", "location_id IS NULL"), _check("present: source", "error", "source IS NULL"), _check("present: source where pedestriancount > 2", "error", "source IS NULL", "pedestriancount > 2"),
        _check("range: pedestriancount in [0, 5]", "error", "pedestriancount NOT BETWEEN 0 AND 5", "pedestriancount IS NOT NULL"), _check("allowed: source", "error", "source NOT IN ('archive', 'live')", "source IS NOT NULL"),
        _check("present: seen (>= 90%)", "warning", "seen IS NULL", share=0.1),
    ]) + " UNION ALL SELECT 'keys: unique location_id+ts_utc', 'error', coalesce(sum(n) FILTER (WHERE n > 1), 0) = 0, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT), CAST(sum(n) AS BIGINT) FROM (SELECT count(*) AS n FROM held GROUP BY location_id, ts_utc)", **_HELD,
)
def check_report(spark, sf):
    return checks.run_suite(_held(spark, sf), _SUITE)


@query(
    """SELECT * FROM (VALUES ('schema: no column missing', 'error', false, 'absent'), ('schema: no column unexpected', 'error', false, 'seen'), ('schema: no column retyped', 'error', false, 'location_id: bigint -> int')) AS t(name, severity, passed, detail)"""
)
def schema_report(spark, sf):
    return checks.schema_checks(_held(spark, sf), {"location_id": "bigint", "ts_utc": "timestamp_ntz", "pedestriancount": "bigint", "source": "string", "absent": "int"})


@query("SELECT 'anomaly: the table is fresh' AS name, 'warning' AS severity, date_diff('second', max(ts_utc), TIMESTAMP '2024-02-03 06:00:00') / 86400 <= 5 AS passed, date_diff('second', max(ts_utc), TIMESTAMP '2024-02-03 06:00:00') / 86400 AS observed FROM v_hourly")
def freshness(spark, sf):
    return checks.freshness(v_hourly(spark, sf), "ts_utc", F.lit("2024-02-03 06:00:00").cast("timestamp_ntz"))


@query("SELECT 'anomaly: share of outage zeros' AS name, 'warning' AS severity, avg(CASE WHEN pedestriancount = 0 THEN 1 ELSE 0 END) <= 0.01 AS passed, avg(CASE WHEN pedestriancount = 0 THEN 1 ELSE 0 END) AS observed FROM v_hourly")
def outage_share(spark, sf):
    return checks.outage_share(v_hourly(spark, sf).withColumn("zero", F.col("pedestriancount") == 0), "zero")


@query("SELECT 'seen' AS column_name, round(avg(CASE WHEN seen IS NULL THEN 1 ELSE 0 END), 4) AS \"current\", CAST(0 AS DOUBLE) AS previous FROM held", **_HELD)
def null_drift(spark, sf):
    now = drift.profile(_held(spark, sf), ["location_id", "seen"])
    return checks.null_drift(now, now.withColumn("null_share", F.lit(0.0)))


