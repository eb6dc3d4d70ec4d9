"""Queries of the training frame, surroundings, connections and routes."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema
from ..functions import opening_hours
from ..operators import connections, frame, graph, holdout, metrics, places, routes, surroundings
from .network_queries import _HOURS, _RASTER, _r6, _raster
from .views import sql, table, v_hourly, v_lattice, v_places, v_scored, v_sites

QUERIES, ORACLES = {}, {}


def query(oracle: str | None, **ctes: str):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = sql(oracle, **ctes)
        return f

    return add


_SHADE = {
    "rows_": "SELECT location_id, ts_utc, location_id % 5 AS segment_id, CASE WHEN hour(ts_utc) < 6 THEN -1 ELSE hour(ts_utc) % 4 END AS sun_bin FROM v_hourly",
    "shade": "SELECT s AS segment_id, b AS sun_bin, (s + b) / 10 AS shade_portable FROM range(7) AS a(s), range(4) AS c(b) WHERE (s + b) % 3 <> 0",
}


@query(
    """SELECT r.location_id, r.ts_utc, CAST(CASE WHEN r.sun_bin < 0 THEN 1.0 ELSE coalesce(s.shade_portable, 0.0) END AS DOUBLE) AS shade_portable, CAST(CASE WHEN r.sun_bin < 0 THEN 1.0 END AS DOUBLE) AS shade_rich
FROM rows_ r LEFT JOIN shade s ON s.segment_id = r.segment_id AND s.sun_bin = r.sun_bin""",
    **_SHADE,
)
def shade_lookup(spark, sf):
    rows = v_hourly(spark, sf).select("location_id", "ts_utc", (F.col("location_id") % 5).cast("bigint").alias("segment_id"), F.when(F.hour("ts_utc") < 6, -1).otherwise(F.hour("ts_utc") % 4).cast("bigint").alias("sun_bin"))
    table = spark.range(7).withColumnRenamed("id", "segment_id").crossJoin(spark.range(4).withColumnRenamed("id", "sun_bin")).where("(segment_id + sun_bin) % 3 <> 0")
    table = table.withColumns({"shade_portable": (F.col("segment_id") + F.col("sun_bin")) / 10, "shade_rich": F.lit(None).cast("double")})
    return frame.with_shade(rows, table, ["shade_portable", "shade_rich"]).select("location_id", "ts_utc", "shade_portable", "shade_rich")


@query(
    """SELECT v.location_id, CAST(hour(ts_utc) AS FLOAT) AS hour_local, CAST(pedestriancount AS FLOAT) AS size, CAST(p.x AS FLOAT) AS x, CAST(CASE WHEN ts_utc >= TIMESTAMP '2024-01-10' THEN p.y ELSE 2000 END AS FLOAT) AS y FROM v_hourly v LEFT JOIN v_sites p ON p.id = v.location_id"""
)
def design_matrix(spark, sf):
    rows = v_hourly(spark, sf).withColumns({"hour_local": F.hour("ts_utc"), "size": F.col("pedestriancount"), "opened": F.col("ts_utc") >= F.lit("2024-01-10").cast("timestamp_ntz")})
    return frame.design_matrix(rows, v_sites(spark, sf).select(F.col("id").cast("int").alias("location_id"), "x", "y"), "location_id", ["hour_local", "size"], ["x", "y"], "y", "opened")


@query("SELECT location_id, ts_utc, pedestriancount, CAST(source AS VARCHAR) AS source, CAST(NULL AS BOOLEAN) AS school_term, CAST(NULL AS FLOAT) AS wx_rain FROM v_hourly")
def conformed_schema(spark, sf):
    out = schema.conform(v_hourly(spark, sf), schema.COUNTS_HOURLY)
    return out.select("location_id", "ts_utc", "pedestriancount", "source", "school_term", "wx_rain")


@query(
    """SELECT kind, hour_of_week, CAST(sum(o) AS BIGINT) AS n_open, CAST(sum(u) AS BIGINT) AS n_unknown FROM (SELECT 'cafe' AS kind, h AS hour_of_week, 1 AS o, 0 AS u FROM range(168) AS t(h) UNION ALL
  SELECT 'cafe', h, 1, 0 FROM range(168) AS t(h) WHERE (h < 120 AND h % 24 BETWEEN 8 AND 17) OR h BETWEEN 129 AND 131 UNION ALL SELECT 'bar', h, 0, 1 FROM range(168) AS t(h)) GROUP BY 1, 2"""
)
def open_hours_by_week(spark, sf):
    rows = spark.createDataFrame([("cafe", _HOURS[0]), ("cafe", _HOURS[1]), ("bar", _HOURS[6])], "kind string, hours string")
    out = frame.weekly_open(rows.withColumn("mask", opening_hours.open_hours("hours")), "mask", ["kind"])
    return out.select("kind", F.col("hour_of_week").cast("bigint").alias("hour_of_week"), "n_open", "n_unknown")


def _streets(spark, sf):
    """Sites joined to the next place as straight segments."""
    s = v_sites(spark, sf)
    return s.select(F.col("id").alias("segment_id"), F.col("x").alias("x1"), F.col("y").alias("y1"), (F.col("x") + F.col("id") % 7 * 10 + 5).alias("x2"), (F.col("y") + F.col("id") % 3 * 15).alias("y2"), (F.col("id") % 10 == 0).alias("bridge"))


_STREETS = {
    "streets": "SELECT id AS segment_id, x AS x1, y AS y1, x + id % 7 * 10 + 5 AS x2, y + id % 3 * 15 AS y2, id % 10 = 0 AS bridge FROM v_sites",
    "steps": "SELECT *, greatest(CAST(ceil(sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2) / 10) AS INTEGER), 1) AS m FROM streets",
    "pts": "SELECT segment_id, bridge, n, x1 + (x2 - x1) * n / m AS x, y1 + (y2 - y1) * n / m AS y, sqrt(((x2 - x1) * n / m) ** 2 + ((y2 - y1) * n / m) ** 2) AS along FROM (SELECT *, unnest(range(m + 1)) AS n FROM steps)",
}


@query(
    """SELECT s.segment_id, round(low, 6) AS low_share, round(high, 6) AS high_share FROM streets s LEFT JOIN (SELECT segment_id, avg(l) AS low, avg(h) AS high FROM (
  SELECT p.segment_id, p.n, avg(CASE WHEN value = 3 THEN 1 ELSE 0 END) AS l, avg(CASE WHEN value = 7 THEN 1 ELSE 0 END) AS h FROM pts p JOIN raster r ON abs(r.row - floor(y / 40)) <= 1 AND abs(r.col - floor(x / 40)) <= 1 GROUP BY 1, 2) GROUP BY 1) c ON c.segment_id = s.segment_id""",
    **_STREETS, **_RASTER,
)
def landcover_shares(spark, sf):
    return _r6(surroundings.cover_shares(_streets(spark, sf), _raster(spark), 40.0, {"low": 3, "high": 7}))


@query(
    """SELECT s.segment_id, CASE WHEN NOT bridge THEN round(a, 6) END AS slope_mean_pct, CASE WHEN NOT bridge THEN round(b, 6) END AS slope_max_pct FROM streets s LEFT JOIN (SELECT segment_id, avg(g) AS a, max(g) AS b FROM (
  SELECT segment_id, abs(value - lag(value) OVER w) / greatest(along - lag(along) OVER w, 10) * 100 AS g FROM pts LEFT JOIN raster ON row = floor(y / 40) AND col = floor(x / 40) WINDOW w AS (PARTITION BY segment_id ORDER BY n)) GROUP BY 1) c ON c.segment_id = s.segment_id""",
    **_STREETS, **_RASTER,
)
def segment_slope(spark, sf):
    return _r6(surroundings.slope(_streets(spark, sf), _raster(spark), 40.0, 10.0, "bridge"))


def _buildings(spark, sf):
    p = v_places(spark, sf)

    def corner(dx, dy):
        return F.struct((F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y"))

    return p.select("id", F.array(corner(0, 0), corner(12, 0), corner(12, 9), corner(0, 9)).alias("ring"), (F.col("id") % 20 + 3).cast("double").alias("height"))


@query(None)
def built_form(spark, sf):
    streets, b = _streets(spark, sf), _buildings(spark, sf)
    layers = {"green": b.where("id % 10 = 3"), "ped_area": b.where("id % 10 = 7")}
    out = surroundings.built_form(streets, b, 20.0).join(surroundings.area_distances(streets, layers, 100.0), "segment_id")
    return _r6(out.drop("ped_area_adjacent"))


@query(None)
def shade_table(spark, sf):
    suns = spark.createDataFrame([(11, 22.5, 75.0), (17, 37.5, 105.0), (32, 22.5, 195.0)], "sun_bin int, elevation double, azimuth double")
    return _r6(surroundings.shade_table(_streets(spark, sf), _buildings(spark, sf), suns))


_STEEP = {
    "sections": "SELECT id, x, y, CASE WHEN id % 4 <> 0 THEN CAST(id % 9 AS DOUBLE) END AS slope_pct, CAST(id % 17 AS DOUBLE) AS length_m FROM v_places",
    "near": "SELECT s.id AS sensor, p.id AS section, slope_pct, length_m, sqrt((s.x - p.x) ** 2 + (s.y - p.y) ** 2) AS dist FROM v_sites s JOIN sections p ON slope_pct IS NOT NULL AND length_m >= 5",
    "steep": """SELECT s.id AS sensor, n.section, CASE WHEN n.section IS NOT NULL THEN n.slope_pct END AS slope_pct, round(m.v, 6) AS slope_pct_local_mean, coalesce(m.n, 0) AS n_local_sections, CASE WHEN n.section IS NOT NULL THEN 'section' ELSE 'none' END AS place_source
FROM v_sites s LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY sensor ORDER BY dist, section) AS r FROM near WHERE dist <= 25) n ON n.sensor = s.id AND n.r = 1
LEFT JOIN (SELECT sensor, sum(slope_pct * length_m) / sum(length_m) AS v, count(*) AS n FROM near WHERE dist <= 60 GROUP BY 1) m ON m.sensor = s.id""",
}


@query("SELECT * FROM steep", **_STEEP)
def sensor_steepness(spark, sf):
    sections = v_places(spark, sf).withColumns({"slope_pct": F.when(F.col("id") % 4 != 0, (F.col("id") % 9).cast("double")), "length_m": (F.col("id") % 17).cast("double")})
    return _r6(surroundings.local_steepness(v_sites(spark, sf), sections, 25.0, 60.0))


def _height(name: str, dx: int, dy: int) -> str:
    return f"LEFT JOIN raster {name} ON {name}.row = floor((y + {dy}) / 40) AND {name}.col = floor((x + {dx}) / 40)"


@query(
    f"""SELECT sensor, section, round(coalesce(slope_pct, dem), 6) AS slope_pct, slope_pct_local_mean, n_local_sections, CASE WHEN slope_pct IS NULL AND dem IS NOT NULL THEN 'dem' ELSE place_source END AS place_source, elevation_m FROM steep LEFT JOIN (
  SELECT id, c.value AS elevation_m, 100 * sqrt(((e.value - w.value) / 80) ** 2 + ((n.value - s.value) / 80) ** 2) AS dem FROM v_sites {_height("c", 0, 0)} {_height("e", 40, 0)} {_height("w", -40, 0)} {_height("n", 0, 40)} {_height("s", 0, -40)}
  WHERE id IN (SELECT sensor FROM steep WHERE slope_pct IS NULL)) t ON t.id = sensor""",
    **_STEEP, **_RASTER,
)
def sensor_terrain(spark, sf):
    """sensor_steepness with the terrain where no section is near; the raster of heights has gaps."""
    return _r6(surroundings.fill_from_dem(sensor_steepness(spark, sf), v_sites(spark, sf), _raster(spark), 40.0, 40.0))


@query(
    """SELECT 'det-' || CAST(segment_id AS VARCHAR) AS segment_id, coalesce(a.node, -segment_id * 2 - 1) AS u, coalesce(b.node, -segment_id * 2 - 2) AS v, round(sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2), 6) AS length_m, true AS is_detected FROM streets
LEFT JOIN (SELECT segment_id AS s, p.id AS node, row_number() OVER (PARTITION BY segment_id ORDER BY sqrt((p.x - x1) ** 2 + (p.y - y1) ** 2), p.id) AS r FROM streets JOIN v_places p ON sqrt((p.x - x1) ** 2 + (p.y - y1) ** 2) <= 15) a ON a.s = segment_id AND a.r = 1
LEFT JOIN (SELECT segment_id AS s, p.id AS node, row_number() OVER (PARTITION BY segment_id ORDER BY sqrt((p.x - x2) ** 2 + (p.y - y2) ** 2), p.id) AS r FROM streets JOIN v_places p ON sqrt((p.x - x2) ** 2 + (p.y - y2) ** 2) <= 15) b ON b.s = segment_id AND b.r = 1""",
    **_STREETS,
)
def detected_edges(spark, sf):
    return _r6(connections.detected_edges(_streets(spark, sf).withColumnRenamed("segment_id", "id"), v_places(spark, sf), 15.0))


def _grid(spark, sf):
    def at(n, k):
        return ((n % 5 if k == "x" else F.floor(n / 5)) * 100).cast("double")

    e = v_lattice(spark, sf)
    edges = e.select("segment_id", "u", "v", at(F.col("u"), "x").alias("x1"), at(F.col("u"), "y").alias("y1"), at(F.col("v"), "x").alias("x2"), at(F.col("v"), "y").alias("y2"))
    nodes = spark.range(25).select("id", at(F.col("id"), "x").alias("x"), at(F.col("id"), "y").alias("y"))
    doors = spark.range(1000, 1060).select("id", (F.col("id") * 37 % 450).cast("double").alias("x"), (F.col("id") * 53 % 450).cast("double").alias("y"))
    return doors, nodes, edges


_DOORS = {
    "doors": "SELECT i AS id, CAST(i * 37 % 450 AS DOUBLE) AS x, CAST(i * 53 % 450 AS DOUBLE) AS y FROM range(1000, 1060) AS t(i)",
    "nodes": "SELECT i AS id, CAST(i % 5 * 100 AS DOUBLE) AS x, CAST(i // 5 * 100 AS DOUBLE) AS y FROM range(25) AS t(i)",
    "byn": "SELECT d.id, n.id AS node, sqrt((d.x - n.x) ** 2 + (d.y - n.y) ** 2) AS dist, row_number() OVER (PARTITION BY d.id ORDER BY sqrt((d.x - n.x) ** 2 + (d.y - n.y) ** 2), n.id) AS r FROM doors d JOIN nodes n ON sqrt((d.x - n.x) ** 2 + (d.y - n.y) ** 2) <= 10",
    "far": "SELECT d.id, d.x, d.y, e.*, greatest(least(((d.x - a.x) * (b.x - a.x) + (d.y - a.y) * (b.y - a.y)) / 10000, 1), 0) AS f, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS bby FROM doors d, v_lattice e JOIN nodes a ON a.id = e.u JOIN nodes b ON b.id = e.v WHERE d.id NOT IN (SELECT id FROM byn)",
    "bye": "SELECT *, row_number() OVER (PARTITION BY id ORDER BY dist, segment_id) AS r FROM (SELECT *, sqrt((x - ax - f * (bx - ax)) ** 2 + (y - ay - f * (bby - ay)) ** 2) AS dist FROM far) WHERE dist <= 30",
    "links": """SELECT id AS entrance, 'node' AS how, node, CAST(NULL AS BIGINT) AS segment_id, CAST(NULL AS DOUBLE) AS fraction, dist AS length_m FROM byn WHERE r = 1 UNION ALL
  SELECT id, CASE WHEN f <= 0 OR f >= 1 THEN 'end' ELSE 'cut' END, CASE WHEN f <= 0 THEN u WHEN f >= 1 THEN v ELSE -id END, CASE WHEN f > 0 AND f < 1 THEN segment_id END, CASE WHEN f > 0 AND f < 1 THEN f END, dist FROM bye WHERE r = 1""",
}


@query("SELECT entrance, how, node, segment_id, round(fraction, 6) AS fraction, round(length_m, 6) AS length_m FROM links", **_DOORS)
def entrance_links(spark, sf):
    return _r6(connections.entrance_links(*_grid(spark, sf)))


@query(
    """SELECT CAST(segment_id AS VARCHAR) || '.' || CAST(row_number() OVER w - 2 AS VARCHAR) AS segment_id, segment_id AS parent, lag(node) OVER w AS u, node AS v, round(lag(f) OVER w, 6) AS from_frac, round(f, 6) AS to_frac FROM (
  SELECT segment_id, 0.0::DOUBLE AS f, u AS node FROM v_lattice WHERE segment_id IN (SELECT segment_id FROM links WHERE how = 'cut') UNION ALL SELECT segment_id, 1.0::DOUBLE, v FROM v_lattice WHERE segment_id IN (SELECT segment_id FROM links WHERE how = 'cut')
  UNION ALL SELECT segment_id, fraction, node FROM links WHERE how = 'cut') WINDOW w AS (PARTITION BY segment_id ORDER BY f, node) QUALIFY lag(f) OVER w IS NOT NULL""",
    **_DOORS,
)
def cut_edges(spark, sf):
    doors, nodes, edges = _grid(spark, sf)
    return _r6(connections.cut_edges(edges, connections.entrance_links(doors, nodes, edges)))


@query("SELECT * FROM (VALUES ('xing-110-111', 110::BIGINT, 111::BIGINT, 12.0::DOUBLE, true), ('xing-150-151', 150, 151, 12.0, true)) AS t(segment_id, u, v, length_m, is_inferred)")
def inferred_crossings(spark, sf):
    """Five roads alike; at 11 a crossing is mapped, at 12 only two edges meet, at 13 a short walk joins the sidewalks, at 14 a long one."""
    road = spark.createDataFrame([(k + 1, 10 + k, 300.0 * k, 0.0, 300.0 * k + 100, 0.0) for k in range(5)], "road long, junction long, jx double, jy double, nx double, ny double")
    ends = spark.createDataFrame([(102, 3.0, 15.0)] + [(110 + 10 * k + i, 300.0 * k + 8, y) for k in range(5) for i, y in ((0, 6.0), (1, -6.0))], "id long, x double, y double")
    mapped = spark.createDataFrame([(1, 310.0, 0.0)], "id long, x double, y double")
    roads = [(10 * k + i, 10 + k, 20 + 10 * k + i, 100.0, False) for k in range(5) for i in range(2 if k == 2 else 3)]
    walks = [(101, 140, 200, 10.0, True), (102, 200, 141, 20.0, True), (103, 150, 201, 20.0, True), (104, 201, 151, 20.0, True)]
    edges = spark.createDataFrame(roads + walks, "segment_id long, u long, v long, length_m double, in_metric_graph boolean")
    return connections.infer_crossings(road, ends, mapped, edges)


@query("SELECT 1 AS plaza, least(a, b) AS u, greatest(a, b) AS v, d AS length_m FROM (VALUES (0, 1, 100.0::DOUBLE), (0, 5, 100.0), (1, 6, 100.0), (5, 6, 100.0), (0, 6, sqrt(20000)), (1, 5, sqrt(20000))) AS t(a, b, d)")
def plaza_edges(spark, sf):
    _, nodes, _ = _grid(spark, sf)
    ring = [(0.0, 0.0), (100.0, 0.0), (100.0, 100.0), (0.0, 100.0)]
    out = connections.plaza_edges(spark.createDataFrame([(1, ring)], "id int, ring array<struct<x: double, y: double>>"), nodes)
    return out.select("plaza", F.col("u").cast("int").alias("u"), F.col("v").cast("int").alias("v"), "length_m")


@query(
    "SELECT p.id AS entrance, n.id AS station, CASE WHEN n.id % 2 = 0 THEN DATE '2025-11-30' END AS opened FROM v_places p LEFT JOIN (SELECT p.id AS e, s.id, row_number() OVER (PARTITION BY p.id ORDER BY sqrt((p.x - s.x) ** 2 + (p.y - s.y) ** 2), s.id) AS r FROM v_places p JOIN v_sites s ON sqrt((p.x - s.x) ** 2 + (p.y - s.y) ** 2) <= 40) n ON e = p.id AND r = 1"
)
def station_entrances(spark, sf):
    stations = v_sites(spark, sf).withColumn("opened", F.when(F.col("id") % 2 == 0, F.to_date(F.lit("2025-11-30"))))
    return connections.stop_stations(v_places(spark, sf), stations, 40.0)


@query(None)
def egress_routes(spark, sf):
    net = graph.load(v_lattice(spark, sf))
    found = routes.sample_routes(net, [0, 1], {"station": 24, "tram": 20}, 12, 0.5, 7)
    rows = [(i, r.destination, len(r.segments), r.length) for i, r in enumerate(found)]
    return spark.createDataFrame(rows, "route int, destination string, n_segments int, length_m double")


@query(None)
def fitted_trips(spark, sf):
    net = graph.load(v_lattice(spark, sf))
    found = routes.route_table(spark, routes.sample_routes(net, [0, 1], {"station": 24, "tram": 20}, 12, 0.5, 7))
    passed = routes.passages(found, spark.createDataFrame([(1, 506), (2, 2021), (3, 1924)], "sensor int, segment long"))
    prior = routes.prior_trips(found, spark.createDataFrame([("station", 3.0), ("tram", 1.0)], "destination string, weight double"), 1000.0, 1.0)
    targets = passed.join(prior, "route").groupBy("sensor").agg((F.sum("trips") * 1.2).alias("total"))
    times = routes.crossing_times(routes.fitted(passed, targets, prior, 0.1), passed, [0.5, 0.3, 0.2], 20, 1.3, 5)
    return times.groupBy("sensor", F.floor(F.col("minute") / 5).alias("block")).agg(F.count("*").alias("n_walkers"))


_WEIGHTS = "(VALUES ('1-URGENT', 3.0), ('2-HIGH', 1.5), ('3-MEDIUM', 1.0), ('9-NONE', 7.0)) AS w(destination, weight)"


@query(
    """SELECT route, round(9000.0 * weight / sum_weight * pull / sum(pull) OVER (PARTITION BY destination), 7) AS trips FROM (
  SELECT o_orderkey AS route, o_orderpriority AS destination, coalesce(weight, 0.0) AS weight, 5.5 AS sum_weight,
    exp(-2.0 * (CAST(o_totalprice AS DOUBLE) - min(CAST(o_totalprice AS DOUBLE)) OVER g) / greatest(min(CAST(o_totalprice AS DOUBLE)) OVER g, 1.0)) AS pull
  FROM orders LEFT JOIN """ + _WEIGHTS + """ ON destination = o_orderpriority WINDOW g AS (PARTITION BY o_orderpriority))"""
)
def prior_of_routes(spark, sf):
    """Orders as routes, to their priorities."""
    own = table(spark, sf, "orders").select(F.col("o_orderkey").alias("route"), F.col("o_orderpriority").alias("destination"), F.col("o_totalprice").cast("double").alias("length_m"))
    weights = spark.createDataFrame([("1-URGENT", 3.0), ("2-HIGH", 1.5), ("3-MEDIUM", 1.0), ("9-NONE", 7.0)], "destination string, weight double")
    return routes.prior_trips(own, weights, 9000.0, 2.0).select("route", F.round("trips", 7).alias("trips"))


@query(
    """SELECT l_orderkey AS route, s_suppkey AS sensor, offset_m AS "offset", offset_m - min(offset_m) OVER (PARTITION BY l_orderkey) AS lag_m FROM (
  SELECT l_orderkey, l_partkey, max(CAST(10 * l_linenumber AS DOUBLE)) AS offset_m FROM lineitem GROUP BY 1, 2) JOIN (SELECT s_suppkey, s_suppkey * 2 AS seg FROM supplier) ON seg = l_partkey"""
)
def route_passages(spark, sf):
    """Orders as routes along their parts, every second of which has a supplier as sensor."""
    legs = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("route")).agg(F.collect_list(F.struct(F.col("l_partkey").cast("bigint").alias("segment"), (F.col("l_linenumber") * 10).cast("double").alias("offset"))).alias("legs"))
    sensors = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("sensor"), (F.col("s_suppkey") * 2).cast("bigint").alias("segment"))
    return routes.passages(legs, sensors)


@query("SELECT CAST(b AS INTEGER) AS block, CASE b WHEN 0 THEN 0.6 WHEN 1 THEN 0.4 ELSE 0.0 END::DOUBLE AS share FROM range(4) AS t(b)")
def profile_block_shares(spark, sf):
    return routes.block_shares(spark.createDataFrame([(0, 0.2), (5, 0.1), (15, 0.2)], "block_start int, share double"), 15)


@query("SELECT segment_id, u, v, u % 3 <> 0 AS in_metric_graph FROM v_lattice")
def separate_roads(spark, sf):
    e = v_lattice(spark, sf).withColumn("sidewalk_state", F.when(F.col("u") % 3 == 0, "separate").when(F.col("u") % 3 == 1, "both"))
    return connections.separate_roads(e).select("segment_id", "u", "v", "in_metric_graph")


_HELD = {"north": [1, 2, 3], "south": [4, 5]}


@query(
    """SELECT holdout, period, k, round(avg(l), 7) AS log_mae, round(avg(w), 7) AS wape, count(*) AS n_draws FROM (SELECT s.holdout, s.k, s.d, period, avg(abs(ln(1 + pred * scale) - ln(1 + y))) AS l, sum(abs(pred * scale - y)) / sum(y) AS w
  FROM scales s JOIN r ON r.holdout = s.holdout AND (s.known IS NULL OR s.known <> r.location_id) GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3""",
    ids="SELECT * FROM (VALUES ('north', 1), ('north', 2), ('north', 3), ('south', 4), ('south', 5)) AS t(holdout, sensor)",
    r="SELECT holdout, location_id, y, pred, 'all' AS period FROM v_scored JOIN ids ON sensor = location_id UNION ALL SELECT holdout, location_id, y, pred, 'late' FROM v_scored JOIN ids ON sensor = location_id WHERE ts_utc >= TIMESTAMP '1998-01-01'",
    scales="""SELECT DISTINCT holdout, 0 AS k, 0 AS d, CAST(NULL AS INTEGER) AS known, 1.0::DOUBLE AS scale FROM ids UNION ALL SELECT holdout, 1, sensor, sensor, (SELECT sum(y) / sum(pred) FROM v_scored WHERE location_id = sensor) FROM ids""",
)
def holdout_scores(spark, sf):
    periods = {"all": F.lit(True), "late": F.col("ts_utc") >= F.lit("1998-01-01").cast("timestamp_ntz")}
    out = holdout.holdout_scores(v_scored(spark, sf), _HELD, "location_id", "y", "pred", periods, (0, 1))
    return out.withColumns({c: F.round(c, 7) for c in ("log_mae", "wape")})


_TWO = "SELECT y, pred, y * 0.7 AS base, ts_utc FROM v_scored"


@query(
    """SELECT period, round(l, 7) AS log_mae, round(b, 7) AS baseline_log_mae, n AS n_rows, round(1 - l / b, 7) AS gain FROM (SELECT period, avg(abs(ln(1 + pred) - ln(1 + y))) AS l, avg(abs(ln(1 + base) - ln(1 + y))) AS b, count(*) AS n
  FROM (SELECT *, 'all' AS period FROM two UNION ALL SELECT *, 'recent' FROM two WHERE ts_utc >= TIMESTAMP '1999-06-01') GROUP BY 1)""",
    two=_TWO,
)
def compare_periods(spark, sf):
    rows = v_scored(spark, sf).withColumn("base", F.col("y") * 0.7)
    out = holdout.compare_periods(rows, "ts_utc", "y", "pred", "base", {"all": None, "recent": "1999-06-01"})
    return out.withColumns({c: F.round(c, 7) for c in ("log_mae", "baseline_log_mae", "gain")})


@query("SELECT CAST(min(ts_utc) AS DATE) AS first_day, CAST(max(ts_utc) AS DATE) AS last_day, count(DISTINCT location_id) FILTER (WHERE fold > 0) AS n_trained, count(DISTINCT location_id) FILTER (WHERE fold = 0) AS n_hidden FROM v_scored")
def data_facts(spark, sf):
    return holdout.data_facts(v_scored(spark, sf), "location_id", "ts_utc", F.col("fold") == 0)


@query("SELECT l_returnflag, trees, round(cost, 6) AS cost FROM (SELECT l_returnflag, 0 AS trees, avg(greatest(0.5 * (y - 20), -0.5 * (y - 20))) AS cost FROM v_scored GROUP BY 1 UNION ALL SELECT l_returnflag, 10, avg(greatest(0.5 * (y - pred), -0.5 * (y - pred))) FROM v_scored GROUP BY 1)")
def cost_curve(spark, sf):
    rows = v_scored(spark, sf).withColumn("start", F.lit(20.0))
    return _r6(holdout.cost_curve(rows, "l_returnflag", "y", {0: "start", 10: "pred"}, lambda y, p: metrics.pinball(y, p, 0.5)))


@query("SELECT l_linestatus AS setting, round(avg(m), 7) AS log_mae FROM (SELECT l_linestatus, fold, avg(abs(ln(1 + pred) - ln(1 + y))) AS m FROM v_scored GROUP BY 1, 2) GROUP BY 1 ORDER BY avg(m), 1 LIMIT 1")
def best_setting(spark, sf):
    scores = v_scored(spark, sf).groupBy(F.col("l_linestatus").alias("setting"), "fold").agg(metrics.log_mae("y", "pred").alias("log_mae"))
    return holdout.best_setting(scores, "setting", "log_mae").withColumn("log_mae", F.round("log_mae", 7))


_POINTS = [
    (1, {"entrance": "main"}), (2, {"entrance": "emergency"}), (3, {"railway": "subway_entrance", "entrance": "exit"}), (4, {"amenity": "cafe", "shop": "books"}), (5, {"shop": "books"}), (6, {"highway": "bus_stop", "name": "New Town Hall"}),
    (7, {"railway": "tram_stop", "highway": "bus_stop"}), (8, {"name": "nothing"}),
]


def _tagged(spark):
    return spark.createDataFrame(_POINTS, "id int, tags map<string, string>")


@query("SELECT * FROM (VALUES (1, 'building'), (3, 'station')) AS t(id, kind)")
def building_entrances(spark, sf):
    return places.entrances(_tagged(spark)).select("id", "kind")


@query("SELECT * FROM (VALUES (4, true, true), (5, false, true)) AS t(id, is_food, is_shop)")
def poi_categories(spark, sf):
    return places.categories(_tagged(spark), {"food": ["amenity=cafe", "amenity=restaurant"], "shop": ["shop=*"]}).drop("tags")


@query("SELECT * FROM (VALUES (6, 'bus', true), (7, 'tram', false)) AS t(id, mode, is_recent)")
def transit_modes(spark, sf):
    return places.modes(_tagged(spark), {"tram": ["railway=tram_stop"], "bus": ["highway=bus_stop"]}, ["Town Hall"]).drop("tags")


@query("SELECT p.id, coalesce(n.id, -1) AS node FROM v_places p LEFT JOIN (SELECT p.id AS e, s.id, row_number() OVER (PARTITION BY p.id ORDER BY sqrt((p.x - s.x) ** 2 + (p.y - s.y) ** 2), s.id) AS r FROM v_places p JOIN v_sites s ON sqrt((p.x - s.x) ** 2 + (p.y - s.y) ** 2) <= 40) n ON e = p.id AND r = 1")
def snap_to_nodes(spark, sf):
    return places.snapped(v_places(spark, sf), v_sites(spark, sf), 40.0).select("id", "node")


@query("SELECT id FROM v_places p WHERE EXISTS (SELECT 1 FROM v_sites s WHERE sqrt((p.x - s.x) ** 2 + (p.y - s.y) ** 2) <= 35)")
def feature_mask(spark, sf):
    return places.in_mask(v_places(spark, sf), v_sites(spark, sf), 35.0).select("id")
