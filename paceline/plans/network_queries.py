"""Queries of places, networks, tags, openings, splits, models, sources and sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry, opening_hours
from ..operators import boosting, connections, graph, metrics, models, openings, segments, spatial, splits
from ..sources import files
from .views import sql, table, v_hourly, v_lattice, v_places, v_scored, v_sites, v_streets, v_years

QUERIES, ORACLES = {}, {}


def query(oracle: str | None, **ctes: str):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = sql(oracle, **ctes)
        return f

    return add


def _r6(df):
    return df.withColumns({c: F.round(c, 6) for c, t in df.dtypes if t == "double"})


_PAIRS = {"d": "SELECT a.id AS a_id, b.id AS b_id, sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) AS dist FROM v_sites a, v_places b"}


@query("SELECT a_id, b_id, round(dist, 6) AS dist FROM d WHERE dist <= 30", **_PAIRS)
def within_radius(spark, sf):
    return _r6(spatial.within(v_sites(spark, sf), v_places(spark, sf), 30.0))


@query("SELECT s.id AS a_id, b_id, round(dist, 6) AS dist FROM v_sites s LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY a_id ORDER BY dist, b_id) AS r FROM d WHERE dist <= 12) n ON a_id = s.id AND r = 1", **_PAIRS)
def nearest_point(spark, sf):
    return _r6(spatial.nearest(v_sites(spark, sf), v_places(spark, sf), 12.0))


@query(
    """SELECT * FROM (SELECT a_id, b_id, round(dist, 6) AS dist, round(dist + CASE WHEN b_id % 4 = 0 THEN 5 ELSE 0 END, 6) AS score, CAST(row_number() OVER (PARTITION BY a_id ORDER BY dist + CASE WHEN b_id % 4 = 0 THEN 5 ELSE 0 END, b_id) AS INTEGER) AS rank FROM d WHERE dist <= 40) WHERE rank <= 3""",
    **_PAIRS,
)
def top3_candidates(spark, sf):
    return _r6(spatial.candidates(v_sites(spark, sf), v_places(spark, sf), 40.0, F.when(F.col("b_id") % 4 == 0, 5.0).otherwise(0.0)))


_CAND = _PAIRS | {
    "k": "SELECT a_id AS sensor, b_id AS segment, dist, dist + CASE WHEN b_id % 4 = 0 THEN 5 ELSE 0 END AS score, row_number() OVER (PARTITION BY a_id ORDER BY dist + CASE WHEN b_id % 4 = 0 THEN 5 ELSE 0 END, b_id) AS r FROM d WHERE dist <= 20",
}


@query(
    """SELECT s.id AS sensor, coalesce(o.segment, a.segment) AS segment, round(a.dist, 6) AS dist, round(b.score - a.score, 6) AS runner_up_gap, CASE WHEN o.segment IS NOT NULL THEN 'override' WHEN a.segment IS NOT NULL THEN 'nearest' ELSE 'none' END AS method,
  concat_ws('; ', CASE WHEN a.segment IS NULL AND o.segment IS NULL THEN 'no segment' END, CASE WHEN a.dist > 15 THEN 'far' END, CASE WHEN b.score - a.score <= 3 THEN 'close runner-up' END) AS review_reasons
FROM v_sites s LEFT JOIN (SELECT * FROM k WHERE r = 1) a ON a.sensor = s.id LEFT JOIN (SELECT * FROM k WHERE r = 2) b ON b.sensor = s.id LEFT JOIN (VALUES (7, 1), (9, 2)) AS o(sensor, segment) ON o.sensor = s.id""",
    **_CAND,
)
def match_sensors(spark, sf):
    overrides = spark.createDataFrame([(7, 1), (9, 2)], "sensor long, segment long")
    return _r6(segments.match_sensors(_cands(spark, sf), v_sites(spark, sf).select(F.col("id").alias("sensor")), overrides))


@query(
    """SELECT sensor, segment, round(dist, 6) AS dist, round(gap, 6) AS runner_up_gap, method, agrees AS bearing_agrees, reasons AS review_reasons, reasons <> '' AND method <> 'override' AS needs_review FROM (
  SELECT *, concat_ws('; ', CASE WHEN method = 'none' THEN 'no segment' END, CASE WHEN method = 'nearest' AND dist > 15 THEN 'far' END, CASE WHEN gap <= 3 THEN 'close runner-up' END,
    CASE WHEN method = 'nearest' AND segment % 3 = 0 THEN 'road centreline' END, CASE WHEN NOT agrees THEN 'bearing disagrees' END, CASE WHEN sensor % 11 = 0 THEN 'indoor sensor' END) AS reasons FROM (
    SELECT m.*, k.dist, CASE WHEN method = 'nearest' AND m.sensor % 5 <> 0 THEN least(abs(m.segment * 17 % 180 - m.sensor * 29 % 180), 180 - abs(m.segment * 17 % 180 - m.sensor * 29 % 180)) <= 30 END AS agrees FROM (
      SELECT s.id AS sensor, coalesce(o.segment, a.segment) AS segment, CASE WHEN o.segment IS NOT NULL THEN 'override' WHEN a.segment IS NOT NULL THEN 'nearest' ELSE 'none' END AS method, CASE WHEN o.segment IS NULL THEN b.score - a.score END AS gap
      FROM v_sites s LEFT JOIN (SELECT * FROM k WHERE r = 1) a ON a.sensor = s.id LEFT JOIN (SELECT * FROM k WHERE r = 2) b ON b.sensor = s.id LEFT JOIN (VALUES (7, 1), (9, 2)) AS o(sensor, segment) ON o.sensor = s.id
    ) m LEFT JOIN k ON k.sensor = m.sensor AND k.segment = m.segment))""",
    **_CAND,
)
def reviewed_matches(spark, sf):
    """match_sensors with made-up classes, axes and location types, and every reason for a review."""
    overrides = spark.createDataFrame([(7, 1), (9, 2)], "sensor long, segment long")
    n = F.col("segment")
    cands = _cands(spark, sf).withColumns({"highway": F.when(n % 3 == 0, "primary").otherwise("footway"), "bearing": (n * 17 % 180).cast("double")})
    k = F.col("id")
    sensors = v_sites(spark, sf).select(k.alias("sensor"), F.when(k % 5 != 0, (k * 29 % 180).cast("double")).alias("axis"), F.when(k % 11 == 0, "Indoor").otherwise("Outdoor").alias("location_type"))
    return _r6(segments.review_matches(cands, sensors, overrides, ["footway", "pedestrian", "path", "steps", "living_street", "corridor", "cycleway"]))


def _cands(spark, sf):
    got = spatial.candidates(v_sites(spark, sf), v_places(spark, sf), 20.0, F.when(F.col("b_id") % 4 == 0, 5.0).otherwise(0.0))
    return got.withColumnsRenamed({"a_id": "sensor", "b_id": "segment"})


@query(
    "SELECT * FROM (VALUES (9000, 1), (9, 99999999)) AS o(sensor, segment)"
)
def stale_overrides(spark, sf):
    overrides = spark.createDataFrame([(7, 1), (9000, 1), (9, 99999999)], "sensor int, segment int")
    return segments.check_overrides(overrides, v_sites(spark, sf).select(F.col("id").alias("sensor")), v_places(spark, sf).select(F.col("id").alias("segment")))


_AREAS = "(VALUES (1, 0, 0, 300, 400), (2, 300, 0, 700, 400), (3, 250, 350, 800, 900)) AS a(id, x1, y1, x2, y2)"


def _areas(spark):
    rows = [(1, 0, 0, 300, 400), (2, 300, 0, 700, 400), (3, 250, 350, 800, 900)]
    return spark.createDataFrame([(i, [(float(a), float(b)), (float(c), float(b)), (float(c), float(d)), (float(a), float(d))]) for i, a, b, c, d in rows], "id int, ring array<struct<x: double, y: double>>")


@query(f"SELECT p.id AS point_id, min(a.id) AS area_id FROM v_places p LEFT JOIN {_AREAS} ON p.x >= x1 AND p.x < x2 AND p.y >= y1 AND p.y < y2 GROUP BY 1")
def point_in_polygon(spark, sf):
    return spatial.containing(v_places(spark, sf), _areas(spark), 100.0)


@query("SELECT a.id AS a_id, b.id AS b_id, round(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2), 6) AS dist FROM v_places a JOIN v_places b ON a.id < b.id AND sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) < 15")
def close_pairs(spark, sf):
    return _r6(spatial.close_pairs(v_places(spark, sf), 15.0))


@query("SELECT DISTINCT CAST(a.id % 7 AS INTEGER) AS fold, b.id AS neighbour FROM v_places a JOIN v_places b ON a.id % 7 <> b.id % 7 AND sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) < 40")
def fold_neighbours(spark, sf):
    return spatial.fold_neighbours(v_places(spark, sf).withColumn("fold", (F.col("id") % 7).cast("int")), 40.0)


@query(
    "SELECT CAST(x AS INTEGER) AS x_off, CAST(y AS INTEGER) AS y_off, CAST(least(400, 1000 - x) AS INTEGER) AS width, CAST(least(400, 700 - y) AS INTEGER) AS height, CAST(50 + x * 0.5 AS DOUBLE) AS x, CAST(80 + y * 0.5 AS DOUBLE) AS y FROM range(0, 1000, 400) AS a(x), range(0, 700, 400) AS b(y)"
)
def raster_tiles(spark, sf):
    return spatial.tiles(spark, 50.0, 80.0, 1000, 700, 0.5, 400)


@query(
    """SELECT CAST(r + y AS BIGINT) AS row, CAST(c + x AS BIGINT) AS col, first(v ORDER BY tile) AS value FROM (SELECT l_linenumber AS tile, l_orderkey % 60 AS r, l_partkey % 60 AS c, min(l_quantity) AS v FROM lineitem GROUP BY 1, 2, 3)
  JOIN (SELECT t, (t - 1) % 3 * 40 AS x, (t - 1) // 3 * 40 AS y FROM range(1, 8) AS s(t)) ON t = tile GROUP BY 1, 2"""
)
def raster_mosaic(spark, sf):
    """Lines as overlapping tiles of 60 by 60, each 40 apart."""
    cells = table(spark, sf, "lineitem").groupBy(F.col("l_linenumber").alias("tile"), (F.col("l_orderkey") % 60).alias("row"), (F.col("l_partkey") % 60).alias("col")).agg(F.min("l_quantity").alias("value"))
    offsets = spark.createDataFrame([(t, (t - 1) % 3 * 40, (t - 1) // 3 * 40) for t in range(1, 8)], "tile int, x_off long, y_off long")
    return spatial.mosaic(cells, offsets)


_RASTER = {"raster": "SELECT r AS row, c AS col, CAST((r * 7 + c * 3) % 11 AS DOUBLE) AS value FROM range(25) AS a(r), range(25) AS b(c) WHERE (r + c) % 9 <> 0"}


def _raster(spark):
    cells = spark.range(25).withColumnRenamed("id", "row").crossJoin(spark.range(25).withColumnRenamed("id", "col"))
    return cells.where("(row + col) % 9 <> 0").withColumn("value", ((F.col("row") * 7 + F.col("col") * 3) % 11).cast("double"))


@query("SELECT p.id, value FROM v_sites p LEFT JOIN raster ON row = floor(y / 40) AND col = floor(x / 40)", **_RASTER)
def raster_values(spark, sf):
    return spatial.raster_values(v_sites(spark, sf), _raster(spark), 40.0).select("id", "value")


@query("SELECT a.row, a.col, round(avg(b.value), 6) AS mean_value FROM raster a JOIN raster b ON abs(a.row - b.row) <= 1 AND abs(a.col - b.col) <= 1 GROUP BY 1, 2", **_RASTER)
def focal_mean(spark, sf):
    return _r6(spatial.focal_mean(_raster(spark), 3))


@query(
    """SELECT id, round((degrees(atan2(500 - x, 500 - y)) + 360) % 180, 6) AS bearing, round(least(abs(((degrees(atan2(500 - x, 500 - y)) + 360) % 180) - 30) % 180, 180 - abs(((degrees(atan2(500 - x, 500 - y)) + 360) % 180) - 30) % 180), 6) AS off_axis,
  round(sqrt((x - 500) ** 2 + (y - 500) ** 2), 6) AS dist, CAST(sign(1000 * (y - 500) - 0 * (x - 0)) AS DOUBLE) AS side FROM v_sites"""
)
def bearings(spark, sf):
    x, y, c = F.col("x"), F.col("y"), F.lit(500.0)
    b = geometry.axial_bearing(x, y, c, c)
    return v_sites(spark, sf).select(
        "id", F.round(b, 6).alias("bearing"), F.round(geometry.axis_difference(b, F.lit(30.0)), 6).alias("off_axis"), F.round(geometry.distance(x, y, c, c), 6).alias("dist"),
        geometry.side(F.lit(0.0), c, F.lit(1000.0), c, x, y).alias("side"),
    )


@query("SELECT node_id, count(*) AS degree FROM (SELECT u AS node_id FROM v_streets UNION ALL SELECT v FROM v_streets) GROUP BY 1")
def node_degrees(spark, sf):
    return graph.node_table(v_streets(spark, sf))


def _broken(spark, sf):
    return v_streets(spark, sf).where("not (u % 5 = 2 and v = u + 1) and segment_id % 17 <> 0")


_BROKEN = {"e": "SELECT * FROM v_streets WHERE NOT (u % 5 = 2 AND v = u + 1) AND segment_id % 17 <> 0", "both_ways": "SELECT u AS a, v AS b FROM e UNION ALL SELECT v, u FROM e"}


@query("SELECT a AS node, min(b) AS component FROM walk GROUP BY 1", **_BROKEN, walk="/*RECURSIVE_STEP*/ SELECT DISTINCT a, a AS b FROM both_ways UNION SELECT w.a, l.b FROM walk w JOIN both_ways l ON w.b = l.a")
def components(spark, sf):
    return graph.components(_broken(spark, sf), "u", "v")


_COMP = _BROKEN | {"walk": "/*RECURSIVE_STEP*/ SELECT DISTINCT a, a AS b FROM both_ways UNION SELECT w.a, l.b FROM walk w JOIN both_ways l ON w.b = l.a", "c": "SELECT a AS node, min(b) AS component FROM walk GROUP BY 1", "z": "SELECT component, count(*) AS n FROM c GROUP BY 1"}


@query("SELECT segment_id, c.component, n AS component_size, c.component = (SELECT component FROM z ORDER BY n DESC, component LIMIT 1) AS in_main_component FROM e JOIN c ON c.node = e.u JOIN z ON z.component = c.component", **_COMP)
def segment_components(spark, sf):
    return graph.add_components(_broken(spark, sf)).select("segment_id", "component", "component_size", "in_main_component")


_WALK = {
    "links": "SELECT u AS a, v AS b, length_m AS w FROM v_streets UNION ALL SELECT v, u, length_m FROM v_streets",
    "walk": "/*RECURSIVE_STEP*/ SELECT DISTINCT a AS source, a AS node, CAST(0 AS DOUBLE) AS d FROM links UNION SELECT s.source, l.b, s.d + l.w FROM walk s JOIN links l ON s.node = l.a WHERE s.d + l.w <= 350",
    "near": "SELECT source, node, min(d) AS dist_m FROM walk GROUP BY 1, 2",
}


@query("SELECT source, node, round(dist_m, 6) AS dist_m FROM near", **_WALK)
def reach_within(spark, sf):
    return _r6(graph.reach(v_streets(spark, sf), 350.0))


@query("SELECT source, segment_id, round(min(dist_m), 6) AS dist_m FROM near JOIN v_streets ON node IN (u, v) GROUP BY 1, 2 HAVING min(dist_m) <= 250", **_WALK)
def segments_in_reach(spark, sf):
    return _r6(graph.reach_segments(v_streets(spark, sf), 250.0))


@query(
    "SELECT 'stop' || CAST(source % 3 AS VARCHAR) AS venue, segment_id, round(min(dist_m), 6) AS dist_m FROM near JOIN v_streets ON node IN (u, v) WHERE source IN (SELECT s_suppkey * 7 FROM supplier) GROUP BY 1, 2 HAVING min(dist_m) <= 300", **_WALK
)
def network_distance(spark, sf):
    stops = table(spark, sf, "supplier").select((F.col("s_suppkey") * 7).alias("node")).select(F.concat(F.lit("stop"), F.col("node") % 3).alias("venue"), "node")
    return _r6(graph.distance_to(v_streets(spark, sf), stops, 300.0))


@query(
    "SELECT source, " + ", ".join(f"coalesce(sum(s_acctbal) FILTER (WHERE dist_m <= {r}), 0) AS jobs_{r}" for r in (120, 250, 350)) + " FROM (SELECT source, dist_m, round(s_acctbal) AS s_acctbal FROM near LEFT JOIN supplier ON s_suppkey - 1 = node) GROUP BY 1", **_WALK
)
def weighted_reach(spark, sf):
    points = table(spark, sf, "supplier").select((F.col("s_suppkey") - 1).alias("node"), F.round("s_acctbal").alias("weight"))
    return _r6(graph.weighted_reach(graph.reach(v_streets(spark, sf), 350.0), points, (120, 250, 350)))


@query(
    "SELECT source, category, " + ", ".join(f"count(*) FILTER (WHERE dist_m <= {r}) AS n_{r}" for r in (110, 250)) + " FROM (SELECT source, segment_id, min(dist_m) AS dist_m FROM near JOIN v_streets ON node IN (u, v) GROUP BY 1, 2 HAVING min(dist_m) <= 250) r JOIN (SELECT (c_custkey - 1) * 2 AS s, c_mktsegment AS category FROM customer) p ON s = segment_id GROUP BY 1, 2",
    **_WALK,
)
def amenities_in_reach(spark, sf):
    places = table(spark, sf, "customer").select(((F.col("c_custkey") - 1) * 2).alias("segment_id"), F.col("c_mktsegment").alias("category"))
    return graph.amenities(graph.reach_segments(v_streets(spark, sf), 250.0), places, (110, 250))


@query(None)
def edge_betweenness(spark, sf):
    return _r6(graph.primal_metrics(v_streets(spark, sf), 350.0, 3))


def lattice_lines(spark, sf):
    def point(n):
        return F.struct((n % 5 * 100 + n * 3 % 7).cast("double").alias("x"), (F.floor(n / 5) * 100 + n * 5 % 11).cast("double").alias("y"))

    return v_lattice(spark, sf).withColumn("line", F.array(point(F.col("u")), point(F.col("v"))))


@query(None)
def angular_choice(spark, sf):
    return _r6(graph.angular_metrics(lattice_lines(spark, sf), 500.0, 3))


@query(
    "SELECT segment_id, u, v FROM k WHERE must OR NOT EXISTS (SELECT 1 FROM walk w WHERE w.e = k.segment_id AND w.node = k.v)",
    k="SELECT *, segment_id % 4 = 0 AS must FROM v_lattice",
    walk="/*RECURSIVE_STEP*/ SELECT segment_id AS e, u AS node FROM k WHERE NOT must UNION SELECT w.e, CASE WHEN f.u = w.node THEN f.v ELSE f.u END FROM walk w JOIN k f ON (f.u = w.node OR f.v = w.node) AND (f.must OR f.segment_id < w.e)",
)
def kept_bridges(spark, sf):
    return graph.keep_bridges(v_lattice(spark, sf).withColumn("must_keep", F.col("segment_id") % 4 == 0)).select("segment_id", "u", "v")


@query("SELECT segment_id, u, v, length_m FROM (SELECT *, row_number() OVER (PARTITION BY u, v ORDER BY length_m, segment_id) AS r FROM (SELECT l_orderkey * 8 + l_linenumber AS segment_id, least(l_suppkey, l_partkey % 50) AS u, greatest(l_suppkey, l_partkey % 50) AS v, l_quantity AS length_m FROM lineitem)) WHERE r = 1")
def parallel_reduced(spark, sf):
    i = table(spark, sf, "lineitem")
    return graph.parallel_reduced(i.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("segment_id"), F.col("l_suppkey").alias("u"), (F.col("l_partkey") % 50).alias("v"), F.col("l_quantity").alias("length_m")))


def _ways(lines):
    """Orders' parts as ways: each line is a node."""
    per = lines.groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda s: s["l_partkey"]).alias("node_ids"))
    return per.where(F.size("node_ids") > 1).select(F.col("l_orderkey").alias("way_id"), "node_ids")


@query(
    """SELECT CAST(way_id AS VARCHAR) || '-' || CAST(k AS VARCHAR) AS segment_id, way_id, first(node ORDER BY pos) AS u, last(node ORDER BY pos) AS v, count(*) AS n_nodes FROM (
  SELECT way_id, pos, node, k FROM n UNION ALL SELECT way_id, pos, node, k - 1 FROM n WHERE cut) GROUP BY way_id, k HAVING count(*) > 1""",
    w="SELECT l_orderkey AS way_id, list(l_partkey ORDER BY l_linenumber, l_partkey) AS nodes FROM lineitem GROUP BY 1 HAVING count(*) > 1",
    f="SELECT way_id, unnest(range(len(nodes))) AS pos, unnest(nodes) AS node, len(nodes) - 1 AS last FROM w",
    n="SELECT *, CAST(sum(cut::INT) OVER (PARTITION BY way_id ORDER BY pos) AS BIGINT) AS k FROM (SELECT *, pos > 0 AND pos < last AND count(*) OVER (PARTITION BY node) > 1 AS cut FROM f)",
)
def split_ways(spark, sf):
    ways = _ways(table(spark, sf, "lineitem"))
    return segments.split_ways(ways).select("segment_id", "way_id", "u", "v", F.size("node_ids").cast("bigint").alias("n_nodes"))


_GRAPH = {
    "w": "SELECT l_orderkey AS way_id, list(l_partkey ORDER BY l_linenumber, l_partkey) AS nodes FROM lineitem WHERE l_linenumber <= 3 GROUP BY 1 HAVING count(*) > 1",
    "f": "SELECT way_id, unnest(range(len(nodes))) AS pos, unnest(nodes) AS node, len(nodes) - 1 AS last FROM w",
    "n": "SELECT *, CAST(sum(cut::INT) OVER (PARTITION BY way_id ORDER BY pos) AS BIGINT) AS k FROM (SELECT *, pos > 0 AND pos < last AND count(*) OVER (PARTITION BY node) > 1 AS cut FROM f)",
    "s": "SELECT way_id, pos, k, node, CAST(node * 37 % 1000 AS DOUBLE) AS x, CAST(node * 91 % 1000 AS DOUBLE) AS y FROM (SELECT way_id, pos, node, k FROM n UNION ALL SELECT way_id, pos, node, k - 1 FROM n WHERE cut)",
    "d": "SELECT *, sqrt((x - lag(x) OVER g) ** 2 + (y - lag(y) OVER g) ** 2) AS step FROM s WINDOW g AS (PARTITION BY way_id, k ORDER BY pos)",
}


@query(
    """SELECT CAST(way_id AS VARCHAR) || '-' || CAST(k AS VARCHAR) AS segment_id, first(node ORDER BY pos) AS u, last(node ORDER BY pos) AS v, round(sum(step), 6) AS length_m,
  round((degrees(atan2(last(x ORDER BY pos) - first(x ORDER BY pos), last(y ORDER BY pos) - first(y ORDER BY pos))) + 360) % 180, 6) AS bearing_deg, way_id % 3 = 0 AS is_steps, way_id % 4 = 0 AS is_crossing,
  CASE WHEN way_id % 5 = 0 THEN 'separate' END AS sidewalk_state, way_id % 5 <> 0 AS in_metric_graph FROM d GROUP BY way_id, k HAVING count(*) > 1""",
    **_GRAPH,
)
def street_graph(spark, sf):
    """Orders as ways along the parts of their first three lines; the components have a query of their own."""
    ways = _ways(table(spark, sf, "lineitem").where("l_linenumber <= 3"))
    k = F.col("way_id")
    tags = F.map_filter(F.create_map(F.lit("highway"), F.when(k % 3 == 0, "steps").otherwise("footway"), F.lit("footway"), F.when(k % 4 == 0, "crossing"), F.lit("sidewalk"), F.when(k % 5 == 0, "separate")), lambda _, v: v.isNotNull())
    nodes = table(spark, sf, "part").select(F.col("p_partkey").alias("node_id"), (F.col("p_partkey") * 37 % 1000).cast("double").alias("x"), (F.col("p_partkey") * 91 % 1000).cast("double").alias("y"))
    out = connections.build_graph(ways.withColumn("tags", tags), nodes)
    return _r6(out.select("segment_id", "u", "v", "length_m", "bearing_deg", "is_steps", "is_crossing", "sidewalk_state", "in_metric_graph"))


_TAGS = [
    (1, {"highway": "footway"}), (2, {"highway": "cycleway"}), (3, {"highway": "cycleway", "foot": "designated"}), (4, {"highway": "motorway"}), (5, {"highway": "residential", "access": "private"}),
    (6, {"highway": "residential", "access": "private", "foot": "yes"}), (7, {"highway": "pedestrian", "area": "yes"}), (8, {"name": "x"}), (9, {"highway": "service", "service": "private", "foot": "yes"}),
    (10, {"highway": "primary_link", "sidewalk": "both", "lit": "yes", "width": "3.5 m", "height": "12 m"}), (11, {"highway": "primary", "sidewalk:left": "yes"}), (12, {"highway": "tertiary", "sidewalk:left": "yes", "sidewalk:right": "yes", "building:levels": "4"}),
    (13, {"highway": "tertiary", "sidewalk:left": "separate", "sidewalk:right": "yes"}), (14, {"highway": "road", "sidewalk": "none", "width": "wide"}), (15, {"highway": "steps", "sidewalk:both": "yes", "foot": "no"}),
]


def tagged(spark):
    return spark.createDataFrame(_TAGS, "id int, tags map<string, string>")


@query(
    """SELECT id, walkable, sidewalk, CAST(width AS DOUBLE) AS width, CAST(height AS DOUBLE) AS height, height_from, matched FROM (VALUES (1, true, NULL, NULL, 9.0, 'default', false), (2, false, NULL, NULL, 9.0, 'default', false), (3, true, NULL, NULL, 9.0, 'default', true), (4, false, NULL, NULL, 9.0, 'default', false), (5, false, NULL, NULL, 9.0, 'default', false),
  (6, true, NULL, NULL, 9.0, 'default', false), (7, false, NULL, NULL, 9.0, 'default', false), (8, false, NULL, NULL, 9.0, 'default', false), (9, false, NULL, NULL, 9.0, 'default', false), (10, true, 'both', 3.5, 12.0, 'height', true),
  (11, true, 'left', NULL, 9.0, 'default', false), (12, true, 'both', NULL, 12.0, 'levels', false), (13, true, 'separate', NULL, 9.0, 'default', false), (14, true, 'no', NULL, 9.0, 'default', false), (15, false, 'both', NULL, 9.0, 'default', false)) AS t(id, walkable, sidewalk, width, height, height_from, matched)"""
)
def tag_rules(spark, sf):
    t = F.col("tags")
    height, source = segments.building_height(t)
    return tagged(spark).select(
        "id", segments.is_walkable(t).alias("walkable"), segments.sidewalk_state(t).alias("sidewalk"), segments.metres(segments.tag(t, "width")).alias("width"), height.alias("height"),
        source.alias("height_from"), segments.matches(t, ["foot=designated", "lit=*"]).alias("matched"),
    )


#: Tag values that orders take in turn, by powers of their key.
_TAG_VALUES = {
    "highway": ("footway", "residential", "primary_link", "steps", "corridor", "crossing", "motorway", None, "service"), "footway": (None, "sidewalk", "crossing"), "bridge": (None, "yes", "no", "viaduct"),
    "tunnel": (None, None, "yes", "no", "culvert"), "covered": (None, "arcade", "no", "yes", "colonnade", "booth"), "sidewalk": (None, "both", "left", "no", "separate", "yes", "none"),
    "sidewalk:left": (None, "yes", "separate"), "surface": (None, "asphalt", "gravel", "paving_stones"), "lit": (None, "yes", "no", "24/7", "disused"), "width": (None, "2.5", "3 m", "wide"), "indoor": (None, "yes", "no", "corridor", None, None, None),
}


def _tag_pick(i: int, n: int) -> str:
    return f"CAST(floor(o_orderkey / {1 + i * 3}) AS BIGINT) % {n}"


def _tag_sql(k: str) -> str:
    i, values = list(_TAG_VALUES).index(k), _TAG_VALUES[k]
    return f"CASE {_tag_pick(i, len(values))} " + " ".join(f"WHEN {j} THEN '{v}'" for j, v in enumerate(values) if v is not None) + " END"


def _one_hot() -> str:
    kind = "replace(hw, '_link', '')"
    known = ", ".join(f"'{c}'" for c in segments.HIGHWAY_CLASSES)
    return ", ".join(f"coalesce({kind} = '{c}', false) AS hw_{c}" for c in segments.HIGHWAY_CLASSES) + f", coalesce({kind} NOT IN ({known}), true) AS hw_other"


@query(
    f"""SELECT segment_id, {_one_hot()}, coalesce(fw = 'sidewalk', false) AS is_sidewalk, coalesce(fw = 'crossing', false) OR coalesce(hw = 'crossing', false) AS is_crossing, coalesce(hw = 'steps', false) AS is_steps,
  coalesce(hw = 'corridor', false) OR coalesce(ind IN ('yes', 'corridor'), false) AS is_indoor, false AS is_inferred, false AS is_area_edge, false AS is_detected, coalesce(br <> 'no', false) AS is_bridge, coalesce(tu <> 'no', false) AS is_tunnel,
  coalesce(co IN ('yes', 'arcade', 'colonnade'), false) AS is_covered, coalesce(st = 'both', false) AS sidewalk_both, coalesce(st IN ('left', 'right'), false) AS sidewalk_one_side, coalesce(st = 'no', false) AS sidewalk_none,
  coalesce(st = 'separate', false) AS sidewalk_separate, st IS NULL AS sidewalk_missing, CASE WHEN su IS NOT NULL THEN CASE WHEN su IN ('asphalt', 'paving_stones') THEN 1.0 ELSE 0.0 END END::DOUBLE AS surface_paved, su IS NULL AS surface_paved_missing,
  CASE WHEN li IS NOT NULL THEN CASE WHEN li IN ('no', 'disused') THEN 0.0 ELSE 1.0 END END::DOUBLE AS lit, li IS NULL AS lit_missing, TRY_CAST(trim(replace(wi, 'm', '')) AS DOUBLE) AS width_m, TRY_CAST(trim(replace(wi, 'm', '')) AS DOUBLE) IS NULL AS width_missing FROM (
  SELECT *, CASE WHEN sw IN ('no', 'none') THEN 'no' WHEN sw IN ('yes', 'both') THEN 'both' WHEN sw IS NOT NULL THEN sw WHEN sl = 'separate' THEN 'separate' WHEN sl = 'yes' THEN 'left' END AS st FROM tagged)""",
    tagged="SELECT o_orderkey AS segment_id, " + ", ".join(f"{_tag_sql(k)} AS {a}" for k, a in zip(_TAG_VALUES, ("hw", "fw", "br", "tu", "co", "sw", "sl", "su", "li", "wi", "ind"), strict=True)) + " FROM orders",
)
def segment_tag_features(spark, sf):
    """Orders as segments, tagged by their keys."""
    values = {k: F.get(F.array(*[F.lit(v).cast("string") for v in v_]), F.expr(_tag_pick(i, len(v_))).cast("int")) for i, (k, v_) in enumerate(_TAG_VALUES.items())}
    tags = F.map_filter(F.create_map(*[x for k, v in values.items() for x in (F.lit(k), v)]), lambda _, v: v.isNotNull())
    own = segments.segment_flags(table(spark, sf, "orders").select(F.col("o_orderkey").alias("segment_id"), tags.alias("tags")))
    out = segments.tag_features(own)
    return out.drop("tags", "highway", "bridge", "tunnel", "covered", "sidewalk_state")


@query("""SELECT * FROM (VALUES (1, '{"a":"x","b\\"c":"y=>z"}'), (2, '{}'), (3, '{}')) AS t(id, tags)""")
def hstore_tags(spark, sf):
    rows = spark.createDataFrame([(1, '"b\\"c"=>"y=>z","a"=>"x"'), (2, ""), (3, None)], "id int, s string")
    return rows.select("id", segments.sorted_json(segments.parse_hstore(F.col("s"))).alias("tags"))


_HOURS = ("24/7", "Mo-Fr 08:00-18:00, Sa 09:00-12:00", "Fr-Mo 22:00-02:00", "Mo-Su 10:00-17:00; We off", "17:00+", "PH off; Sa,Su 07:30-11:00", "sunrise-sunset", "Mo 25:99-26:00")


@query(
    """SELECT * FROM (VALUES (0, 168, 0, 167), (1, 53, 8, 131), (2, 16, 0, 167), (3, 42, 10, 160), (4, 49, 17, 167), (5, 8, 127, 154), (6, NULL, NULL, NULL), (7, NULL, NULL, NULL)) AS t(id, n_open, first_open, last_open)"""
)
def opening_hours_mask(spark, sf):
    rows = spark.createDataFrame(list(enumerate(_HOURS)), "id int, hours string").repartition(2)
    m = rows.withColumn("m", opening_hours.open_hours("hours")).withColumn("open", F.filter(F.transform("m", lambda x, i: F.when(x, i)), lambda x: x.isNotNull()))
    return m.select("id", F.when(F.col("m").isNotNull(), F.size("open")).alias("n_open"), F.array_min("open").alias("first_open"), F.array_max("open").alias("last_open"))


@query("SELECT property, year, CAST(n - coalesce(p, 0) AS DOUBLE) AS gain FROM (SELECT property, year, coalesce(n, 0) AS n, lag(coalesce(n, 0)) OVER (PARTITION BY property ORDER BY year) AS p FROM (SELECT DISTINCT property FROM v_years), (SELECT DISTINCT year FROM v_years) LEFT JOIN (SELECT property AS q, year AS y, count(*) AS n FROM v_years GROUP BY 1, 2) ON q = property AND y = year) WHERE p IS NOT NULL AND n - p >= 5")
def property_jumps(spark, sf):
    return openings.property_jumps(v_years(spark, sf), "property", "year", None, 5)


@query("SELECT property, year, least(count(*) / 100, 1) AS completeness FROM v_years GROUP BY 1, 2")
def year_completeness(spark, sf):
    return openings.year_completeness(v_years(spark, sf), "property", "year", 100)


_GAIN = "SELECT property, year, CAST(n - p AS DOUBLE) AS gain FROM (SELECT property, year, coalesce(n, 0) AS n, lag(coalesce(n, 0)) OVER (PARTITION BY property ORDER BY year) AS p FROM (SELECT DISTINCT property FROM {0}), (SELECT DISTINCT year FROM {0}) LEFT JOIN (SELECT property AS q, year AS y, count(*) AS n FROM {0} GROUP BY 1, 2) ON q = property AND y = year) WHERE n - p >= 3"


@query(
    "SELECT coalesce(a.property, b.property) AS property, coalesce(a.year, b.year) AS year, coalesce(a.gain, 0) AS gain_a, coalesce(b.gain, 0) AS gain_b FROM ga a FULL JOIN gb b ON a.property = b.property AND a.year = b.year",
    ya="SELECT * FROM v_years WHERE o_orderkey % 2 = 0", yb="SELECT * FROM v_years WHERE o_orderkey % 2 = 1", ga=_GAIN.format("ya"), gb=_GAIN.format("yb"),
)
def joined_gains(spark, sf):
    y = v_years(spark, sf)
    a, b = (openings.property_jumps(y.where(f"o_orderkey % 2 = {k}"), "property", "year", None, 3) for k in (0, 1))
    return openings.joined_gains(a, b, "property", "year")


@query("SELECT k AS property, string_agg(n, '; ' ORDER BY o, n) AS tenants FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY o, n) AS r FROM (SELECT c_nationkey AS k, c_mktsegment AS n, min(c_custkey) AS o FROM customer GROUP BY 1, 2)) WHERE r <= 4 GROUP BY 1")
def first_tenants(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_nationkey").alias("property"), F.col("c_mktsegment").alias("name"), "c_custkey")
    return openings.tenants(c, "property", "name", "c_custkey")


@query(
    "SELECT property, year, CAST(n - coalesce(lag(n) OVER (PARTITION BY property ORDER BY year), 0) AS BIGINT) AS neighbourhood_gain FROM (SELECT u AS property, year, sum(n) AS n FROM v_lattice JOIN (SELECT property AS p, year, count(*) AS n FROM v_years GROUP BY 1, 2) ON p = v GROUP BY 1, 2)"
)
def neighbourhood_gain(spark, sf):
    counts = v_years(spark, sf).groupBy("property", "year").agg(F.count("*").alias("n"))
    rings = v_lattice(spark, sf).select(F.col("u").alias("property"), F.col("v").alias("other"))
    return openings.neighbourhood_gain(counts, rings, "property", "year")


@query(
    "SELECT s.id AS property, CAST(s.x AS BIGINT) AS size, coalesce(sensors, '') AS sensors, coalesce(n, 0) AS n_sensors, coalesce(n, 0) > 0 AS feasible FROM v_sites s LEFT JOIN (SELECT a_id, string_agg(CAST(b_id AS VARCHAR), ',' ORDER BY dist, b_id) AS sensors, count(*) AS n FROM d WHERE dist <= 25 GROUP BY 1) ON a_id = s.id", **_PAIRS
)
def new_openings(spark, sf):
    sites = v_sites(spark, sf)
    out = spatial.new_openings(sites.select(F.col("id").alias("property"), F.col("x").cast("bigint").alias("size")), sites, v_places(spark, sf), 25.0)
    return out.fillna({"sensors": "", "n_sensors": 0}).select("property", "size", "sensors", "n_sensors", "feasible")


_HOLD = {"north": [1, 2], "south": [5]}


@query(None)
def location_splits(spark, sf):
    return splits.splits(v_sites(spark, sf), _HOLD)


@query(
    "SELECT v.row_id, CASE WHEN v.fold = 2 THEN 'test' ELSE 'train' END AS part FROM v_scored v WHERE v.fold = 2 OR v.location_id NOT IN (SELECT b.id FROM v_sites a JOIN v_sites b ON a.id % 5 = 2 AND b.id % 5 <> 2 AND sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) < 90)"
)
def leak_safe_fold(spark, sf):
    sites = v_sites(spark, sf).withColumn("fold", (F.col("id") % 5).cast("int"))
    near = spatial.fold_neighbours(sites, 90.0)
    rows = v_scored(spark, sf).drop("fold")
    folds = sites.select(F.col("id").cast("int").alias("location_id"), "fold")
    return splits.fold_rows(rows, folds, near, "location_id", 2).select("row_id", "part")


@query("SELECT l AS location_id, coalesce(g, (SELECT max(id % 4) FROM v_sites WHERE id % 3 <> 0) + 1 + l)::INTEGER AS \"group\" FROM (SELECT DISTINCT location_id AS l FROM v_scored) LEFT JOIN (SELECT id, id % 4 AS g FROM v_sites WHERE id % 3 <> 0) ON id = l")
def spatial_groups(spark, sf):
    """Every sensor; those that the list of groups has not got get groups of their own."""
    groups = v_sites(spark, sf).where("id % 3 <> 0").select(F.col("id").cast("int").alias("location_id"), (F.col("id") % 4).cast("int").alias("group"))
    return splits.spatial_groups(v_scored(spark, sf).select("location_id").distinct(), groups, "location_id")


@query("SELECT row_id, location_id FROM v_scored WHERE location_id NOT IN (1, 2, 3)")
def final_training_rows(spark, sf):
    held = spark.createDataFrame([(1, -1), (2, -1), (3, -1), (4, 0)], "location_id int, fold int")
    return splits.final_rows(v_scored(spark, sf), held, "location_id").select("row_id", "location_id")


@query("SELECT k AS location_id, CAST((row_number() OVER (ORDER BY k) - 1) % 3 AS INTEGER) AS fold FROM (SELECT DISTINCT location_id AS k FROM v_scored)")
def round_robin_folds(spark, sf):
    return splits.row_number_folds(v_scored(spark, sf), "location_id", 3)


def _hours(spark, sf):
    v = v_hourly(spark, sf)
    return v.withColumn("hour_of_week", (F.weekday("ts_utc") * 24 + F.hour("ts_utc")).cast("int"))


@query(
    """SELECT h.location_id, ts_utc, pedestriancount, round(greatest(exp(coalesce(u.usual, (SELECT avg(ln(1 + pedestriancount)) FROM h WHERE location_id < 6)) + m + b * (x - mu) / sd) - 1, 0), 6) AS predicted
FROM h LEFT JOIN usual u ON u.hour_of_week = h.hour_of_week JOIN sensor s ON s.id = h.location_id, best""",
    h="SELECT *, (isodow(ts_utc) - 1) * 24 + hour(ts_utc) AS hour_of_week FROM v_hourly",
    sensor="SELECT id, ln(1 + id * 3 % 5) AS x FROM range(8) AS t(id)",
    usual="SELECT hour_of_week, avg(ln(1 + pedestriancount)) AS usual FROM h WHERE location_id < 6 GROUP BY 1",
    lefts="SELECT location_id, avg(ln(1 + pedestriancount) - usual) AS t, any_value(x) AS x FROM h JOIN usual USING (hour_of_week) JOIN sensor ON id = location_id WHERE location_id < 6 GROUP BY 1",
    scaled="SELECT t, (x - mu) / sd AS z, mu, sd, m, n FROM lefts, (SELECT avg(x) AS mu, CASE WHEN stddev_pop(x) > 0 THEN stddev_pop(x) ELSE 1 END AS sd, avg(t) AS m, count(*) AS n FROM lefts)",
    fits="SELECT a, alpha, sum(z * t) / (sum(z * z) + alpha) AS b, sum(z * z) + alpha AS q FROM scaled, (SELECT a, power(10, -3 + a * 0.5) AS alpha FROM range(13) AS r(a)) GROUP BY 1, 2",
    best="SELECT b, any_value(m) AS m, any_value(mu) AS mu, any_value(sd) AS sd, avg(((t - m - b * z) / greatest(1 - 1 / n - z * z / q, 1e-9)) ** 2) AS loo FROM scaled, fits GROUP BY a, b ORDER BY loo, a LIMIT 1",
)
def baseline_predictions(spark, sf):
    sensors = spark.range(8).select(F.col("id").cast("int").alias("location_id"), (F.col("id") * 3 % 5).cast("double").alias("reach"))
    rows = _hours(spark, sf)
    m = models.fit_baseline(rows.where("location_id < 6"), sensors, "location_id", "hour_of_week", "pedestriancount", ["reach"])
    return _r6(models.predict_baseline(m, rows, sensors, "location_id", "hour_of_week").select("location_id", "ts_utc", "pedestriancount", "predicted"))


@query(None)
def poisson_candidate(spark, sf):
    rows = _hours(spark, sf).withColumns({"h": F.hour("ts_utc").cast("double"), "w": F.weekday("ts_utc").cast("double")})
    m = models.fit_poisson(rows.where("location_id < 6"), "pedestriancount", ["h", "w"])
    out = models.predict(m, rows, ["h", "w"]).groupBy("location_id").agg(metrics.wape("pedestriancount", "predicted").alias("wape"), F.count("*").alias("n_rows"))
    return out.withColumn("wape", F.round("wape", 4))


@query(None)
def boosted_out_of_fold(spark, sf):
    """Boosted trees of the hourly counts, each sensor predicted by a model that hasn't seen it, with an interval."""
    rows = _hours(spark, sf).withColumns({"h": F.hour("ts_utc").cast("double"), "w": F.weekday("ts_utc").cast("double"), "fold": F.col("location_id") % 2})
    out = boosting.oof_intervals(rows, "fold", "pedestriancount", ["h", "w"], settings=boosting.Settings(rounds=3, depth=2, rate=0.5, bins=16))
    return _r6(out.select("location_id", "ts_utc", "pedestriancount", "predicted", "lower", "upper"))


@query(
    "SELECT model, first(version ORDER BY started DESC) AS version, max(started) AS started, 'FINISHED' AS status FROM runs WHERE status = 'FINISHED' GROUP BY 1",
    runs="SELECT 'm' || CAST(o_custkey % 5 AS VARCHAR) AS model, o_orderkey AS version, o_orderkey AS started, CASE o_orderstatus WHEN 'F' THEN 'FINISHED' ELSE 'RUNNING' END AS status FROM orders",
)
def latest_runs(spark, sf):
    o = table(spark, sf, "orders").select(F.concat(F.lit("m"), F.col("o_custkey") % 5).alias("model"), F.col("o_orderkey").alias("version"), F.col("o_orderkey").alias("started"), F.when(F.col("o_orderstatus") == "F", "FINISHED").otherwise("RUNNING").alias("status"))
    return models.latest_runs(o, ["model"], "started")


@query(
    "SELECT model, max(version) AS version FROM v JOIN (SELECT model AS m, max(version) AS top FROM v GROUP BY 1) ON m = model WHERE version < top GROUP BY 1",
    v="SELECT 'm' || CAST(o_custkey % 5 AS VARCHAR) AS model, o_orderkey AS version FROM orders",
)
def registry_rollback(spark, sf):
    o = table(spark, sf, "orders").select(F.concat(F.lit("m"), F.col("o_custkey") % 5).alias("model"), F.col("o_orderkey").alias("version"))
    top = o.groupBy("model").agg(F.max("version").alias("_top"))
    return models.rollback(o.join(top, "model").withColumn("is_champion", F.col("version") == F.col("_top")).drop("_top"))


@query("SELECT page_id, unnest(regexp_extract_all(html, '<a[^>]*href=\"([^\"]*)\"[^>]*>([^<]*)</a>', 1)) AS href, unnest(regexp_extract_all(html, '<a[^>]*href=\"([^\"]*)\"[^>]*>([^<]*)</a>', 2)) AS label FROM pages")
def html_rows(spark, sf):
    return files.rows_of_pages(table(spark, sf, "pages"), "html", r'<a[^>]*href="([^"]*)"[^>]*>([^<]*)</a>', {"href": 1, "label": 2}, ["page_id"])


@query("SELECT unnest(regexp_extract_all(html, '<p>([^<]*)</p>', 1)) AS paragraph, page_id FROM pages")
def html_paragraphs(spark, sf):
    return files.rows_of_pages(table(spark, sf, "pages"), "html", r"<p>([^<]*)</p>", {"paragraph": 1}, ["page_id"])


_GAMES = """'Sat 21-Mar-2015 7:20 PM (4:20 PM)<b>Att: </b>34,672 <b>Venue:</b> <a href="x">M.C.G.</a> Sun 22-Mar-2015 1:10 PM <b>Venue:</b> <a>Docklands </a>'"""


@query("SELECT * FROM (VALUES ('2015-03-21', '7:20 PM', '4:20 PM', '34672', 'M.C.G.', '2015'), ('2015-03-22', '1:10 PM', '1:10 PM', '', 'Docklands', '2015')) AS t(date, local_time, melbourne_time, attendance, venue, season)")
def season_games(spark, sf):
    pages = spark.createDataFrame([(_GAMES, 2015)], "html string, season int")
    return files.games(pages, "html", "season")


@query("SELECT s_suppkey AS id, 'https://web.archive.org/web/2019id_/' || s_name AS url FROM supplier")
def archive_urls(spark, sf):
    return table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), files.wayback_url(F.lit("2019"), F.col("s_name")).alias("url"))
