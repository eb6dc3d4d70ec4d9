"""Contracts of tables: Spark schemas whose fields say in their metadata what each column is for.

A column's use is key, label, aux, meta, portable (a feature of any site) or local (a feature of one site only). What
models may see, what a table is brought to and what it is checked against all follow from the same schema.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

USES = ("key", "label", "aux", "meta", "portable", "local")
_TYPES = {t.simpleString(): t for t in (T.BooleanType(), T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.StringType(), T.DateType(), T.TimestampNTZType())}
_TYPES["line"] = T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]))


def contract(text: str) -> T.StructType:
    """A schema from lines of `use source: name type, name type`; names are unique."""
    fields: list[T.StructField] = []
    for line in filter(None, map(str.strip, text.splitlines())):
        head, _, columns = line.partition(":")
        use, source = head.split()
        if use not in USES:
            raise ValueError(f"unknown use {use!r}")
        for column in columns.split(","):
            name, kind = column.split()
            if kind not in _TYPES or any(f.name == name for f in fields):
                raise ValueError(f"{name}: unknown type {kind!r}, or named twice")
            fields.append(T.StructField(name, _TYPES[kind], use != "key", {"use": use, "source": source}))
    return T.StructType(fields)


def used_as(schema: T.StructType, *uses: str) -> list[str]:
    return [f.name for f in schema.fields if f.metadata["use"] in uses]


def features(schema: T.StructType, variant: str = "rich") -> list[str]:
    """What a variant's models see: all features, or those of any site."""
    seen = {"rich": ("portable", "local"), "portable": ("portable",)}
    if variant not in seen:
        raise ValueError(f"unknown variant {variant!r}")
    return used_as(schema, *seen[variant])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in their order and types; a column that is missing is null."""
    return df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def check(df: DataFrame, schema: T.StructType) -> DataFrame:
    """column_name, problem and n_rows where a table departs from its schema: missing, extra or of another type, or a key that is null or, all keys taken together, repeated."""
    held, wanted = {f.name: f.dataType for f in df.schema.fields}, {f.name: f.dataType for f in schema.fields}
    found = [(c, "missing" if c not in held else f"is {held[c].simpleString()}", None) for c, t in wanted.items() if held.get(c) != t]
    found += [(c, "extra", None) for c in held if c not in wanted]
    out = df.sparkSession.createDataFrame(found, "column_name string, problem string, n_rows long")
    keys = [k for k in used_as(schema, "key") if k in held]
    if not keys:
        return out
    null = df.agg(*[F.count_if(F.col(k).isNull()).alias(k) for k in keys]).unpivot([], keys, "column_name", "n_rows").select("column_name", F.lit("null key").alias("problem"), "n_rows")
    twice = df.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.lit("+".join(keys)).alias("column_name"), F.lit("repeated key").alias("problem"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_rows"))
    return out.unionByName(null.unionByName(twice).where("n_rows > 0"))


def _named(prefix: str, names: Sequence[str], kind: str, suffix: str = "") -> str:
    return ", ".join(f"{prefix}{n}{suffix} {kind}" for n in names)


# The tables' column names.
WEATHER = ("temperature_2m", "apparent_temperature", "relative_humidity_2m", "cloud_cover", "wind_speed_10m", "is_day", "precipitation", "rain", "shortwave_radiation")
HIGHWAYS = ("footway", "path", "pedestrian", "steps", "corridor", "living_street", "residential", "service", "unclassified", "tertiary", "secondary", "primary", "trunk", "cycleway", "track", "other")
FLAGS = ("sidewalk", "crossing", "steps", "indoor", "bridge", "tunnel", "covered", "inferred", "area_edge", "detected")
SIDEWALKS = ("both", "one_side", "none", "separate", "missing")
NETWORK = (
    "met_betweenness", "met_betweenness_lw", "met_closeness", "met_harmonic", "met_reach", "met_reach_len", "junctions",
    "ang_choice", "ang_choice_lw", "ang_node_count", "ang_reach_len", "ang_total_depth", "ang_integration", "ang_choice_norm",
)

COUNTS_HOURLY = contract(f"""
    key counts: location_id int, ts_utc timestamp_ntz
    aux time: ts_local timestamp_ntz, date_local date
    portable time: hour_local tinyint
    meta counts: source string
    label counts: pedestriancount int
    aux counts: direction_1 float, direction_2 float
    meta counts: suspect_outage_zero boolean
    portable time: weekday tinyint
    aux time: hour_of_week smallint
    portable time: is_weekend boolean
    portable calendars: is_public_holiday boolean, school_term boolean, uni_teaching boolean, uni_exams boolean
    portable sun: sun_elevation_deg float
    aux sun: sun_azimuth_deg float
    portable time: covid_period boolean
    local time: post_metro_tunnel boolean
    portable weather: {_named("wx_", WEATHER, "float")}
    meta sensor_match: sensor_description string, location_type string, segment_id string, match_method string, needs_review boolean
    local footpath_steepness: slope_pct float, slope_pct_local_mean float, elevation_m float
    meta footpath_steepness: place_source string
    meta sensor_match: has_location boolean
""")

SENSORS = contract("""
    key sensor_match: location_id bigint
    meta sensor_match: sensor_description string, location_type string, location_source string, segment_id string, match_distance_m double, match_method string, needs_review boolean
""")

#: What the training frame derives for each row.
DERIVED = contract("""
    portable shade: shade_portable float
    local shade: shade_rich float
    portable events: event_pre boolean, event_during boolean, event_post boolean, event_dist_m float, event_day_dist_m float
""")


def segment_features(
    places: Sequence[str], place_radii: Sequence[int] = (100, 200, 400), jobs_radii: Sequence[int] = (400, 800), business_radii: Sequence[int] = (200, 400), network_radii: Sequence[int] = (400, 800, 1600)
) -> T.StructType:
    """The table of street segments, for kinds of places and the radii that things are counted in."""
    return contract("\n".join([
        "key osm: segment_id string", "meta osm: way_id bigint, name string", "aux osm: highway string",
        "portable osm: " + ", ".join([_named("hw_", HIGHWAYS, "boolean"), _named("is_", FLAGS, "boolean"), _named("sidewalk_", SIDEWALKS, "boolean")]),
        "portable osm: surface_paved double, surface_paved_missing boolean, lit double, lit_missing boolean, width_m double, width_missing boolean",
        "aux osm: length_m double, bearing_deg double",
        *[f"portable osm: {_named('poi_', places, 'double', f'_{r}')}" for r in place_radii],
        "portable osm: building_coverage double, building_count bigint, green_dist_m double, ped_area_dist_m double, green_adjacent boolean, tram_stop_dist_m double, bus_stop_dist_m double, rail_station_dist_m double",
        "local osm: recent_station_dist_m double",
        "portable worldcover: wc_tree_share double, wc_grass_share double, wc_built_share double",
        "portable dem: dem_slope_mean_pct double, dem_slope_max_pct double",
        "local com_canopy: canopy_cover double",
        f"local com_clue: {', '.join(f'clue_jobs_{r} double' for r in jobs_radii)}",
        f"local com_business: {', '.join(f'businesses_{r} double' for r in business_radii)}",
        "portable osm: degree_min bigint, degree_max bigint",
        *[f"portable osm: {_named('', NETWORK, 'double', f'_{r}')}" for r in network_radii],
        "portable osm: in_main_component boolean", "meta osm: in_metric_graph boolean, in_feature_mask boolean, geometry line",
    ]))


def sensor_features(segments: T.StructType) -> T.StructType:
    """The table of sensors with what their segment has, but for its key and its line."""
    return T.StructType([*SENSORS.fields, *[f for f in segments.fields if f.name not in ("segment_id", "geometry")]])
