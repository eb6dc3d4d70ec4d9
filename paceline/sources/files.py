"""Readers of count archives, weather, minute feeds, annotations and pages; writers with manifests and history."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

ARCHIVE_SCHEMA = "ID long, Date_Time string, Sensor_ID int, Hourly_Counts long"
MINUTE_SCHEMA = "location_id long, sensing_datetime timestamp_ntz, sensing_date date, direction_1 long, direction_2 long, total_of_directions long, polled_at timestamp_ntz"


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The historical CSV: dates like November 01, 2019 05:00:00 PM; it has no directions."""
    raw = spark.read.schema(ARCHIVE_SCHEMA).option("header", True).csv(path)
    ts = F.to_timestamp_ntz("Date_Time", F.lit("MMMM dd, yyyy hh:mm:ss a"))
    none = F.lit(None).cast("float")
    return raw.select(F.col("ID").alias("row_id"), F.col("Sensor_ID").alias("location_id"), ts.alias("ts_local"), F.col("Hourly_Counts").alias("pedestriancount"), none.alias("direction_1"), none.alias("direction_2"), F.lit("archive").alias("source"))


def _hourly(raw: DataFrame, source: str) -> DataFrame:
    ts = F.timestamp_add("HOUR", F.col("hourday").cast("int"), F.col("sensing_date").cast("timestamp_ntz"))
    return raw.select(F.col("location_id").cast("int").alias("location_id"), ts.alias("ts_local"), F.col("pedestriancount").cast("long").alias("pedestriancount"), F.col("direction_1").cast("float").alias("direction_1"), F.col("direction_2").cast("float").alias("direction_2"), F.lit(source).alias("source"))


def read_live(spark: SparkSession, path: str) -> DataFrame:
    """The current hourly Parquet: a date and an hour of day."""
    return _hourly(spark.read.parquet(path), "live")


def read_wayback(spark: SparkSession, path: str) -> DataFrame:
    """The same columns from an old page: CSV with semicolons."""
    schema = "location_id long, sensing_date date, hourday int, direction_1 double, direction_2 double, pedestriancount long"
    return _hourly(spark.read.schema(schema).option("header", True).option("sep", ";").csv(path), "wayback")


def read_weather(spark: SparkSession, path: str, variables: Sequence[str]) -> DataFrame:
    """JSON files of parallel arrays at one fixed offset each, as rows in UTC; where files overlap the last by name wins."""
    arrays = ", ".join(f"{v}: array<double>" for v in variables)
    raw = spark.read.schema(f"utc_offset_seconds int, hourly struct<time: array<string>, {arrays}>").option("multiLine", True).json(path)
    rows = raw.select("utc_offset_seconds", F.input_file_name().alias("file"), F.explode(F.arrays_zip("hourly.time", *[f"hourly.{v}" for v in variables])).alias("h"))
    utc = F.timestamp_add("SECOND", -F.col("utc_offset_seconds"), F.to_timestamp_ntz(F.col("h.time"), F.lit("yyyy-MM-dd'T'HH:mm")))
    named = rows.select(utc.alias("ts_utc"), "file", *[F.col(f"h.{v}").alias(v) for v in variables])
    return named.groupBy("ts_utc").agg(F.max_by(F.struct(*variables), "file").alias("_w")).select("ts_utc", *[F.col(f"_w.{v}").alias(v) for v in variables])


def read_minutes(spark: SparkSession, folder: str) -> DataFrame:
    """All day files of the minute archive; a typed empty table if there are none."""
    try:
        return spark.read.schema(MINUTE_SCHEMA).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).parquet(folder)
    except AnalysisException:
        return spark.createDataFrame([], MINUTE_SCHEMA)


def read_since(spark: SparkSession, path: str, ts: str, start: str) -> DataFrame:
    """A table from an hour on: the filter reaches the Parquet scan."""
    return spark.read.parquet(path).where(F.col(ts) >= F.lit(start).cast("timestamp_ntz"))


def read_annotations(spark: SparkSession, path: str, scene: str, video: str) -> DataFrame:
    """Track boxes in space-separated lines, as centres."""
    schema = "track_id int, xmin double, ymin double, xmax double, ymax double, frame int, lost int, occluded int, generated int, label string"
    raw = spark.read.schema(schema).option("sep", " ").csv(path)
    return raw.select(F.lit(scene).alias("scene"), F.lit(video).alias("video"), "track_id", "frame", ((F.col("xmin") + F.col("xmax")) / 2).alias("x"), ((F.col("ymin") + F.col("ymax")) / 2).alias("y"), (F.col("lost") == 1).alias("lost"), "label")


def rows_of_pages(pages: DataFrame, html: str, pattern: str, groups: dict[str, int], keep: Sequence[str] = ()) -> DataFrame:
    """A row for each match of a pattern in a page, with its groups as columns."""
    lists = [F.regexp_extract_all(html, F.lit(pattern), g).alias(n) for n, g in groups.items()]
    return pages.select(*keep, F.explode(F.arrays_zip(*lists)).alias("_m")).select(*keep, *[F.col(f"_m.{n}").alias(n) for n in groups])


def games(pages: DataFrame, html: str, season: str) -> DataFrame:
    """Matches in a season's page: ISO date, local time and Melbourne's, attendance without commas, venue."""
    # Fixed value: the format of these pages.
    pattern = (
        r"(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun) (\d\d-\w{3}-\d{4}) (\d{1,2}:\d\d [AP]M)(?: \((\d{1,2}:\d\d [AP]M)\))?"
        r"\s*(?:<b>Att: </b>([\d,]+))?\s*<b>Venue:</b>\s*<a[^>]*>([^<]+)</a>"
    )
    got = rows_of_pages(pages, html, pattern, {"date": 1, "local_time": 2, "melbourne_time": 3, "attendance": 4, "venue": 5}, [season])
    day = F.date_format(F.to_date("date", "dd-MMM-yyyy"), "yyyy-MM-dd")
    there = F.when(F.col("melbourne_time") == "", F.col("local_time")).otherwise(F.col("melbourne_time"))
    return got.select(day.alias("date"), "local_time", there.alias("melbourne_time"), F.replace("attendance", F.lit(","), F.lit("")).alias("attendance"), F.trim("venue").alias("venue"), F.col(season).cast("string").alias("season"))


def ways(df: DataFrame, xmin: float, ymin: float, xmax: float, ymax: float) -> DataFrame:
    """Ways (way_id, nodes: array<struct<id, x, y>>, tags) without repeated neighbours, of two nodes at least, one in the box."""
    n = F.col("nodes")
    kept = F.filter(n, lambda p, i: (i == 0) | (F.get(n, i - 1)["id"] != p["id"]))
    own = df.withColumn("nodes", kept)
    inside = F.exists("nodes", lambda p: p["x"].between(xmin, xmax) & p["y"].between(ymin, ymax))
    return own.where((F.size("nodes") >= 2) & inside).withColumn("node_ids", F.transform("nodes", lambda p: p["id"]))


def manifest(spark: SparkSession, path: str, url: str, retrieved_at: str) -> DataFrame:
    """File name, size and SHA-256 of each file, with where and when it is from."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.lit(url).alias("url"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), F.lit(retrieved_at).alias("retrieved_at"))


def unlike(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Files that are missing or whose content changed."""
    e, f = expected.select("file", "sha256"), found.select("file", F.col("sha256").alias("_found"))
    return e.join(f, "file", "left").where(~F.col("sha256").eqNullSafe(F.col("_found"))).select("file")


def config_hash(config: dict) -> str:
    """A short name of settings that doesn't depend on their order."""
    return hashlib.sha256(json.dumps(config, sort_keys=True, default=str).encode()).hexdigest()[:12]


def is_current(stamp: dict | None, inputs: dict) -> bool:
    """Whether a stage can be left out: the same inputs made what is there."""
    return stamp is not None and stamp.get("inputs") == inputs


def write_table(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_csv(df: DataFrame, path: str, places: int = 4) -> None:
    """CSV with a header and numbers rounded."""
    fixed = {c: F.format_string(f"%.{places}f", F.col(c)) for c, t in df.dtypes if t in ("float", "double")}
    df.withColumns(fixed).write.mode("overwrite").option("header", True).csv(path)


def append_history(line: DataFrame, path: str) -> None:
    line.write.mode("append").json(path)


def last_run(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The newest line of a history; no row if there is none."""
    try:
        held = spark.read.schema(schema).json(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)
    names = [f.name for f in held.schema]
    return held.agg(F.max_by(F.struct(*names), "run_at").alias("_r")).where("_r is not null").select("_r.*")


def wayback_url(snapshot: Column, url: Column) -> Column:
    return F.format_string("https://web.archive.org/web/%sid_/%s", snapshot, url)
