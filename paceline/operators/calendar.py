"""Calendar features of hours, weather joined to hours, and the fact table they make."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clock, sun


@dataclass(frozen=True)
class Calendar:
    """What the features need to know of a place: ranges of dates, both ends included, and the years they cover."""

    holidays: Sequence[str] = ()
    terms: Sequence[tuple[str, str]] = ()
    term_years: Sequence[int] = ()
    teaching: Sequence[tuple[str, str]] = ()
    breaks: Sequence[tuple[str, str]] = ()
    exams: Sequence[tuple[str, str]] = ()
    university_years: Sequence[int] = ()
    covid: tuple[str, str] = ("2020-03-16", "2021-10-21")
    periods: dict[str, str] = field(default_factory=dict)
    lat: float = -37.8136
    lon: float = 144.9631


def time_features(df: DataFrame, utc: str, local: str, c: Calendar) -> DataFrame:
    """Local-clock calendar features and the sun at mid-hour; flags are null in years their calendar doesn't cover."""
    day = F.to_date(local)
    mid = F.timestamp_add("MINUTE", F.lit(30), F.col(utc))
    holidays = day.isin(*[F.to_date(F.lit(h)) for h in c.holidays]) if c.holidays else F.lit(False)
    out = {
        "date_local": day, "hour_local": F.hour(local).cast("tinyint"), "weekday": F.weekday(local).cast("tinyint"), "hour_of_week": clock.hour_of_week(F.col(local)).cast("smallint"),
        "is_weekend": F.weekday(local) >= 5, "is_public_holiday": holidays, "school_term": clock.covered(day, clock.in_ranges(day, c.terms), c.term_years or [-1]),
        "uni_teaching": clock.covered(day, clock.in_ranges(day, c.teaching) & ~clock.in_ranges(day, c.breaks), c.university_years or [-1]),
        "uni_exams": clock.covered(day, clock.in_ranges(day, c.exams), c.university_years or [-1]),
        "sun_elevation_deg": sun.elevation(mid, c.lat, c.lon), "sun_azimuth_deg": sun.azimuth(mid, c.lat, c.lon), "covid_period": clock.in_ranges(day, [c.covid]),
    }
    return df.withColumns(out | {f"post_{n}": day >= F.to_date(F.lit(d)) for n, d in c.periods.items()})


def weather_for(df: DataFrame, weather: DataFrame, ts: str, instants: Sequence[str], intervals: Sequence[str], prefix: str = "wx_") -> DataFrame:
    """Weather at each hour: instants are read at the hour, sums over the hour before a stamp at the next one.

    Both are one shift of the same table, so weather is joined once on each key; Spark broadcasts it if it is small.
    """
    at = weather.select(F.col(ts).alias("_at"), *[F.col(c).alias(prefix + c) for c in instants])
    over = weather.select(clock.add_hours(F.col(ts), -1).alias("_over"), *[F.col(c).alias(prefix + c) for c in intervals])
    return df.join(at, F.col(ts) == F.col("_at"), "left").join(over, F.col(ts) == F.col("_over"), "left").drop("_at", "_over")


def weather_spine(weather: DataFrame, ts: str, instants: Sequence[str], intervals: Sequence[str]) -> DataFrame:
    """A gap-free weather table with sums moved to the hour they fell in: needs no second join."""
    after = Window.partitionBy().orderBy(ts)  # one row an hour: some 9,000 a year
    return weather.select(ts, *instants, *[F.lead(c).over(after).alias(c) for c in intervals])


def weather_dedup(weather: DataFrame, ts: str, file: str) -> DataFrame:
    """Where files overlap, the last one by name wins."""
    names = [c for c in weather.columns if c not in (ts, file)]
    return weather.groupBy(ts).agg(F.max_by(F.struct(*names), file).alias("_r")).select(ts, *[F.col(f"_r.{n}").alias(n) for n in names])


def fact_table(counts: DataFrame, sensors: DataFrame, steepness: DataFrame, key: str, kind: str) -> DataFrame:
    """Counts with what is known of their sensor; has_location says whether anything is."""
    joined = many_to_one(counts, sensors, key).join(steepness, key, "left")
    return joined.withColumn("has_location", F.col(kind).isNotNull())


def many_to_one(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """A left join that fails if the right side has a key twice; the test is part of the plan, not a job of its own."""
    names = [c for c in right.columns if c != key]
    one = right.groupBy(key).agg(F.count("*").alias("_n"), F.first(F.struct(*names)).alias("_r"))
    checked = one.select(key, F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit(f"{key} isn't unique: "), F.col(key).cast("string")))).otherwise(F.col("_r")).alias("_r"))
    return left.join(checked, key, "left").select(*left.columns, *[F.col(f"_r.{n}").alias(n) for n in names])


def one_to_one(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A left join that fails if either side has a key twice."""
    n = left.groupBy(*keys).agg(F.count("*").alias("_m"))
    once = n.select(*keys, F.when(F.col("_m") > 1, F.raise_error(F.lit("the left keys aren't unique"))).otherwise(F.lit(1)).alias("_one"))
    own = left.join(once, list(keys)).where("_one = 1").drop("_one")
    packed = right.withColumn("_key", F.struct(*keys)).drop(*keys)
    return many_to_one(own.withColumn("_key", F.struct(*keys)), packed, "_key").drop("_key")


def hour_spine(spark, first: str, last: str, utc: str = "ts_utc") -> DataFrame:
    """Every hour from first to last, both included."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("timestamp_ntz"), F.lit(last).cast("timestamp_ntz"), F.expr("interval 1 hour"))).alias(utc))


def reference_hours(spark, first: str, last: str, zone: str, c: Calendar) -> DataFrame:
    """All hours of a span with their features: what representation is measured against."""
    spine = hour_spine(spark, first, last)
    return time_features(spine.withColumn("ts_local", clock.to_local(F.col("ts_utc"), zone)), "ts_utc", "ts_local", c)


def trainable(df: DataFrame, utc: str, start: str | None, zone: str) -> DataFrame:
    """Rows from the local midnight of `start` on; all without one."""
    return df if start is None else df.where(F.col(utc) >= clock.to_utc(F.lit(f"{start} 00:00:00").cast("timestamp_ntz"), zone))


def eligible(df: DataFrame) -> DataFrame:
    """Rows that a model may learn from."""
    return df.where("has_location and location_type = 'Outdoor' and not suspect_outage_zero")


def condition(column: str, op: str, value) -> Column:
    """A comparison written as data."""
    ops = {"==": "__eq__", "!=": "__ne__", ">": "__gt__", ">=": "__ge__", "<": "__lt__", "<=": "__le__"}
    if op not in ops:
        raise ValueError(f"unknown operator {op!r}")
    return getattr(F.col(column), ops[op])(F.lit(value))
