"""Within-hour profiles from an archive of polled minute counts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clock
from .cleaning import latest_poll

BLOCKS = 12


@dataclass(frozen=True)
class Settings:
    """Thresholds of the profiles."""

    tolerance: float = 0.05
    min_count: int = 30
    five_minute_share: float = 0.99
    gap_rows: int = 300
    pooled_people: float = 100
    low_ratio: float = 0.5
    min_hours: int = 48


def archive_minutes(polls: DataFrame, zone: str, key: str = "location_id", minute: str = "sensing_datetime") -> DataFrame:
    """The last version of each minute, with its hour (by UTC, so a repeated local hour stays two), minute and block."""
    last = latest_poll(polls, [key, minute], "polled_at", ["direction_1", "direction_2"])
    hour = clock.trunc("HOUR", minute)
    return last.withColumns({"ts_utc": hour, "ts_local": clock.to_local(hour, zone), "minute": F.minute(minute), "block": F.floor(F.minute(minute) / 5).cast("int")})


def sensor_reporting(m: DataFrame, s: Settings = Settings(), key: str = "location_id") -> DataFrame:
    """Each sensor's rows, resolution, blocks never published (as minutes, 0-4) and whether it can be used."""
    per = m.groupBy(key).agg(F.count("*").alias("n_rows"), F.avg((F.col("minute") % 5 == 0).cast("int")).alias("_on"), F.collect_set("block").alias("_blocks"))
    gone = F.array_sort(F.array_except(F.sequence(F.lit(0), F.lit(BLOCKS - 1)), "_blocks"))
    missing = F.when(F.col("n_rows") >= s.gap_rows, gone).otherwise(F.array().cast("array<int>"))
    text = F.array_join(F.transform(missing, lambda b: F.concat(b * 5, F.lit("-"), b * 5 + 4)), ",")
    return per.select(key, "n_rows", F.when(F.col("_on") >= s.five_minute_share, "5min").otherwise("1min").alias("resolution"), text.alias("missing_blocks"), (F.size(missing) == 0).alias("usable"))


def span(m: DataFrame, hourly: DataFrame, minute: str = "sensing_datetime") -> DataFrame:
    """First full hour of the archive, and the newest hour of either table: hours from the one up to the other are whole."""
    first = F.min("ts_utc")
    whole = F.when(F.min(minute) == first, first).otherwise(clock.add_hours(first, 1))
    return m.agg(whole.alias("_first"), F.max("ts_utc").alias("_last")).crossJoin(hourly.agg(F.max("ts_utc").alias("_newest"))).select("_first", F.least("_last", "_newest").alias("_last"))


def hour_status(m: DataFrame, hourly: DataFrame, sensors: DataFrame | None = None, s: Settings = Settings(), key: str = "location_id", value: str = "pedestriancount") -> DataFrame:
    """What became of each hour of the hourly table inside the archive's span."""
    own = hourly.select(key, "ts_utc", F.col(value).alias("count")).join(F.broadcast(span(m, hourly)), (F.col("ts_utc") >= F.col("_first")) & (F.col("ts_utc") < F.col("_last")))
    sums = m.groupBy(key, "ts_utc").agg(F.sum("total_of_directions").alias("_sum"))
    out = own.join(sums, [key, "ts_utc"], "left").withColumn("minute_sum", F.when((F.col("count") == 0) & F.col("_sum").isNull(), 0).otherwise(F.col("_sum")))
    out = out.withColumn("usable", F.lit(True)) if sensors is None else out.join(sensors.select(key, "usable"), key, "left")
    out = out.withColumn("usable_sensor", F.coalesce("usable", F.lit(True)))
    held = F.col("minute_sum").isNotNull()
    fits = held & (F.abs(F.col("minute_sum") - F.col("count")) <= F.greatest(s.tolerance * F.col("count"), F.lit(2.0)))
    out = out.withColumns({"in_archive": held, "adds_up": fits})
    return out.withColumn("kept", F.col("adds_up") & F.col("usable_sensor") & (F.col("count") >= s.min_count)).select(key, "ts_utc", "count", "minute_sum", "in_archive", "adds_up", "usable_sensor", "kept")


def minute_grid(m: DataFrame, hours: DataFrame, key: str = "location_id") -> DataFrame:
    """The hours with twelve columns b0..b11 of their five-minute sums, 0 where nothing was counted."""
    wide = m.groupBy(key, "ts_utc").agg(*[F.sum(F.when(F.col("block") == b, F.col("total_of_directions")).otherwise(0)).alias(f"b{b}") for b in range(BLOCKS)])
    return hours.join(wide, [key, "ts_utc"], "left").fillna(0, [f"b{b}" for b in range(BLOCKS)])


def _total() -> Column:
    return sum((F.col(f"b{b}") for b in range(1, BLOCKS)), F.col("b0"))


def hour_summary(grid: DataFrame, zone: str) -> DataFrame:
    """Peak quarter over the hour's mean quarter, share of the top block, local hour and day type."""
    quarters = [F.col(f"b{3 * q}") + F.col(f"b{3 * q + 1}") + F.col(f"b{3 * q + 2}") for q in range(4)]
    floor = F.greatest(_total(), F.lit(1))
    local = clock.to_local(F.col("ts_utc"), zone)
    return grid.withColumns({
        "peak15": 4 * F.greatest(*quarters) / floor, "top_block_share": F.greatest(*[f"b{b}" for b in range(BLOCKS)]) / floor,
        "hour_local": F.hour(local), "day_type": F.when(F.weekday(local) >= 5, "weekend").otherwise("weekday"),
    })


def _long(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    each = F.explode(F.array(*[F.struct(F.lit(5 * b).alias("block_start"), F.col(f"b{b}").alias("n")) for b in range(BLOCKS)]))
    return df.select(*keep, each.alias("_b")).select(*keep, "_b.block_start", "_b.n")


def profiles(summary: DataFrame, group: Sequence[str]) -> DataFrame:
    """Mean share of the hour in each block over a group's hours."""
    shares = summary.select(*group, *[(F.col(f"b{b}") / F.greatest(_total(), F.lit(1))).alias(f"b{b}") for b in range(BLOCKS)])
    return _long(shares, group).groupBy(*group, "block_start").agg(F.avg("n").alias("share"), F.count("*").alias("n_hours"))


def pooled_profiles(summary: DataFrame, pool: Sequence[str], min_people: float = 100, key: str = "location_id") -> DataFrame:
    """Share of a pool's people in each block; null where nobody was counted. Hours without a pool are left out."""
    sums = summary.dropna(subset=list(pool)).groupBy(*pool).agg(*[F.sum(f"b{b}").alias(f"b{b}") for b in range(BLOCKS)], F.count("*").alias("n_hours"), F.count_distinct(key).alias("n_sensors"))
    sums = sums.withColumn("people", _total())
    out = _long(sums, [*pool, "people", "n_hours", "n_sensors"])
    return out.select(*pool, "block_start", (F.col("n") / F.when(F.col("people") > 0, F.col("people"))).alias("share"), "people", "n_hours", "n_sensors", (F.col("people") >= min_people).alias("usable"))


def coverage(status: DataFrame, dims: Sequence[str], s: Settings = Settings(), key: str = "location_id") -> DataFrame:
    """How much of each group of every dimension the archive and the profiles cover."""
    from .representation import long_slices

    per = long_slices(status, dims, [key, "in_archive", "adds_up", "kept"]).groupBy("dimension", "group").agg(
        F.count("*").alias("sensor_hours"), F.count_distinct(key).alias("sensors"), *[F.avg(F.col(c).cast("int")).alias(f"{c}_share") for c in ("in_archive", "adds_up", "kept")], F.sum(F.col("kept").cast("int")).alias("_kept")
    )
    whole = Window.partitionBy("dimension")  # every row is in one group of each dimension, so a dimension's sums are all rows'
    overall = F.sum("_kept").over(whole) / F.sum("sensor_hours").over(whole)
    out = per.withColumn("_overall", overall).withColumn("kept_ratio", F.when(F.col("_overall") > 0, F.col("kept_share") / F.col("_overall")))
    return out.withColumn("under", F.coalesce((F.col("sensor_hours") >= s.min_hours) & (F.col("kept_ratio") < s.low_ratio), F.lit(False))).drop("_overall", "_kept")


def reconcile(m: DataFrame, hourly: DataFrame, tolerance: float = 0.05, key: str = "location_id", value: str = "pedestriancount") -> DataFrame:
    """Hours both tables have, how many, and the share of them that differ."""
    sums = m.groupBy(key, "ts_utc").agg(F.sum("total_of_directions").alias("_m"))
    whole = sums.join(F.broadcast(span(m, hourly)), (F.col("ts_utc") >= F.col("_first")) & (F.col("ts_utc") < F.col("_last")))
    both = whole.join(hourly.select(key, "ts_utc", F.col(value).alias("_h")), [key, "ts_utc"])
    off = F.abs(F.col("_m") - F.col("_h")) > F.greatest(tolerance * F.col("_h"), F.lit(2.0))
    return both.agg(F.count("*").alias("n_compared"), F.coalesce(F.avg(off.cast("int")), F.lit(0.0)).alias("mismatch_share"))


def late_days(m: DataFrame, today: Column, zone: str, cutoff: str = "23:00", minute: str = "sensing_datetime") -> DataFrame:
    """Finished local days whose last row came before the cutoff."""
    local = clock.to_local(F.col(minute), zone)
    last = m.groupBy(F.to_date(local).alias("day")).agg(F.date_format(F.max(local), "HH:mm").alias("last_local"))
    return last.where((F.col("day") < today) & (F.col("last_local") < cutoff))


def gappy_sensors(reporting: DataFrame, key: str = "location_id") -> DataFrame:
    return reporting.where("not usable").select(key, "missing_blocks")
