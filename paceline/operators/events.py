"""Timed events at venues, what they mean for hours nearby, and the egress after them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clock

#: Hours an event lasts if nothing else is known, by kind (fixed values).
DEFAULT_HOURS = {"afl": 3, "cricket": 7, "football": 2, "basketball": 2.5, "netball": 2, "concert": 3, "graduation": 3, "halloween": 3}
PHASES = ("pre", "during", "post")


def timed_events(log: DataFrame, start: str, end: str, kind: str, default_hours: dict[str, float] = DEFAULT_HOURS, duration: str | None = None, note: str | None = None) -> DataFrame:
    """Events at a venue with a start: the end as given, else after the duration, else after the kind's usual hours."""
    own = log.where("venue is not null")
    if note:
        own = own.where(~F.coalesce(F.col(note).contains("date only"), F.lit(False)))
    usual = F.element_at(F.create_map(*[F.lit(x) for k, v in default_hours.items() for x in (k, float(v))]), F.col(kind))
    hours = F.coalesce(F.col(duration), usual) if duration else usual
    return own.withColumn(end, F.coalesce(F.col(end), F.timestamp_add("SECOND", F.round(hours * 3600).cast("int"), F.col(start))))


def venue_days(log: DataFrame, start: str) -> DataFrame:
    return log.where("venue is not null").select(F.to_date(start).alias("day"), "venue").distinct()


def venue_hours(timed: DataFrame, start: str, end: str, pre: int = 2, post: int = 2) -> DataFrame:
    """Every (local hour, venue, phase) in which a venue has an event: hours that overlap the phase's half-open span."""
    spans = F.explode(F.array(
        F.struct(F.lit("pre").alias("phase"), clock.add_hours(F.col(start), -pre).alias("a"), F.col(start).alias("z")),
        F.struct(F.lit("during").alias("phase"), F.col(start).alias("a"), F.col(end).alias("z")),
        F.struct(F.lit("post").alias("phase"), F.col(end).alias("a"), clock.add_hours(F.col(end), post).alias("z")),
    )).alias("s")
    own = timed.select("venue", spans).where("s.z > s.a")
    hours = F.sequence(clock.trunc("HOUR", F.col("s.a")), clock.trunc("HOUR", F.timestamp_add("SECOND", F.lit(-1), F.col("s.z"))), F.expr("interval 1 hour"))
    return own.select(F.explode(hours).alias("hour"), "venue", F.col("s.phase").alias("phase")).distinct()


def event_features(rows: DataFrame, key: Sequence[str], hour: str, segment: str, hours: DataFrame, days: DataFrame, dist: DataFrame, cap: float = 3000.0) -> DataFrame:
    """Add event_pre, event_during, event_post, event_dist_m and event_day_dist_m to rows of an hour and a segment.

    Venues, their hours and their days are aggregated per hour (day) and segment, so rows meet one row of each.
    """
    near = hours.groupBy("hour", "venue").agg(*[F.max((F.col("phase") == p).cast("int")).alias(p) for p in PHASES])
    by_hour = near.join(dist, "venue").groupBy("hour", "segment_id").agg(
        *[F.max(F.when(F.col("dist_m") < cap, F.col(p)).otherwise(0)).alias(f"event_{p}") for p in PHASES], F.least(F.min("dist_m"), F.lit(cap)).alias("event_dist_m")
    )
    by_day = days.join(dist, "venue").groupBy("day", "segment_id").agg(F.least(F.min("dist_m"), F.lit(cap)).alias("event_day_dist_m"))
    own = rows.join(by_hour.withColumnsRenamed({"hour": hour, "segment_id": segment}), [hour, segment], "left")
    own = own.withColumn("day", F.to_date(hour)).join(by_day.withColumnRenamed("segment_id", segment), ["day", segment], "left")
    return own.select(
        *key, hour, segment, *[F.coalesce(F.col(f"event_{p}") == 1, F.lit(False)).alias(f"event_{p}") for p in PHASES],
        *[F.coalesce(F.col(c), F.lit(cap)).alias(c) for c in ("event_dist_m", "event_day_dist_m")],
    )


def no_events(rows: DataFrame, cap: float = 3000.0) -> DataFrame:
    """The event columns of a site without events."""
    return rows.withColumns({**{f"event_{p}": F.lit(False) for p in PHASES}, "event_dist_m": F.lit(cap), "event_day_dist_m": F.lit(cap)})


def event_calendar(timed: DataFrame, start: str, kind: str) -> DataFrame:
    """Of each day: its kinds and venues, sorted and joined by commas."""
    return timed.groupBy(F.to_date(start).alias("date_local")).agg(*[F.array_join(F.array_sort(F.collect_set(c)), ",").alias(n) for c, n in ((kind, "kinds"), ("venue", "venues"))])


def concurrent(events: DataFrame, day: str) -> DataFrame:
    """Events with the number of others on their day."""
    return events.join(events.groupBy(day).agg((F.count("*") - 1).alias("n_others")), day)


def blocks(counts: DataFrame, key: str, ts: str, values: Sequence[str], minutes: int = 5) -> DataFrame:
    """Counts summed into blocks of so many minutes."""
    return counts.groupBy(key, clock.floor_minutes(F.col(ts), minutes).alias("block")).agg(*[F.sum(v).alias(v) for v in values])


def egress_series(series: DataFrame, events: DataFrame, start: str, block: str = "block", from_minutes: int = 150, to_minutes: int = 300) -> DataFrame:
    """Blocks in each event's window [start + from, start + to), with minutes since its start.

    Both sides meet on hours that windows touch, so the join is an equi-join and not all pairs.
    """
    a, z = F.timestamp_add("MINUTE", F.lit(from_minutes), F.col(start)), F.timestamp_add("MINUTE", F.lit(to_minutes), F.col(start))
    own = events.withColumns({"_a": a, "_z": z})
    own = own.withColumn("_hour", F.explode(F.sequence(clock.trunc("HOUR", F.col("_a")), clock.trunc("HOUR", F.timestamp_add("SECOND", F.lit(-1), F.col("_z"))), F.expr("interval 1 hour"))))
    met = series.withColumn("_hour", clock.trunc("HOUR", F.col(block))).join(own, "_hour").where((F.col(block) >= F.col("_a")) & (F.col(block) < F.col("_z")))
    return met.withColumn("minutes_after_start", F.timestamp_diff("MINUTE", F.col(start), F.col(block))).drop("_hour", "_a", "_z")


def egress_summary(series: DataFrame, night: str, event: str, sensor: str, total: str, lead: Column, block: str = "block") -> DataFrame:
    """Of each night, event and sensor: blocks, total, first highest block, and its delay after the lead sensor's."""
    first = F.struct(F.col(total).alias("n"), (-F.unix_micros(F.col(block).cast("timestamp"))).alias("t"))
    per = series.groupBy(night, event, sensor).agg(F.count("*").alias("n_blocks"), F.sum(total).alias("total"), F.max_by(block, first).alias("peak_block"), F.max(total).alias("peak_count"))
    leads = per.where(lead).groupBy(night).agg(F.max("peak_block").alias("_lead"))
    return per.join(leads, night, "left").withColumn("peak_delay_min", F.timestamp_diff("MINUTE", F.col("_lead"), F.col("peak_block"))).drop("_lead")


def background(hourly: DataFrame, key: str, local: str, value: str, night: str, hours: Sequence[int], weeks: int, event_days: Sequence[str] = (), quantile: float = 0.5) -> DataFrame:
    """The usual count of each sensor and hour: the quantile over the same clock hour of the weeks before, less event days."""
    day = F.to_date(F.lit(night))
    wanted = hourly.where(F.to_date(local).isin(*[F.date_sub(day, 7 * k) for k in range(1, weeks + 1)]) & F.hour(local).isin(*hours))
    if event_days:
        wanted = wanted.where(~F.to_date(local).isin(*[F.to_date(F.lit(d)) for d in event_days]))
    return wanted.groupBy(key, F.hour(local).alias("hour")).agg(F.percentile(value, F.lit(quantile)).alias("usual"))


def compare_series(simulated: DataFrame, observed: DataFrame, key: str, block: str, total: str) -> DataFrame:
    """Of each sensor: totals, first peaks and correlation of two series, absent blocks being 0."""
    s, o = (df.select(key, block, F.col(total).cast("double").alias(n)) for df, n in ((simulated, "sim"), (observed, "obs")))
    both = o.join(s, [key, block], "full").fillna(0.0, ["obs", "sim"])

    def peak(n: str) -> Column:
        return F.when(F.sum(n) > 0, F.max_by(block, F.struct(n, -F.unix_micros(F.col(block).cast("timestamp")))))

    corr = F.when((F.stddev_samp("obs") > 0) & (F.stddev_samp("sim") > 0), F.round(F.corr("obs", "sim"), 3))
    return both.groupBy(key).agg(
        F.sum("obs").cast("long").alias("observed_total"), F.sum("sim").cast("long").alias("simulated_total"), peak("obs").alias("obs_peak_block"), peak("sim").alias("sim_peak_block"), corr.alias("correlation")
    )


def window_counts(tracks: DataFrame, frames: int, lost: Column, track: str = "track_id", frame: str = "frame") -> DataFrame:
    """Of each window of frames: distinct tracks in view, and tracks first seen in it."""
    seen = tracks.where(~lost).select("video", track, F.floor(F.col(frame) / frames).alias("window"))
    view = seen.groupBy("video", "window").agg(F.count_distinct(track).alias("n_in_view"))
    new = seen.groupBy("video", track).agg(F.min("window").alias("window")).groupBy("video", "window").agg(F.count("*").alias("n_first_seen"))
    return view.join(new, ["video", "window"], "full").fillna(0, ["n_in_view", "n_first_seen"])
