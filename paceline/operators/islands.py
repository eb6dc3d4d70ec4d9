"""Runs of hours, and the anomalies they show: outages, stuck and duplicated sensors, gaps, outliers."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clock


def with_runs(df: DataFrame, key: str, ts: str, state: Column, run: str = "run") -> DataFrame:
    """Number the runs of each key: a new one begins where the state changes or an hour is missing."""
    own = Window.partitionBy(key).orderBy(ts)
    flagged = df.withColumn("_s", state)
    new = ~F.lag("_s").over(own).eqNullSafe(F.col("_s")) | (clock.hours_between(F.lag(ts).over(own), F.col(ts)) != 1) | F.lag(ts).over(own).isNull()
    begun = flagged.withColumn("_new", F.coalesce(new, F.lit(True)).cast("int"))
    return begun.withColumn(run, F.sum("_new").over(own.rowsBetween(Window.unboundedPreceding, 0))).drop("_s", "_new")


def flag_outages(df: DataFrame, key: str, ts: str, value: str, local_hour: Column, min_run: int = 3, day_hours: tuple[int, int] | None = (8, 20)) -> DataFrame:
    """Add suspect_outage_zero: zeros in a run of at least `min_run` hours that touches the day hours [a, b)."""
    runs = with_runs(df, key, ts, F.col(value) == 0)
    whole = Window.partitionBy(key, "run")
    by_day = F.lit(True) if day_hours is None else F.max(((local_hour >= day_hours[0]) & (local_hour < day_hours[1])).cast("int")).over(whole) == 1
    return runs.withColumn("suspect_outage_zero", (F.col(value) == 0) & (F.count("*").over(whole) >= min_run) & by_day).drop("run")


def stuck_runs(df: DataFrame, key: str, ts: str, value: str, min_hours: int = 6, min_value: int = 10) -> DataFrame:
    """Runs of one value that lasted: key, value, start, end, hours."""
    runs = with_runs(df.where(F.col(value) >= min_value), key, ts, F.col(value))
    out = runs.groupBy(key, value, "run").agg(F.min(ts).alias("start_ts"), F.max(ts).alias("end_ts"), F.count("*").alias("n_hours"))
    return out.where(F.col("n_hours") >= min_hours).drop("run")


def gaps(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Missing hours between rows: key, first and last missing hour, how many."""
    before = F.lag(ts).over(Window.partitionBy(key).orderBy(ts))
    missing = clock.hours_between(F.col("_b"), F.col(ts)) - 1
    return df.withColumn("_b", before).where(missing > 0).select(key, clock.add_hours(F.col("_b"), 1).alias("gap_from"), clock.add_hours(F.col(ts), -1).alias("gap_to"), missing.cast("long").alias("n_missing"))


def outliers(df: DataFrame, key: str, ts: str, value: str, factor: float = 4.0, quantile: float = 0.999) -> DataFrame:
    """Rows over `factor` times their key's quantile, where that is above 0."""
    high = df.groupBy(key).agg(F.percentile(value, F.lit(quantile)).alias("usual_high"))
    return df.join(high, key).where((F.col("usual_high") > 0) & (F.col(value) > factor * F.col("usual_high"))).select(key, ts, value, "usual_high")


def top_counts(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n_rows")).orderBy(F.desc("n_rows"), key).limit(n)


def duplicate_series(df: DataFrame, key: str, ts: str, value: str, min_hours: int = 720, min_share: float = 0.9, min_value: int = 10) -> DataFrame:
    """Pairs of keys whose series agree in at least `min_hours` hours and that share of the hours both have.

    Pairs meet on (hour, value), so what is joined are equal readings; the hours in common are counted for found pairs only.
    """
    own = df.where(F.col(value) >= min_value).select(F.col(key).alias("a"), ts, value)
    other = own.withColumnRenamed("a", "b")
    same = own.join(other, [ts, value]).where("a < b").groupBy("a", "b").agg(F.count("*").alias("n_same")).where(F.col("n_same") >= min_hours)
    left = same.select("a", "b").join(own.drop(value), "a")
    common = left.join(other.drop(value), ["b", ts]).groupBy("a", "b").agg(F.count("*").alias("n_common"))
    share = F.col("n_same") / F.greatest("n_common", F.lit(1))
    return same.join(common, ["a", "b"]).withColumn("share", share).where(F.col("share") >= min_share)


def recent_completeness(df: DataFrame, key: str, ts: str, local_hour: Column, days: int = 7, min_share: float = 0.9, daytime: tuple[int, int] = (8, 20), silent_days: int = 30) -> DataFrame:
    """Of each key seen in the last weeks: its share of the recent daytime hours that any key reported, and its state."""
    end = df.agg(F.max(ts).alias("_end"), F.timestamp_add("DAY", F.lit(-days), F.max(ts)).alias("_from"))
    marked = df.join(F.broadcast(end), F.lit(True)).withColumn("_day", (F.col(ts) > F.col("_from")) & (local_hour >= daytime[0]) & (local_hour < daytime[1]))
    expected = marked.where("_day").agg(F.count_distinct(ts).alias("n_expected"))
    since = F.timestamp_add("DAY", F.lit(-silent_days), F.col("_from"))
    per = marked.where((F.col(ts) > since) & (F.col("_day") | (F.col(ts) <= F.col("_from")))).groupBy(key).agg(
        F.count_distinct(F.when(F.col("_day"), F.col(ts))).alias("n_present"), F.max((F.col(ts) <= F.col("_from")).cast("int")).alias("_before")
    )
    share = F.col("n_present") / F.greatest("n_expected", F.lit(1))
    state = F.when((F.col("n_present") == 0) & (F.col("_before") == 1), "silent").when(share < min_share, "low").otherwise("ok")
    return per.join(F.broadcast(expected), F.lit(True)).select(key, "n_present", "n_expected", share.alias("share"), state.alias("state"))


def new_since(df: DataFrame, ts: str, previous: str | None, days: int) -> DataFrame:
    """The hour after which rows count as new: the previous run's last one, else so many days before the end."""
    last = F.lit(previous).cast("timestamp_ntz") if previous else F.timestamp_add("DAY", F.lit(-days), F.max(ts))
    return df.agg(last.alias("since"))


def missing_share(df: DataFrame, key: str, ts: str, source: str) -> DataFrame:
    """Share of hours a key missed inside the spans in which its sources had it."""
    span = df.groupBy(key, source).agg((clock.hours_between(F.min(ts), F.max(ts)) + 1).alias("_span"), F.count("*").alias("_n"))
    return span.groupBy(key).agg((1 - F.sum("_n") / F.sum("_span")).alias("missing_hours_share"))


def contiguous(df: DataFrame, ts: str) -> DataFrame:
    """Whether a spine of hours has none missing and none twice."""
    return df.agg((F.count("*") == clock.hours_between(F.min(ts), F.max(ts)) + 1).alias("is_contiguous"), (F.count("*") == F.count_distinct(ts)).alias("is_unique"))


