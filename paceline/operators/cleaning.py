"""Reconciling overlapping sources of counts, and dropping what can't be placed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clock


def fill_gap(middle: DataFrame, before: DataFrame, after: DataFrame, ts: str) -> DataFrame:
    """Rows of `middle` strictly between the last of `before` and the first of `after`."""
    edge = before.agg(F.max(ts).alias("_a")).crossJoin(after.agg(F.min(ts).alias("_z")))  # one row
    return middle.join(F.broadcast(edge), (F.col(ts) > F.col("_a")) & (F.col(ts) < F.col("_z"))).drop("_a", "_z")


def drop_ambiguous(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop every row of a key that more than one row has."""
    return df.withColumn("_n", F.count("*").over(Window.partitionBy(*keys))).where("_n = 1").drop("_n")


def drop_listed(df: DataFrame, rules: DataFrame, key: str, day: Column) -> DataFrame:
    """Drop rows that a rule (key, from_day, to_day; both included) lists. Rules are a short hand-kept list."""
    listed = rules.select(F.col(key).alias("_k"), F.col("from_day").alias("_a"), F.col("to_day").alias("_z"))
    own = df.withColumn("_d", day)
    return own.join(listed, (own[key] == F.col("_k")) & F.col("_d").between(F.col("_a"), F.col("_z")), "left_anti").drop("_d")


def rehour_midnight(df: DataFrame, key: str, ts: str, row_id: str, hours: int = 24) -> DataFrame:
    """Spread groups of exactly `hours` rows stamped with one midnight over that day, in order of their id; others stay."""
    group = Window.partitionBy(key, ts)
    midnight = F.col(ts) == clock.trunc("DAY", F.col(ts))
    whole = midnight & (F.count("*").over(group) == hours)
    place = F.row_number().over(group.orderBy(row_id)) - 1
    return df.withColumn("_whole", whole).withColumn("_place", place).withColumn(ts, F.when(F.col("_whole"), clock.add_hours(F.col(ts), F.col("_place"))).otherwise(F.col(ts))).drop("_whole", "_place")


def localize(df: DataFrame, local: str, zone: str, utc: str = "ts_utc") -> DataFrame:
    """Add UTC; rows at a local hour that the clock skips go, and of a repeated hour the first is meant."""
    return df.withColumn(utc, clock.to_utc(F.col(local), zone)).where(F.col(utc).isNotNull())


def skipped_hours(df: DataFrame, local: str, zone: str) -> DataFrame:
    """The rows that `localize` drops."""
    return df.where(clock.to_utc(F.col(local), zone).isNull() & F.col(local).isNotNull())


def upsert(held: DataFrame, fresh: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Held rows with those of a fresh pull over them: on equal keys the fresh one wins, and no old row is lost."""
    both = held.withColumn("_p", F.lit(0)).unionByName(fresh.withColumn("_p", F.lit(1)), allowMissingColumns=True)
    last = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("_p")))
    return both.withColumn("_r", last).where("_r = 1").drop("_p", "_r")


def prefer(sources: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """The union of sources; on equal keys the first source that has it wins."""
    tagged = [s.withColumn("_p", F.lit(i)) for i, s in enumerate(sources)]
    both = tagged[0]
    for t in tagged[1:]:
        both = both.unionByName(t, allowMissingColumns=True)
    return both.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy("_p"))).where("_r = 1").drop("_p", "_r")


def recent(df: DataFrame, held: DataFrame, day: str, overlap_days: int) -> DataFrame:
    """Rows from so many days before the newest held one on: what a rolling pull has to fetch."""
    since = held.agg(F.date_sub(F.max(day), overlap_days).alias("_since"))
    return df.join(F.broadcast(since), F.col(day) >= F.col("_since")).drop("_since")


def years_to_fetch(spark, first: int, current: int, held: Sequence[int], again: int = 1) -> DataFrame:
    """Years not held, and the last `again` ones."""
    years = spark.range(first, current + 1).select(F.col("id").cast("int").alias("year"))
    return years.where(~F.col("year").isin(*held) | (F.col("year") > current - again)) if held else years


def latest_poll(df: DataFrame, keys: Sequence[str], polled: str, ties: Sequence[str] = ()) -> DataFrame:
    """The last published version of each key."""
    order = [F.desc(polled), *(F.desc(t) for t in ties)]
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_r = 1").drop("_r")


def merge_polls(held: DataFrame, poll: DataFrame, polled: str = "polled_at") -> DataFrame:
    """Rows equal in all published columns are one, first seen at the earlier poll; differing ones are all kept."""
    names = [c for c in held.columns if c != polled]
    return held.unionByName(poll).groupBy(*names).agg(F.min(polled).alias(polled))


def with_retired(current: DataFrame, snapshot: DataFrame, key: str, kind: str) -> DataFrame:
    """Current sensors, and those only an older snapshot has, with where each row is from."""
    gone = snapshot.join(current, key, "left_anti").withColumn("provenance", F.lit("retired")).withColumn("location_type", F.lit(kind))
    return current.withColumn("provenance", F.lit("current")).unionByName(gone, allowMissingColumns=True)


def clean_counts(df: DataFrame, located: DataFrame, key: str, value: str) -> DataFrame:
    """Rows with a non-negative value at a located sensor."""
    return df.where(F.col(value) >= 0).join(located, key, "left_semi")


def missing_days(df: DataFrame, day: str, today: Column) -> DataFrame:
    """Days without a row between the first one and yesterday."""
    spine = df.agg(F.min(day).alias("_a")).where("_a is not null").select(F.explode(F.sequence(F.col("_a"), F.date_sub(today, 1))).alias(day))
    return spine.join(df.select(day).distinct(), day, "left_anti")


def duplicates_and_revisions(df: DataFrame, keys: Sequence[str], polled: str) -> DataFrame:
    """Extra rows of a key in one poll, and, these aside, extra versions of a key."""
    per = df.groupBy(*keys, polled).agg(F.count("*").alias("n"))
    by_key = per.groupBy(*keys).agg(F.sum(F.col("n") - 1).alias("d"), F.count("*").alias("v"))
    return by_key.agg(F.sum("d").cast("long").alias("n_duplicates"), F.sum(F.col("v") - 1).cast("long").alias("n_revised"))


def set_changes(old: DataFrame, new: DataFrame, key: str, shape: str, tags: Sequence[str]) -> DataFrame:
    """What became of each key: added, removed, rerouted (another shape, which comes first) or retagged. Null equals null."""
    o, n = old.alias("o"), new.alias("n")

    def differs(c: str) -> Column:
        return ~F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}"))

    retagged = F.lit(False)
    for t in tags:
        retagged = retagged | differs(t)
    change = (
        F.when(F.col(f"o.{key}").isNull(), "added").when(F.col(f"n.{key}").isNull(), "removed")
        .when(differs(shape), "rerouted").when(retagged, "retagged")
    )
    both = o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full")
    return both.select(F.coalesce(f"o.{key}", f"n.{key}").alias(key), change.alias("change")).where("change is not null")
