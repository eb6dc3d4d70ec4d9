"""What opened at a property from one year to the next, and where sensors could tell."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def property_jumps(df: DataFrame, key: str, year: str, value: str | None, least: float) -> DataFrame:
    """Years in which a property gained at least so much over the year before; a year without rows is 0.

    The years are those any property has.
    """
    what = F.count("*") if value is None else F.sum(value)
    per = df.groupBy(key, year).agg(what.cast("double").alias("_v"))
    years = df.agg(F.collect_set(year).alias("_years"))  # one row, of as many years as there are
    grid = df.select(key).distinct().join(F.broadcast(years), F.lit(True)).select(key, F.explode("_years").alias(year))
    dense = grid.join(per, [key, year], "left").fillna(0.0, ["_v"])
    gain = F.col("_v") - F.lag("_v").over(Window.partitionBy(key).orderBy(year))
    return dense.withColumn("gain", gain).where(F.col("gain") >= least).select(key, year, "gain")


def year_completeness(df: DataFrame, key: str, year: str, hours: int = 8760) -> DataFrame:
    return df.groupBy(key, year).agg(F.least(F.count("*") / hours, F.lit(1.0)).alias("completeness"))


def joined_gains(seats: DataFrame, shops: DataFrame, key: str, year: str) -> DataFrame:
    """Gains of two kinds side by side, 0 where one has none."""
    a, b = seats.withColumnRenamed("gain", "gain_a"), shops.withColumnRenamed("gain", "gain_b")
    return a.join(b, [key, year], "full").fillna(0.0, ["gain_a", "gain_b"])


def tenants(df: DataFrame, key: str, name: str, order: str, n: int = 4) -> DataFrame:
    """The first distinct tenants of each property, joined, and its first address."""
    firsts = df.groupBy(key, name).agg(F.min(order).alias("_o"))
    rank = F.row_number().over(Window.partitionBy(key).orderBy("_o", name))
    top = firsts.withColumn("_r", rank).where(F.col("_r") <= n)
    return top.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", name))), lambda s: s[name]), "; ").alias("tenants"))


def neighbourhood_gain(counts: DataFrame, rings: DataFrame, key: str, year: str) -> DataFrame:
    """Change of what lies around a property (key, other) from the year before."""
    now = rings.join(counts.withColumnRenamed(key, "other"), "other").groupBy(key, year).agg(F.sum("n").alias("n"))
    return now.withColumn("neighbourhood_gain", F.col("n") - F.coalesce(F.lag("n").over(Window.partitionBy(key).orderBy(year)), F.lit(0))).drop("n")
