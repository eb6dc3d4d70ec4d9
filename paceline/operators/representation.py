"""How well places, times and conditions are represented."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def long_slices(df: DataFrame, dims: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """A row for each dimension: dimension, group and the kept columns; null labels are unknown."""
    each = F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.coalesce(F.col(d).cast("string"), F.lit("unknown")).alias("group")) for d in dims]))
    return df.select(*keep, each.alias("_s")).select("_s.dimension", "_s.group", *keep)


def summarize(df: DataFrame, dims: Sequence[str], sensor: str, value: str, outage: str, reference: DataFrame | None = None, by_sensor: bool = False, min_sensors: int = 5, low_ratio: float = 0.5) -> DataFrame:
    """Counts and shares of each group of every dimension, all in one aggregation.

    Everything leaves outages out, but for outage_share. `reference` has dimension, group and weight: the ratio is
    the share among the groups that have a reference over the reference's own share.
    """
    every = "_every"  # a dimension of one group: all rows
    rows = long_slices(df.withColumn(every, F.lit(every)), [*dims, every], [sensor, value, outage])
    kept = ~F.col(outage)
    # equal readings of a sensor are counted first, so that medians and distinct sensors see few rows
    cells = rows.groupBy("dimension", "group", sensor, value, outage).agg(F.count("*").alias("_n"))
    v, n = F.when(kept, F.col(value)), F.when(kept, F.col("_n")).otherwise(0)
    known = F.when(F.col(value).isNotNull(), n).otherwise(0)
    per = cells.groupBy("dimension", "group").agg(
        F.count_distinct(F.when(kept, F.col(sensor))).alias("n_sensors"), F.sum(n).alias("n_rows"), F.sum(v * n).alias("pedestrians"), F.try_divide(F.sum(v * n), F.sum(known)).alias("mean_count"),
        F.percentile(v, F.lit(0.5), known).alias("median_count"), F.percentile(v, F.lit(0.9), known).alias("p90_count"), F.try_divide(F.sum(F.when(v == 0, n).otherwise(0)), F.sum(known)).alias("zero_share"),
        (F.sum(F.when(F.col(outage), F.col("_n")).otherwise(0)) / F.sum("_n")).alias("outage_share"),
    ).where("n_rows > 0")
    whole = Window.partitionBy("dimension")  # a row for each group
    everyone = F.max(F.when(F.col("dimension") == every, F.col("n_sensors"))).over(Window.partitionBy())
    out = per.withColumn("_all", everyone).where(F.col("dimension") != every).withColumns({
        "row_share": F.col("n_rows") / F.sum("n_rows").over(whole), "sensor_share": F.col("n_sensors") / F.col("_all"),
        "pedestrian_share": F.try_divide(F.col("pedestrians"), F.sum("pedestrians").over(whole)),
    }).drop("_all")
    if reference is None:
        out = out.withColumns({"reference_share": F.lit(None).cast("double"), "ratio": F.lit(None).cast("double")})
    else:
        ref = reference.where("group <> 'unknown'").withColumn("reference_share", F.col("weight") / F.sum("weight").over(whole)).drop("weight")
        basis = F.when(F.col("reference_share").isNotNull(), F.col("n_sensors" if by_sensor else "n_rows"))
        out = out.join(ref, ["dimension", "group"], "left").withColumn("ratio", basis / F.sum(basis).over(whole) / F.col("reference_share"))
    return out.withColumn("thin", (F.col("n_sensors") < min_sensors) | F.coalesce(F.col("ratio") < low_ratio, F.lit(False)))


def crosstab(df: DataFrame, a: str, b: str, value: str) -> DataFrame:
    """Rows, median and share of all rows of each combination that occurs."""
    cells = df.groupBy(F.col(a).alias("group_a"), F.col(b).alias("group_b"), value).agg(F.count("*").alias("_n"))
    per = cells.groupBy("group_a", "group_b").agg(F.sum("_n").alias("n_rows"), F.percentile(value, F.lit(0.5), F.col("_n")).alias("median_count"))
    return per.withColumn("row_share", F.col("n_rows") / F.sum("n_rows").over(Window.partitionBy()))


def heat_map(df: DataFrame, row: str, column: str, values: Sequence, value: str) -> DataFrame:
    """Median of each row and column, wide."""
    return df.groupBy(row).pivot(column, list(values)).agg(F.percentile(value, F.lit(0.5)))


def coverage_by_year(df: DataFrame, year: str, sensor: str, value: str) -> DataFrame:
    per = df.groupBy(year).agg(F.count("*").alias("n_rows"), F.count_distinct(sensor).alias("n_sensors"), F.sum(value).alias("pedestrians"))
    return per.withColumn("row_share", F.col("n_rows") / F.sum("n_rows").over(Window.partitionBy()))


def length_reference(edges: DataFrame, group: str, length: str) -> DataFrame:
    """Network length of each group: a reference."""
    return edges.groupBy(F.col(group).alias("group")).agg(F.sum(length).alias("weight"))


def completeness(df: DataFrame, group: str, present: str, missing: str) -> DataFrame:
    """Rows over rows and missing rows."""
    return df.groupBy(group).agg((F.sum(present) / (F.sum(present) + F.sum(missing))).alias("completeness"))
