"""The training frame: rows with their sensor's segment, shade and events, joined only when they are read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_site(site: str, training_site: str) -> None:
    if site != training_site:
        raise ValueError(f"{site} has no counts: only {training_site} can train")


def with_shade(rows: DataFrame, shade: DataFrame, names: Sequence[str], segment: str = "segment_id", bin_: str = "sun_bin") -> DataFrame:
    """Add the shade of each row's segment at its sun bin: 1 if the sun is down, 0 where the table has no row.

    A variant without any value among the rows' segments is null throughout.
    """
    wanted = rows.select(segment).where(F.col(segment).isNotNull()).distinct()
    table = shade.join(wanted, segment, "left_semi")
    has = table.agg(*[F.coalesce(F.bool_or(F.col(n).isNotNull()), F.lit(False)).alias(f"_has_{n}") for n in names])
    out = rows.join(table.select(segment, bin_, *[F.col(n).alias(f"_{n}") for n in names]), [segment, bin_], "left").join(F.broadcast(has), F.lit(True))
    value = {n: F.when(F.col(bin_) < 0, 1.0).otherwise(F.coalesce(F.col(f"_{n}"), F.when(F.col(f"_has_{n}"), 0.0))) for n in names}
    return out.withColumns(value).drop(*[f"_{n}" for n in names], *[f"_has_{n}" for n in names])


def design_matrix(rows: DataFrame, segments: DataFrame, key: str, row_columns: Sequence[str], segment_columns: Sequence[str], recent: str | None = None, opened: str | None = None, cap: float = 2000.0) -> DataFrame:
    """Row features, then features of the sensor's segment, as floats; before a station opened, its distance is the cap."""
    out = rows.join(segments.select(key, *segment_columns), key, "left")
    if recent and opened:
        out = out.withColumn(recent, F.when(F.col(opened), F.col(recent)).otherwise(cap))
    return out.select(key, *[F.col(c).cast("float").alias(c) for c in (*row_columns, *segment_columns)])


def weekly_open(places: DataFrame, mask: str, keys: Sequence[str]) -> DataFrame:
    """Open and unknown places of each hour of the week; hours without either have no row."""
    known = places.where(F.col(mask).isNotNull()).select(*keys, F.posexplode(mask).alias("hour_of_week", "open")).where("open")
    hours = F.explode(F.sequence(F.lit(0), F.lit(167))).alias("hour_of_week")
    unknown = places.where(F.col(mask).isNull()).select(*keys, hours)
    both = known.select(*keys, "hour_of_week", F.lit(1).alias("o"), F.lit(0).alias("u")).unionByName(unknown.select(*keys, "hour_of_week", F.lit(0).alias("o"), F.lit(1).alias("u")))
    return both.groupBy(*keys, "hour_of_week").agg(F.sum("o").alias("n_open"), F.sum("u").alias("n_unknown"))
