"""Labels for times, conditions and sensors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "unknown"
TIMES = {"night": (0, 6), "morning_peak": (6, 10), "midday": (10, 16), "evening_peak": (16, 20), "late_evening": (20, 24)}


def bins(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of [edge, next edge); the last is open above; below the first, or null, is unknown."""
    out = F.lit(UNKNOWN)
    for e, name in zip(edges, labels, strict=True):
        out = F.when(value >= e, name).otherwise(out)
    return out


def right_closed(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of (edge, next edge]; outside is null."""
    out = F.lit(None).cast("string")
    for a, z, name in zip(edges[:-1], edges[1:], labels, strict=True):
        out = F.when((value > a) & (value <= z), name).otherwise(out)
    return out


def time_of_day(hour: Column, spec: dict[str, tuple[int, int]] = TIMES) -> Column:
    out = F.lit(UNKNOWN)
    for name, (a, z) in spec.items():
        out = F.when((hour >= a) & (hour < z), name).otherwise(out)
    return out


def era(day: Column, eras: dict[str, str]) -> Column:
    """The era that began last, by name and first day; unknown before all."""
    out = F.lit(UNKNOWN)
    for name, start in sorted(eras.items(), key=lambda e: e[1]):
        out = F.when(day >= F.to_date(F.lit(start)), name).otherwise(out)
    return out


def flag_label(flag: Column, yes: str, no: str) -> Column:
    return F.when(flag, yes).when(~flag, no).otherwise(UNKNOWN)


def hour_type(during: Column, pre: Column, post: Column) -> Column:
    return F.when(during, "event_during").when(pre, "event_pre").when(post, "event_post").otherwise("ordinary")


def stadium_days(games: DataFrame, day: str, venue: str, labels: dict[str, str]) -> DataFrame:
    """Day and label of its games' stadium; `both` if several had one."""
    own = games.where(F.col(venue).isin(*labels))
    name = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    return own.groupBy(day).agg(F.when(F.count_distinct(venue) > 1, "both").otherwise(F.element_at(name, F.min(venue))).alias("stadium"))


def tiers(df: DataFrame, key: str, value: str, labels: Sequence[str] = ("low", "medium", "high")) -> DataFrame:
    """Quantile groups of keys by rank: rank r of n is in the first group k with m(r-1) <= k(n-1), ties by key."""
    m = len(labels)
    rank = F.row_number().over(Window.partitionBy().orderBy(value, key)) - 1  # a row for each sensor
    n = F.count("*").over(Window.partitionBy()) - 1
    out = F.lit(labels[-1])
    for k in range(m - 1, 0, -1):
        out = F.when(m * rank <= k * n, labels[k - 1]).otherwise(out)
    return df.where(F.col(value).isNotNull()).select(key, value, out.alias("tier"))


def row_slices(df: DataFrame, hour: str, weekend: str, day: str, eras: dict[str, str], flags: dict[str, tuple[str, str, str]], cuts: dict[str, tuple[str, Sequence[float], Sequence[str]]]) -> DataFrame:
    """Add the label columns of every dimension at once."""
    own = {"time_of_day": time_of_day(F.col(hour)), "day_type": flag_label(F.col(weekend), "weekend", "weekday"), "era": era(F.col(day), eras)}
    own |= {n: flag_label(F.col(c), y, no) for n, (c, y, no) in flags.items()}
    return df.withColumns(own | {n: bins(F.col(c), e, names) for n, (c, e, names) in cuts.items()})


def sensor_slices(df: DataFrame, key: str, ts: str, value: str, outage: str) -> DataFrame:
    """Of each sensor: mean count without outages, first year, and its volume tier."""
    per = df.groupBy(key).agg(F.avg(F.when(~F.col(outage), F.col(value))).alias("mean_count"), F.year(F.min(ts)).alias("first_year"))
    return per.join(tiers(per, key, "mean_count").drop("mean_count"), key, "left")
