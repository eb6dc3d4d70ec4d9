"""How a model does where it was never trained: by holdout and period, and after a few sensors are known."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .metrics import log_mae, wape


def combinations(sensors: dict[str, Sequence[int]], known: Sequence[int] = (0, 1, 2)) -> list[tuple[str, int, int, int]]:
    """(holdout, k, draw, sensor) of every way to know k of a holdout's sensors; sensors not listed are unknown.

    k = 0 is one draw without sensors, which has no row of its own.
    """
    return [(h, k, d, s) for h, ids in sorted(sensors.items()) for k in known for d, draw in enumerate(itertools.combinations(sorted(ids), k)) for s in draw]


def holdout_scores(df: DataFrame, sensors: dict[str, Sequence[int]], sensor: str, y: str, p: str, periods: dict[str, Column], known: Sequence[int] = (0, 1, 2)) -> DataFrame:
    """Of each holdout, period and number of known sensors: errors on the others, scaled by the known ones, averaged over all ways.

    Sums per sensor and period come first; ways to draw are few, and meet sums, not rows.
    """
    spark = df.sparkSession
    of = spark.createDataFrame([(h, s) for h, ids in sensors.items() for s in ids], f"holdout string, {sensor} int")
    held = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in periods.items()]))
    rows = df.join(of, sensor).select("holdout", sensor, y, p, F.explode(held).alias("period"))
    sums = df.join(of, sensor).groupBy("holdout", sensor).agg(F.sum(y).alias("_y"), F.sum(p).alias("_p"))
    draws = [(h, k, d) for h, ids in sensors.items() for k in known for d, _ in enumerate(itertools.combinations(sorted(ids), k))]
    every = spark.createDataFrame(draws, "holdout string, k int, draw int")
    picked = spark.createDataFrame(combinations(sensors, known), f"holdout string, k int, draw int, {sensor} int")
    scale = every.join(picked.join(sums, ["holdout", sensor]), ["holdout", "k", "draw"], "left").groupBy("holdout", "k", "draw").agg(F.coalesce(F.try_divide(F.sum("_y"), F.sum("_p")), F.lit(1.0)).alias("scale"))
    chosen = picked.withColumn("_in", F.lit(True))
    met = rows.join(scale, "holdout").join(chosen, ["holdout", "k", "draw", sensor], "left").where("_in is null").withColumn("_s", F.col(p) * F.col("scale"))
    each = met.groupBy("holdout", "period", "k", "draw").agg(log_mae(y, "_s").alias("log_mae"), wape(y, "_s").alias("wape"))
    return each.groupBy("holdout", "period", "k").agg(F.avg("log_mae").alias("log_mae"), F.avg("wape").alias("wape"), F.count("*").alias("n_draws"))


def compare_periods(df: DataFrame, ts: str, y: str, model: str, baseline: str, starts: dict[str, str | None]) -> DataFrame:
    """Errors of a model and a baseline in windows that begin at given days (null: all), and the gain."""
    inside = F.array_compact(F.array(*[F.when(F.lit(True) if s is None else F.col(ts) >= F.lit(s).cast("timestamp_ntz"), F.lit(n)) for n, s in starts.items()]))
    out = df.select(y, model, baseline, F.explode(inside).alias("period")).groupBy("period").agg(log_mae(y, model).alias("log_mae"), log_mae(y, baseline).alias("baseline_log_mae"), F.count("*").alias("n_rows"))
    return out.withColumn("gain", 1 - F.col("log_mae") / F.col("baseline_log_mae"))


def data_facts(df: DataFrame, sensor: str, local: str, held: Column) -> DataFrame:
    """First and last local day, and how many sensors train and are hidden."""
    return df.agg(F.to_date(F.min(local)).alias("first_day"), F.to_date(F.max(local)).alias("last_day"), F.count_distinct(F.when(~held, F.col(sensor))).alias("n_trained"), F.count_distinct(F.when(held, F.col(sensor))).alias("n_hidden"))


def cost_curve(df: DataFrame, part: str, y: str, stages: dict[int, str], loss) -> DataFrame:
    """A loss of each part of the rows after each number of trees, whose predictions are columns."""
    wide = df.groupBy(part).agg(*[loss(y, c).alias(f"_{n}") for n, c in stages.items()])
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("trees"), F.col(f"_{n}").alias("cost")) for n in stages])).alias("_s")
    return wide.select(part, each).select(part, "_s.*")


def grid(**options: Sequence) -> list[dict]:
    """Every combination of some settings."""
    return [dict(zip(options, values, strict=True)) for values in itertools.product(*options.values())]


def best_setting(scores: DataFrame, setting: str, metric: str) -> DataFrame:
    """The setting with the least mean over folds, ties by its name."""
    return scores.groupBy(setting).agg(F.avg(metric).alias(metric)).orderBy(metric, setting).limit(1)
