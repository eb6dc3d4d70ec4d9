"""Models of counts: a structural baseline, a Poisson candidate, bundles with intervals, and the gates they must pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .metrics import bounded, widen


MOST_SENSORS = 100_000


@dataclass
class Baseline:
    """Mean log count of each hour of the week, and ridge weights for what a sensor's network says of its level."""

    overall: float
    hours: dict[int, float]
    columns: Sequence[str]
    centre: np.ndarray
    scale: np.ndarray
    beta: np.ndarray
    alpha: float


def _level(columns: Sequence[str]) -> list[Column]:
    """sign(x) * log1p(|x|) of each column."""
    return [(F.signum(F.col(c).cast("double")) * F.log1p(F.abs(F.col(c).cast("double")))).alias(c) for c in columns]


def fit_baseline(rows: DataFrame, sensors: DataFrame, key: str, hour: str, y: str, columns: Sequence[str]) -> Baseline:
    """Fit on rows and a table of sensors. The ridge strength is the best of 13 by leaving one sensor out.

    What comes to the driver are 168 hours and one row a sensor, in aggregates; more than `MOST_SENSORS` are an error.
    """
    log = F.log1p(F.col(y))
    hours = {r[0]: r[1] for r in rows.groupBy(hour).agg(F.avg(log)).collect()}
    overall = rows.agg(F.avg(log)).first()[0]
    spark = rows.sparkSession
    usual = F.broadcast(spark.createDataFrame(list(hours.items()), f"{hour} int, _usual double"))
    left = rows.join(usual, hour).groupBy(key).agg(F.avg(log - F.col("_usual")).alias("_left"))
    got = left.join(sensors.select(key, *_level(columns)), key).orderBy(key).limit(MOST_SENSORS + 1).collect()
    if len(got) > MOST_SENSORS:
        raise ValueError(f"more than {MOST_SENSORS} sensors")
    target = np.array([r["_left"] for r in got])
    x = np.array([[np.nan if r[c] is None else r[c] for c in columns] for r in got], float).reshape(len(got), len(columns))
    centre = np.nan_to_num(np.nanmean(x, 0)) if len(x) else np.zeros(len(columns))
    x = np.where(np.isnan(x), centre, x)
    scale = np.where(x.std(0) > 0, x.std(0), 1.0) if len(x) else np.ones(len(columns))
    z = (x - centre) / scale
    best = (np.inf, 1.0, np.zeros(len(columns) + 1))
    for alpha in np.logspace(-3, 3, 13):
        a = np.column_stack([np.ones(len(z)), z])
        gram = a.T @ a + alpha * np.diag([0.0] + [1.0] * len(columns))
        inverse = np.linalg.pinv(gram)
        beta = inverse @ a.T @ target
        lever = np.einsum("ij,jk,ik->i", a, inverse, a)
        loo = (((target - a @ beta) / np.maximum(1 - lever, 1e-9)) ** 2).mean() if len(a) else 0.0
        if loo < best[0]:
            best = (loo, float(alpha), beta)
    return Baseline(overall, hours, columns, centre, scale, best[2], best[1])


def predict_baseline(m: Baseline, rows: DataFrame, sensors: DataFrame, key: str, hour: str) -> DataFrame:
    """Rows with predicted: usual log count of the hour plus the sensor's level, as a count."""
    level = F.lit(float(m.beta[0]))
    for c, mu, sd, b in zip(m.columns, m.centre, m.scale, m.beta[1:], strict=True):
        level = level + float(b) * (F.coalesce(F.signum(F.col(c).cast("double")) * F.log1p(F.abs(F.col(c).cast("double"))), F.lit(float(mu))) - float(mu)) / float(sd)
    levels = sensors.select(key, level.alias("_level"))
    usual = F.broadcast(rows.sparkSession.createDataFrame(list(m.hours.items()), f"{hour} int, _usual double"))
    out = rows.join(levels, key, "left").join(usual, hour, "left")
    return out.withColumn("predicted", F.greatest(F.expm1(F.coalesce("_usual", F.lit(m.overall)) + F.coalesce("_level", F.lit(0.0))), F.lit(0.0))).drop("_level", "_usual")


def assembled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with their columns as one vector; nulls are an error of the caller, who imputes them."""
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(df)


def fit_poisson(df: DataFrame, y: str, columns: Sequence[str], weight: str | None = None):
    glm = GeneralizedLinearRegression(family="poisson", link="log", labelCol=y, featuresCol="features", predictionCol="predicted", maxIter=25, regParam=1e-3)
    return (glm.setWeightCol(weight) if weight else glm).fit(assembled(df, columns))


def fit_trees(df: DataFrame, y: str, columns: Sequence[str], rounds: int = 20, seed: int = 7):
    """Boosted trees of the log count."""
    return GBTRegressor(labelCol="_log", featuresCol="features", predictionCol="_raw", maxIter=rounds, maxDepth=4, seed=seed).fit(assembled(df.withColumn("_log", F.log1p(y)), columns))


def predict(model, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"features missing: {', '.join(missing)}")
    out = model.transform(assembled(df, columns))
    if "_raw" in out.columns:
        out = out.withColumn("predicted", F.expm1("_raw")).drop("_raw")
    return out.withColumn("predicted", F.greatest("predicted", F.lit(0.0))).drop("features")


def bundle(df: DataFrame, predicted: str, low: str, high: str, margins: tuple[float, float]) -> DataFrame:
    """predicted, lower and upper, with lower <= predicted <= upper."""
    a, z = widen(F.col(low), F.col(high), F.lit(margins[0]), F.lit(margins[1]))
    a, z = bounded(a, F.col(predicted), z)
    return df.withColumns({"lower": a, "upper": z})


def imputed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows without nulls in the columns: a column's own mean stands in, 0 where it has none."""
    means = df.agg(*[F.avg(c).alias(f"_m_{c}") for c in columns])
    out = df.join(F.broadcast(means), F.lit(True))
    return out.withColumns({c: F.coalesce(F.col(c).cast("double"), F.col(f"_m_{c}"), F.lit(0.0)) for c in columns}).drop(*[f"_m_{c}" for c in columns])


def usable_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns that have a value in some row."""
    n = df.agg(*[F.count(c).alias(c) for c in columns]).first()
    return [c for c in columns if n[c]]


def permutation_importance(model, df: DataFrame, columns: Sequence[str], y: str, error, seed: int = 7) -> DataFrame:
    """How much worse predictions get when one column's values change places, by hash order within equal numbers of rows."""
    from pyspark.sql import Window

    base = predict(model, df, columns).agg(error(y, "predicted").alias("e")).first()[0]
    out = []
    for c in columns:
        numbered = df.withColumn("_a", F.row_number().over(Window.partitionBy(F.pmod(F.xxhash64(*df.columns), F.lit(64))).orderBy(F.xxhash64(*df.columns)))).withColumn("_g", F.pmod(F.xxhash64(*df.columns), F.lit(64)))
        n = Window.partitionBy("_g")
        other = numbered.select("_g", (F.col("_a") % F.count("*").over(n) + 1).alias("_a"), F.col(c).alias("_other"))
        mixed = numbered.join(other, ["_g", "_a"]).withColumn(c, F.col("_other")).drop("_a", "_g", "_other")
        out.append((c, predict(model, mixed, columns).agg(error(y, "predicted").alias("e")).first()[0] - base))
    return df.sparkSession.createDataFrame(out, "column_name string, importance double")


@dataclass(frozen=True)
class Gate:
    """What a model must reach before it may be used."""

    gain: float = 0.1
    coverage: tuple[float, float] = (0.75, 0.85)
    worst_slice: float = 2.25

    def failures(self, metric: float, baseline: float, coverage: float, worst: float) -> list[str]:
        out = []
        if not metric <= baseline * (1 - self.gain):
            out.append(f"log MAE {metric:.3f} isn't {self.gain:.0%} below the baseline's {baseline:.3f}")
        if not self.coverage[0] <= coverage <= self.coverage[1]:
            out.append(f"coverage {coverage:.3f} is outside {self.coverage}")
        if not worst <= self.worst_slice:
            out.append(f"worst slice {worst:.2f} is above {self.worst_slice}")
        return out


def beats(metric: float, champion: float | None) -> bool:
    return champion is None or metric < champion


def latest_runs(runs: DataFrame, by: Sequence[str], started: str) -> DataFrame:
    """The newest finished run of each kind."""
    rest = [c for c in runs.columns if c not in by]
    return runs.where("status = 'FINISHED'").groupBy(*by).agg(F.max_by(F.struct(*rest), started).alias("_r")).select(*by, *[F.col(f"_r.{c}").alias(c) for c in rest])


def rollback(versions: DataFrame, model: str = "model", number: str = "version") -> DataFrame:
    """The version before the champion of each model, only if every model has one."""
    champion = versions.where("is_champion").select(model, F.col(number).alias("_now"))
    before = versions.join(champion, model).where(F.col(number) < F.col("_now")).groupBy(model).agg(F.max(number).alias(number))
    every = champion.join(before, model, "left").agg(F.bool_and(F.col(number).isNotNull()).alias("_all"))
    return before.join(F.broadcast(every), F.lit(True)).where("_all").drop("_all")
