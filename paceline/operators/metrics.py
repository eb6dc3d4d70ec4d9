"""Errors of predictions: headline scores, by fold, part and slice; calibration, weights and intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..lineage import written

from .representation import long_slices


def _error(y: str, p: str) -> Column:
    return F.abs(F.col(p) - F.col(y))


def wape(y: str, p: str) -> Column:
    return F.try_divide(F.sum(_error(y, p)), F.sum(y))


def bias_share(y: str, p: str) -> Column:
    return F.try_divide(F.sum(p) - F.sum(y), F.sum(y))


def mae(y: str, p: str) -> Column:
    return F.avg(_error(y, p))


def log_mae(y: str, p: str) -> Column:
    return F.avg(F.abs(F.log1p(p) - F.log1p(y)))


def rmse(y: str, p: str) -> Column:
    return F.sqrt(F.avg((F.col(p) - F.col(y)) ** 2))


def checked(df: DataFrame, p: str) -> DataFrame:
    """The rows, with an error where a prediction isn't finite or is negative."""
    good = F.col(p).isNotNull() & ~F.isnan(p) & (F.col(p) >= 0) & (F.col(p) < float("inf"))
    return df.withColumn(p, F.when(good, F.col(p)).otherwise(F.raise_error(F.lit("predictions must be finite and non-negative")).cast("double")))


def score(df: DataFrame, by: Sequence[str], sensor: str, y: str, p: str) -> DataFrame:
    """Headline scores of each group, with those that weigh sensors alike: rank correlation of means, WAPE per sensor.

    Rows are aggregated once, by group and sensor; all scores follow from those sums.
    """
    per = checked(df, p).groupBy(*by, sensor).agg(
        F.count("*").alias("_n"), F.sum(y).alias("_y"), F.sum(p).alias("_p"), F.sum(_error(y, p)).alias("_e"), F.sum(F.abs(F.log1p(p) - F.log1p(y))).alias("_l"), F.sum((F.col(p) - F.col(y)) ** 2).alias("_q")
    )
    means = per.withColumns({"_my": F.col("_y") / F.col("_n"), "_mp": F.col("_p") / F.col("_n"), "_w": F.when(F.col("_y") > 0, F.col("_e") / F.col("_y"))})

    def rank(c: str) -> Column:
        """Average rank: that of the first of a tie plus half its others."""
        return F.rank().over(Window.partitionBy(*by).orderBy(c)) + (F.count("*").over(Window.partitionBy(*by, c)) - 1) / 2

    ranked = means.withColumns({"_ry": rank("_my"), "_rp": rank("_mp")})
    n = F.sum("_n")
    can = (F.count("*") >= 3) & (F.count_distinct("_my") > 1) & (F.count_distinct("_mp") > 1)
    return ranked.groupBy(*by).agg(
        (F.sum("_l") / n).alias("log_mae"), F.try_divide(F.sum("_e"), F.sum("_y")).alias("wape"), (F.sum("_e") / n).alias("mae"), F.sqrt(F.sum("_q") / n).alias("rmse"),
        F.try_divide(F.sum("_p") - F.sum("_y"), F.sum("_y")).alias("bias"), F.when(can, F.corr("_ry", "_rp")).alias("sensor_rank_corr"), F.percentile("_w", F.lit(0.5)).alias("sensor_wape_median"),
        F.max("_w").alias("sensor_wape_worst"), n.alias("n_rows"), F.count("*").alias("n_sensors"),
    )


CV_METRICS = ("wape", "log_mae", "mae", "rmse", "bias", "sensor_rank_corr")


def cv_metrics(df: DataFrame, fold: str, sensor: str, y: str, p: str) -> DataFrame:
    """Scores of every fold and, as fold null, their mean; holdout rows (fold below 0) are refused."""
    own = df.withColumn(fold, F.when(F.col(fold) < 0, F.raise_error(F.lit("holdout rows can't be scored with the folds")).cast("int")).otherwise(F.col(fold)))
    per = score(own, [fold], sensor, y, p).select(fold, *CV_METRICS)
    return per.unionByName(per.agg(*[F.avg(c).alias(c) for c in CV_METRICS]).withColumn(fold, F.lit(None).cast("int")))


def score_parts(df: DataFrame, parts: dict[str, Column], sensor: str, y: str, p: str) -> DataFrame:
    """Scores of overlapping parts of the rows; an empty part has 0 rows."""
    held = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in parts.items()]))
    got = score(df.select(sensor, y, p, F.explode(held).alias("part")), ["part"], sensor, y, p)
    names = df.sparkSession.createDataFrame([(n,) for n in parts], "part string")
    return names.join(got, "part", "left").fillna(0, ["n_rows", "n_sensors"])


def interval_coverage(df: DataFrame, by: Sequence[str], y: str, low: str, high: str) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(F.col(y).between(F.col(low), F.col(high)).cast("int")).alias("coverage"), F.count("*").alias("n_rows"))


def cell_sums(df: DataFrame, dims: Sequence[str], sensor: str, y: str, p: str) -> DataFrame:
    """Sums of each dimension, group and sensor: errors of any coarser group follow exactly."""
    rows = long_slices(df, dims, [sensor, y, p])
    return rows.groupBy("dimension", "group", sensor).agg(F.sum(y).alias("y"), F.sum(p).alias("p"), F.sum(_error(y, p)).alias("abs_err"), F.count("*").alias("n"))


def cell_metrics(cells: DataFrame, sensor: str) -> DataFrame:
    """Errors of each group, and the dimension's disparity: least over greatest WAPE."""
    per = cells.groupBy("dimension", "group").agg(
        F.try_divide(F.sum("abs_err"), F.sum("y")).alias("wape"), F.try_divide(F.sum("p") - F.sum("y"), F.sum("y")).alias("bias"), (F.sum("abs_err") / F.sum("n")).alias("mae"),
        F.sum("n").alias("n_rows"), F.count_distinct(sensor).alias("n_sensors"),
    )
    whole = Window.partitionBy("dimension")
    return per.withColumn("disparity_ratio", F.try_divide(F.min("wape").over(whole), F.max("wape").over(whole)))


_PRIME = (1 << 31) - 1


def random_number(rep: Column, nth: Column, below: Column, seed: int) -> Column:
    """A pseudo-random whole number from 0 up to `below`: squares modulo a prime of the repetition and the draw's number, so any engine draws the same."""
    x = (rep * 48271 + nth * 69621 + F.lit(seed * 16807 + 12345)).cast("long") % _PRIME
    for _ in range(3):
        x = (x * x + nth * 40692 + rep + 1) % _PRIME
    return x % below


def sensor_bootstrap(cells: DataFrame, sensor: str, reps: int = 300, seed: int = 7) -> DataFrame:
    """95 % interval of each group's WAPE, when as many sensors as it has are drawn from it with replacement.

    Cells are numbered within their group; each repetition counts how often a number is drawn, and meets the cells by it.
    """
    group = ["dimension", "group"]
    numbered = written(cells.select(*group, F.col("y").cast("double").alias("y"), "abs_err", (F.row_number().over(Window.partitionBy(*group).orderBy(sensor)) - 1).cast("long").alias("nth"), F.count("*").over(Window.partitionBy(*group)).alias("below")), "cells")
    each = numbered.select(*group, "nth", "below", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(reps - 1).cast("long"))).alias("rep"))
    picks = each.select(*group, "rep", random_number(F.col("rep"), F.col("nth"), F.col("below"), seed).alias("nth")).groupBy(*group, "rep", "nth").agg(F.count("*").alias("times"))
    per = picks.join(numbered, [*group, "nth"]).groupBy(*group, "rep").agg(F.try_divide(F.sum(F.col("times") * F.col("abs_err")), F.sum(F.col("times") * F.col("y"))).alias("w"))
    return per.groupBy(*group).agg(F.percentile("w", F.lit(0.025)).alias("wape_lo"), F.percentile("w", F.lit(0.975)).alias("wape_hi"))


def slice_errors(df: DataFrame, dims: Sequence[str], sensor: str, y: str, p: str, margin: float = 0.0, reps: int = 300, seed: int = 7) -> DataFrame:
    """Errors of every slice against the overall one; worse if the whole interval lies above it."""
    cells = cell_sums(df, dims, sensor, y, p)
    overall = df.agg(wape(y, p).alias("_overall"))
    out = cell_metrics(cells, sensor).join(sensor_bootstrap(cells, sensor, reps, seed), ["dimension", "group"], "left").join(F.broadcast(overall), F.lit(True))
    return out.withColumns({"wape_vs_overall": F.try_divide("wape", "_overall"), "worse": F.coalesce(F.col("wape_lo") > F.col("_overall") * (1 + margin), F.lit(False))}).drop("_overall")


def summarize_mitigation(errors: DataFrame, name: str, overall: DataFrame, top: int = 5) -> DataFrame:
    """Overall errors, the groups that are worse, and each dimension's worst group, highest first."""
    first = Window.partitionBy("dimension").orderBy(F.desc_nulls_last("wape"), "group")
    worst = errors.withColumn("_r", F.row_number().over(first)).where("_r = 1")
    line = F.struct((-F.col("wape")).alias("o"), F.format_string("%s=%s (%.2f)", "dimension", "group", "wape").alias("t"))
    tops = worst.agg(F.array_join(F.transform(F.slice(F.array_sort(F.collect_list(line)), 1, top), lambda x: x["t"]), "; ").alias("max_wape_group"))
    bad = F.when(F.col("worse"), F.concat_ws("=", "dimension", "group"))
    worse = errors.agg(F.count(bad).alias("groups_worse"), F.array_join(F.array_sort(F.collect_list(bad)), "; ").alias("worse_groups"))
    return overall.withColumn("mitigation", F.lit(name)).join(F.broadcast(worse), F.lit(True)).join(F.broadcast(tops), F.lit(True))


def calibration_window(df: DataFrame, sensor: str, ts: str, days: float = 28) -> DataFrame:
    """Add in_window: the first days of each sensor."""
    first = F.min(ts).over(Window.partitionBy(sensor))
    return df.withColumn("in_window", F.timestamp_diff("SECOND", first, F.col(ts)) < int(days * 86400))


def calibrate(df: DataFrame, sensor: str, y: str, p: str, window: str = "in_window") -> DataFrame:
    """Add calibrated: predictions scaled so that each sensor's add up to its counts in the window."""
    own = df.groupBy(sensor).agg(F.sum(F.when(F.col(window), F.col(y))).alias("_y"), F.sum(F.when(F.col(window), F.col(p))).alias("_p"))
    scale = own.select(sensor, F.when(F.col("_p") > 0, F.col("_y") / F.col("_p")).otherwise(1.0).alias("scale"))
    return df.join(scale, sensor).withColumn("calibrated", F.col(p) * F.col("scale"))


def scored_rows(df: DataFrame, window: str = "in_window") -> DataFrame:
    return df.where(~F.col(window))


def weights(df: DataFrame, kind: str, sensor: str, dimension: str | None = None, reference: DataFrame | None = None) -> DataFrame:
    """Add weight, of mean 1: every row, sensor or group alike, or groups by their share of a reference."""
    if kind == "none":
        return df.withColumn("weight", F.lit(1.0))
    if kind not in ("sensor_equal", "group_equal", "reference"):
        raise ValueError(f"unknown weight {kind!r}")
    key = sensor if kind == "sensor_equal" else dimension
    per = df.groupBy(key).agg(F.count("*").alias("_n"))
    whole = Window.partitionBy()  # a row for each key
    share = F.lit(1.0)
    if kind == "reference":
        ref = reference.withColumn("_share", F.col("weight") / F.sum("weight").over(whole)).select(F.col("group").alias(key), "_share")
        per = per.join(ref, key, "left")
        share = F.coalesce("_share", F.col("_n") / F.sum("_n").over(whole))
    per = per.withColumn("_w", share / F.col("_n"))
    per = per.withColumn("weight", F.col("_w") * F.sum("_n").over(whole) / F.sum(F.col("_w") * F.col("_n")).over(whole)).select(key, "weight")
    return df.join(per, key)


def interval_margins(df: DataFrame, by: Sequence[str], y: str, low: str, high: str, coverage: float = 0.8) -> DataFrame:
    """How far log1p bounds must move so that each tail holds its share."""
    tail = (1 - coverage) / 2
    return df.groupBy(*by).agg(
        F.percentile(F.log1p(low) - F.log1p(y), F.lit(1 - tail)).alias("margin_low"), F.percentile(F.log1p(y) - F.log1p(high), F.lit(1 - tail)).alias("margin_high")
    )


def widen(low: Column, high: Column, margin_low: Column, margin_high: Column) -> tuple[Column, Column]:
    return F.greatest(F.expm1(F.log1p(low) - margin_low), F.lit(0.0)), F.greatest(F.expm1(F.log1p(high) + margin_high), F.lit(0.0))


def cross_fold_margins(df: DataFrame, fold: str, y: str, low: str, high: str, coverage: float = 0.8) -> DataFrame:
    """Of each fold, the margins that all other folds ask for; folds are few, and each row goes to the others."""
    folds = df.select(F.col(fold).alias("for_fold")).distinct()
    return interval_margins(df.join(F.broadcast(folds), F.col(fold) != F.col("for_fold")), ["for_fold"], y, low, high, coverage)


def bounded(low: Column, predicted: Column, high: Column) -> tuple[Column, Column]:
    """Bounds that hold the prediction between them."""
    return F.least(low, predicted), F.greatest(high, predicted)


def poisson_deviance(y: str, p: str) -> Column:
    mu = F.greatest(F.col(p), F.lit(1e-6))
    return 2 * F.avg(F.when(F.col(y) > 0, F.col(y) * F.ln(F.col(y) / mu)).otherwise(0.0) - F.col(y) + mu)


def pinball(y: str, p: str, q: float) -> Column:
    d = F.col(y) - F.col(p)
    return F.avg(F.greatest(q * d, (q - 1) * d))


def calibration_curve(df: DataFrame, sensor: str, y: str, p: str, known: Sequence[int] = (1, 3, 5, 10, 20), reps: int = 20, seed: int = 7) -> DataFrame:
    """WAPE on all other sensors when one scale is fitted on k sensors, over random draws: median and quartiles."""
    per = df.groupBy(sensor).agg(F.sum(y).alias("_y"), F.sum(p).alias("_p"))
    draws = df.sparkSession.createDataFrame([(k, r) for k in known for r in range(reps)], "k int, rep int")
    order = Window.partitionBy("k", "rep").orderBy(random_number(F.col("rep").cast("long"), F.col(sensor).cast("long"), F.lit(_PRIME), seed), sensor)
    drawn = per.join(F.broadcast(draws), F.lit(True)).withColumn("_in", F.row_number().over(order) <= F.col("k"))
    scales = drawn.groupBy("k", "rep").agg(F.try_divide(F.sum(F.when(F.col("_in"), F.col("_y"))), F.sum(F.when(F.col("_in"), F.col("_p")))).alias("scale"))
    tests = drawn.where("not _in").select(sensor, "k", "rep").join(scales, ["k", "rep"])
    error = F.abs(F.col(p) * F.col("scale") - F.col(y))
    each = df.join(tests, sensor).groupBy("k", "rep").agg(F.try_divide(F.sum(error), F.sum(y)).alias("wape"))
    return each.groupBy("k").agg(*[F.percentile("wape", F.lit(q)).alias(n) for q, n in ((0.5, "median"), (0.25, "lower"), (0.75, "upper"))])


def worst_slice(errors: DataFrame, min_sensors: int = 5) -> DataFrame:
    return errors.where(F.col("n_sensors") >= min_sensors).agg(F.max("wape_vs_overall").alias("worst_ratio"))


def shortlist(candidates: DataFrame, metric: str = "log_mae", within: float = 0.03) -> DataFrame:
    """Candidates within a share of the best."""
    best = candidates.agg((F.min(metric) * (1 + within)).alias("_limit"))
    return candidates.join(F.broadcast(best), F.col(metric) <= F.col("_limit")).drop("_limit")


def choose(candidates: DataFrame, ratio: str, metric: str = "log_mae") -> DataFrame:
    """The one with the least worst-slice ratio, then the least metric."""
    return candidates.orderBy(F.asc_nulls_last(ratio), metric).limit(1)
