"""Splits of sensors that keep near ones together, and the rows a fold may train and test on."""

from __future__ import annotations

import heapq
import math
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _near_pairs(xy: np.ndarray, radius: float) -> Iterator[tuple[float, int, int]]:
    """(distance, i, j) with i < j of all points at most `radius` apart; a point that is nowhere (NaN) is near none."""
    size = radius or 1.0
    cells: dict[tuple[int, int], list[int]] = defaultdict(list)
    for k in np.flatnonzero(np.isfinite(xy).all(1)).tolist():
        cells[math.floor(xy[k, 0] / size), math.floor(xy[k, 1] / size)].append(k)
    for (cx, cy), own in cells.items():
        a = np.array(own)
        for dx, dy in ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1)):
            b = np.array(cells.get((cx + dx, cy + dy), []), int)
            for i in a.tolist() if len(b) else ():
                d = np.sqrt(((xy[i] - xy[b]) ** 2).sum(-1))
                met = (d <= radius) & (b > i if (dx, dy) == (0, 0) else True)
                yield from ((w, min(i, j), max(i, j)) for w, j in zip(d[met].tolist(), b[met].tolist(), strict=True))


def complete_linkage(xy: np.ndarray, radius: float) -> np.ndarray:
    """Groups whose members are all within `radius` of each other: the closest two groups merge while that holds.

    Only pairs within the radius are held, as no others can merge: a group keeps its greatest distance to those it is near to as a whole.
    """
    n = len(xy)
    parent, near = list(range(n)), [{} for _ in range(n)]
    heap = list(_near_pairs(xy, radius))
    for d, i, j in heap:
        near[i][j] = near[j][i] = d
    heapq.heapify(heap)
    while heap:
        d, i, j = heapq.heappop(heap)
        if near[i].get(j) != d:  # one of them has merged, or is farther by now
            continue
        a, b = near[i], near[j]
        del a[j], b[i]
        near[i], near[j], parent[j] = {}, {}, i
        for k in a.keys() | b.keys():
            both = k in a and k in b
            near[k].pop(i, None)
            near[k].pop(j, None)
            if both:
                far = max(a[k], b[k])
                near[i][k] = near[k][i] = far
                if far != a[k]:
                    heapq.heappush(heap, (far, min(i, k), max(i, k)))
    for k in range(n):  # a group is named by its first member, so names are settled in order
        parent[k] = parent[parent[k]]
    return np.unique(np.array(parent, int), return_inverse=True)[1]


def splits(sensors: DataFrame, holdouts: dict[str, Sequence[int]], folds: int = 5, seed: int = 7, radius: float = 200.0) -> DataFrame:
    """id, group, fold and holdout of each sensor (id, x, y).

    Held-out sensors, and all of a group one is in (`neighbour`), have fold -1. Other groups go to the fold with the
    fewest sensors, larger groups first, in an order that the seed shuffles. Sensors at one spot are a group from the
    start, so the driver holds spots, not sensors; one whose place is unknown is a spot of its own.
    """
    name = {i: n for n, ids in holdouts.items() for i in ids}
    x, y = F.col("x").cast("double") + 0.0, F.col("y").cast("double") + 0.0
    known = x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y)
    own = sensors.select("id", F.when(known, x).otherwise(0.0).alias("_x"), F.when(known, y).otherwise(0.0).alias("_y"), F.when(known, F.lit(None).cast("long")).otherwise(F.col("id")).alias("_lost"))
    own = own.withColumns({"_known": F.col("_lost").isNull(), "_lost": F.coalesce("_lost", F.lit(0))})
    key = ["_x", "_y", "_known", "_lost"]
    rows = own.groupBy(*key).agg(F.min("id").alias("first"), F.count("*").alias("n"), F.max(F.col("id").isin(list(name))).alias("held")).orderBy("first").collect()
    group = complete_linkage(np.array([(r._x, r._y) if r._known else (math.nan, math.nan) for r in rows], float).reshape(-1, 2), radius)
    touched = {int(g) for g, r in zip(group, rows, strict=True) if r.held}
    free = sorted(set(group.tolist()) - touched)
    order = np.random.default_rng(seed).permutation(len(free))
    size = np.bincount(group, [r.n for r in rows]).astype(int)
    load, fold = [0] * folds, {}
    for g in sorted((free[i] for i in order), key=lambda g: -size[g]):
        k = load.index(min(load))
        fold[g] = k
        load[k] += int(size[g])
    spark = sensors.sparkSession
    spots = spark.createDataFrame([(r._x, r._y, r._known, r._lost, int(g), fold.get(int(g), -1)) for r, g in zip(rows, group, strict=True)], "_x double, _y double, _known boolean, _lost long, group int, fold int")
    named = F.broadcast(spark.createDataFrame(list(name.items()), "id long, holdout string"))
    rest = F.when(F.col("fold") < 0, "neighbour").otherwise("")
    return own.join(spots, key).join(named, "id", "left").select("id", "group", "fold", F.coalesce("holdout", rest).alias("holdout"))


def spatial_groups(rows: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """Rows with their sensor's group; a sensor that isn't listed is a group of its own."""
    top = groups.agg(F.coalesce(F.max("group"), F.lit(-1)).alias("_top"))
    return rows.join(groups.select(key, "group"), key, "left").join(F.broadcast(top), F.lit(True)).withColumn("group", F.coalesce("group", (F.col("_top") + 1 + F.col(key)).cast("int"))).drop("_top")


def fold_rows(rows: DataFrame, folds: DataFrame, near: DataFrame, key: str, fold: int) -> DataFrame:
    """Rows with part `train` or `test` of one fold: train leaves out holdouts and sensors near the fold's own."""
    own = rows.join(folds.select(key, "fold"), key)
    close = near.where(F.col("fold") == fold).select(F.col("neighbour").alias(key), F.lit(True).alias("_near"))
    part = F.when(F.col("fold") == fold, "test").when((F.col("fold") >= 0) & F.col("_near").isNull(), "train")
    return own.join(close, key, "left").withColumn("part", part).where("part is not null").drop("_near")


def sample_rows(rows: DataFrame, n: int, seed: int, keys: Sequence[str]) -> DataFrame:
    """The same n rows every time: those with the least hash."""
    return rows.orderBy(F.xxhash64(*keys, F.lit(seed)), *keys).limit(n)


def final_rows(rows: DataFrame, holdouts: DataFrame, key: str) -> DataFrame:
    """All rows but those of held-out sensors."""
    return rows.join(holdouts.where("fold < 0").select(key), key, "left_anti")


def row_number_folds(rows: DataFrame, key: str, folds: int) -> DataFrame:
    """Keys dealt to folds in turn, by their order."""
    keys = rows.select(key).distinct()
    return keys.withColumn("fold", ((F.row_number().over(Window.partitionBy().orderBy(key)) - 1) % folds).cast("int"))
