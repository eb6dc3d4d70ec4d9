"""Gradient-boosted trees with Poisson and quantile losses, fitted where the rows are, and their out-of-fold loop.

Features are cut into bins at approximate quantiles; nulls are a bin of their own, below all others. A level of a tree
is one pass: each partition adds up gradients per node, feature and bin in numpy, and what is added up over partitions
and comes to the driver are those sums, whose number doesn't depend on the rows. Every pass computes predictions anew
from the trees so far, so a lost executor costs no state.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..lineage import written

LOSSES = ("poisson", "quantile")


@dataclass(frozen=True)
class Settings:
    """`quantile` is the one that is fitted under the quantile loss."""

    loss: str = "poisson"
    quantile: float = 0.5
    rounds: int = 30
    depth: int = 4
    rate: float = 0.15
    bins: int = 32
    least: int = 20

    def __post_init__(self) -> None:
        if self.loss not in LOSSES:
            raise ValueError(f"unknown loss {self.loss!r}: one of {', '.join(LOSSES)}")


@dataclass
class Trees:
    """For each tree the feature and the last bin to the left of every inner node, in rows, and the leaves' values."""

    columns: list[str]
    edges: list[np.ndarray]
    settings: Settings
    base: float = 0.0
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def binned(self, values: Sequence[np.ndarray]) -> np.ndarray:
        """Bins of each feature: 0 for null, else one more than the edges up to the value."""
        return np.stack([np.where(np.isnan(v), 0, 1 + np.searchsorted(e, v, side="right")) for v, e in zip(values, self.edges, strict=True)], 1).astype(np.uint8)

    def raw(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, cut, value in self.trees:
            out += value[self.leaf(x, feature, cut, rows)]
        return out

    @staticmethod
    def leaf(x: np.ndarray, feature: np.ndarray, cut: np.ndarray, rows: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        for _ in range(int(np.log2(len(feature) + 1))):
            node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
        return node - len(feature)

    def predicted(self, x: np.ndarray) -> np.ndarray:
        return np.exp(self.raw(x)) if self.settings.loss == "poisson" else self.raw(x)


def _arrays(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins, target and weight of a batch of the binned table."""
    x = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(-1, width)
    return x, batch.column(1).to_numpy(), batch.column(2).to_numpy()


def _gradients(raw: np.ndarray, y: np.ndarray, w: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    if s.loss == "poisson":
        mean = np.exp(np.minimum(raw, 50))
        return w * (mean - y), w * mean
    return w * ((y < raw) - s.quantile), w


def _level(table: DataFrame, model: Trees, tree: tuple[np.ndarray, np.ndarray], depth: int) -> np.ndarray:
    """Sums of gradient, curvature and rows by node of this depth, feature and bin."""
    width, bins, first = len(model.columns), model.settings.bins + 2, 2**depth - 1
    shape = (2**depth, width, bins)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, int(np.prod(shape))))
        for batch in batches:
            x, y, w = _arrays(batch, width)
            g, h = _gradients(model.raw(x), y, w, model.settings)
            node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, tree[0][node]] > tree[1][node])
            slot = (((node - first) * width)[:, None] + np.arange(width)) * bins + x
            for k, v in enumerate((g, h, np.ones(len(x)))):
                sums[k] += np.bincount(slot.ravel(), np.repeat(v, width), sums.shape[1])
        at = np.flatnonzero(sums[2])
        yield pa.RecordBatch.from_arrays([pa.array(at), *[pa.array(sums[k][at]) for k in range(3)]], names=["slot", "g", "h", "n"])

    rows = table.mapInArrow(run, "slot long, g double, h double, n double").groupBy("slot").agg(*[F.sum(c).alias(c) for c in ("g", "h", "n")]).collect()
    out = np.zeros((3, int(np.prod(shape))))
    for r in rows:  # at most nodes x features x bins
        out[:, r.slot] = r.g, r.h, r.n
    return out.reshape(3, *shape)


def _split(sums: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The best feature and cut of each node; a node that isn't worth a split sends all to the left."""
    g, h, n = (v.cumsum(2) for v in sums)
    total_g, total_h, total_n = (v[:, :, -1:] for v in (g, h, n))
    gain = g**2 / (h + 1) + (total_g - g) ** 2 / (total_h - h + 1) - total_g**2 / (total_h + 1)
    gain[(n < s.least) | (total_n - n < s.least)] = -np.inf
    flat = gain.reshape(len(gain), -1)
    best = flat.argmax(1)
    worth = flat[np.arange(len(flat)), best] > 1e-9
    return np.where(worth, best // gain.shape[2], 0), np.where(worth, best % gain.shape[2], 255)


def _leaves(table: DataFrame, model: Trees, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """The value of each leaf: a Newton step, or under the quantile loss that quantile of what is left in it."""
    s, width = model.settings, len(model.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, w = _arrays(batch, width)
            raw = model.raw(x)
            leaf = Trees.leaf(x, feature, cut, np.arange(len(x)))
            g, h = _gradients(raw, y, w, s)
            if s.loss == "quantile":
                yield pa.RecordBatch.from_arrays([pa.array(leaf), pa.array(y - raw), pa.array(h)], names=["leaf", "a", "b"])
            else:
                n = 2**s.depth
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(n)), pa.array(np.bincount(leaf, g, n)), pa.array(np.bincount(leaf, h, n))], names=["leaf", "a", "b"])

    rows = table.mapInArrow(run, "leaf long, a double, b double").groupBy("leaf")
    if s.loss == "quantile":
        got = rows.agg(F.percentile_approx("a", s.quantile, 1000).alias("v"))
    else:
        got = rows.agg((-F.sum("a") / (F.sum("b") + 1)).alias("v"))
    out = np.zeros(2**s.depth)
    for r in got.collect():  # a row for each leaf
        out[r.leaf] = s.rate * r.v
    return out


def fit(df: DataFrame, y: str, columns: Sequence[str], settings: Settings = Settings(), weight: str | None = None) -> Trees:
    """Trees for rows with a target. A column without values is never split on."""
    s, own = settings, df.where(F.col(y).isNotNull()).select(*[F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(columns)], F.col(y).cast("double").alias("y"), (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("w"))
    names = [f"f{i}" for i in range(len(columns))]
    marks = own.approxQuantile(names, [k / s.bins for k in range(1, s.bins)], 1 / (8 * s.bins))
    model = Trees(list(columns), [np.unique(m) for m in marks], s)
    start = own.agg((F.sum(F.col("y") * F.col("w")) / F.sum("w")).alias("m"), F.percentile_approx("y", s.quantile, 10_000).alias("q")).first()
    if start.m is None:
        raise ValueError("no rows to fit on")
    model.base = float(np.log(max(start.m, 1e-9))) if s.loss == "poisson" else float(start.q)

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = model.binned([b.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(len(names))])
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary()), b.column(len(names)), b.column(len(names) + 1)], names=["x", "y", "w"])

    table = written(own.mapInArrow(bins, "x binary, y double, w double"), "binned")
    for _ in range(s.rounds):
        feature, cut = np.zeros(2**s.depth - 1, np.int64), np.full(2**s.depth - 1, 255)
        for depth in range(s.depth):
            at = slice(2**depth - 1, 2 ** (depth + 1) - 1)
            feature[at], cut[at] = _split(_level(table, model, (feature, cut), depth), s)
        value = _leaves(table, model, feature, cut)
        model.trees.append((feature, cut, value))
    return model


def predict(model: Trees, df: DataFrame, name: str = "predicted") -> DataFrame:
    """Rows with what the trees predict, never below zero."""
    missing = [c for c in model.columns if c not in df.columns]
    if missing:
        raise ValueError(f"features missing: {', '.join(missing)}")

    @F.pandas_udf("double")
    def of(*values: pd.Series) -> pd.Series:
        return pd.Series(np.maximum(model.predicted(model.binned([v.to_numpy(float) for v in values])), 0.0))

    return df.withColumn(name, of(*[F.col(c).cast("double") for c in model.columns]))


def oof_predict(df: DataFrame, fold: str, fit_one: Callable[[DataFrame], object], predict_one: Callable[[object, DataFrame], DataFrame]) -> DataFrame:
    """Each row predicted by a model that was fitted on the other folds; rows of negative folds are left to a holdout."""
    folds = sorted(r[0] for r in df.where(F.col(fold) >= 0).select(fold).distinct().collect())
    if len(folds) < 2:
        raise ValueError("two folds or more are needed")
    parts = [predict_one(fit_one(df.where((F.col(fold) >= 0) & (F.col(fold) != k))), df.where(F.col(fold) == k)) for k in folds]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def oof_intervals(df: DataFrame, fold: str, y: str, columns: Sequence[str], low: float = 0.1, high: float = 0.9, settings: Settings = Settings()) -> DataFrame:
    """Out-of-fold predicted, lower and upper, with lower <= predicted <= upper."""
    from dataclasses import replace

    asked = {"predicted": replace(settings, loss="poisson"), "lower": replace(settings, loss="quantile", quantile=low), "upper": replace(settings, loss="quantile", quantile=high)}

    def fit_one(rows: DataFrame) -> dict[str, Trees]:
        return {n: fit(rows, y, columns, s) for n, s in asked.items()}

    def predict_one(models, rows: DataFrame) -> DataFrame:
        for n, m in models.items():
            rows = predict(m, rows, n)
        return rows

    out = oof_predict(df, fold, fit_one, predict_one)
    return out.withColumns({"lower": F.least("lower", "predicted"), "upper": F.greatest("upper", "predicted")})


def tune(df: DataFrame, fold: str, y: str, columns: Sequence[str], candidates: Sequence[Settings], error) -> DataFrame:
    """The out-of-fold error of each candidate, best first: folds are groups of sensors, so none is in both parts."""
    rows = []
    for i, s in enumerate(candidates):
        got = oof_predict(df, fold, lambda r, s=s: fit(r, y, columns, s), predict)
        rows.append((i, s.rounds, s.depth, s.rate, got.agg(error(y, "predicted").alias("e")).first()[0]))
    return df.sparkSession.createDataFrame(rows, "candidate int, rounds int, depth int, rate double, error double").orderBy("error", "candidate")
