"""Data-quality checks written as data and compiled to a few jobs: rows of name, severity, passed and what was seen."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .calendar import condition

ERROR, WARNING = "error", "warning"


@dataclass(frozen=True)
class Suite:
    """What a table promises."""

    keys: Sequence[str] = ()
    never_missing: Sequence[str] = ()
    required_when: dict[str, tuple] = field(default_factory=dict)
    ranges: dict[str, tuple] = field(default_factory=dict)
    allowed: dict[str, Sequence] = field(default_factory=dict)
    mostly: dict[str, float] = field(default_factory=dict)


def schema_checks(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """Missing, unexpected and retyped columns."""
    have = dict(df.dtypes)
    found = {
        "schema: no column missing": [c for c in expected if c not in have], "schema: no column unexpected": [c for c in have if c not in expected],
        "schema: no column retyped": [f"{c}: {expected[c]} -> {t}" for c, t in have.items() if c in expected and expected[c] != t],
    }
    return df.sparkSession.createDataFrame([(n, ERROR, not v, ", ".join(sorted(v))) for n, v in found.items()], "name string, severity string, passed boolean, detail string")


def rules(s: Suite, columns: Sequence[str]) -> list[tuple[str, str, Column, Column, float]]:
    """(name, severity, rows it looks at, bad rows, share that may be bad); rules on columns the table lacks are skipped."""
    every, out = F.lit(True), []
    out += [(f"present: {c}", ERROR, every, F.col(c).isNull(), 0.0) for c in s.never_missing if c in columns]
    out += [(f"present: {c} where {' '.join(map(str, r))}", ERROR, condition(*r), F.col(c).isNull(), 0.0) for c, r in s.required_when.items() if c in columns]
    out += [(f"range: {c} in [{a}, {z}]", ERROR, F.col(c).isNotNull(), ~F.col(c).between(a, z), 0.0) for c, (a, z) in s.ranges.items() if c in columns]
    out += [(f"allowed: {c}", ERROR, F.col(c).isNotNull(), ~F.col(c).isin(*v), 0.0) for c, v in s.allowed.items() if c in columns]
    out += [(f"present: {c} (>= {m:.0%})", WARNING, every, F.col(c).isNull(), 1 - m) for c, m in s.mostly.items() if c in columns]
    return out


def run_suite(df: DataFrame, s: Suite) -> DataFrame:
    """All rules in one aggregation of the table, and its keys in one more."""
    compiled = rules(s, df.columns)
    counts = [x for i, (_, _, look, bad, _) in enumerate(compiled) for x in (F.count(F.when(look, 1)).alias(f"n{i}"), F.count(F.when(look & bad, 1)).alias(f"b{i}"))]
    # a share of exactly what may be bad passes, whatever rounding did to it
    rows = [
        F.struct(F.lit(name).alias("name"), F.lit(sev).alias("severity"), (F.col(f"b{i}") <= F.col(f"n{i}") * share + 1e-9).alias("passed"), F.col(f"b{i}").alias("n_bad"), F.col(f"n{i}").alias("n_rows"))
        for i, (name, sev, _, _, share) in enumerate(compiled)
    ]
    out = df.agg(*counts).select(F.explode(F.array(*rows)).alias("_c")).select("_c.*") if rows else None
    if s.keys:
        twice = df.groupBy(*s.keys).agg(F.count("*").alias("_n")).agg(F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n")).otherwise(0)), F.lit(0)).alias("n_bad"), F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"))
        key = twice.select(F.lit("keys: unique " + "+".join(s.keys)).alias("name"), F.lit(ERROR).alias("severity"), (F.col("n_bad") == 0).alias("passed"), "n_bad", "n_rows")
        out = key if out is None else out.unionByName(key)
    return out


def outage_share(df: DataFrame, flag: str, most: float = 0.01) -> DataFrame:
    share = F.avg(F.col(flag).cast("int"))
    return df.agg(F.lit("anomaly: share of outage zeros").alias("name"), F.lit(WARNING).alias("severity"), (share <= most).alias("passed"), share.alias("observed"))


def freshness(df: DataFrame, ts: str, now: Column, most_days: float = 5) -> DataFrame:
    age = F.timestamp_diff("SECOND", F.max(ts), now) / 86400
    return df.agg(F.lit("anomaly: the table is fresh").alias("name"), F.lit(WARNING).alias("severity"), (age <= most_days).alias("passed"), age.alias("observed"))


def run_drift(current: DataFrame, previous: DataFrame, row_drop: float = 0.01, mean_change: float = 0.2) -> DataFrame:
    """This run's summary row against the last good one: rows, sensors and mean count. Without one, all pass."""
    c = current.select(F.col("n_rows").alias("cr"), F.col("n_sensors").alias("cs"), F.col("mean_count").alias("cm"))
    p = previous.select(F.col("n_rows").alias("pr"), F.col("n_sensors").alias("ps"), F.col("mean_count").alias("pm"))
    rows = [
        ("drift: rows dropped", ERROR, (F.col("pr") - F.col("cr")) / F.col("pr") <= row_drop, F.col("pr"), F.col("cr")), ("drift: no fewer sensors", WARNING, F.col("cs") >= F.col("ps"), F.col("ps"), F.col("cs")),
        ("drift: mean count changed", WARNING, F.abs(F.col("cm") - F.col("pm")) / F.col("pm") <= mean_change, F.col("pm"), F.col("cm")),
    ]
    made = [F.struct(F.lit(n).alias("name"), F.lit(s).alias("severity"), F.coalesce(ok, F.lit(True)).alias("passed"), b.cast("double").alias("previous"), now.cast("double").alias("current")) for n, s, ok, b, now in rows]
    return c.join(F.broadcast(p), F.lit(True), "left").select(F.explode(F.array(*made)).alias("_c")).select("_c.*")


def null_drift(current: DataFrame, previous: DataFrame, points: float = 5.0) -> DataFrame:
    """Columns whose missing share grew by more than so many points between two profiles."""
    c, p = current.select("column_name", F.col("null_share").alias("current")), previous.select("column_name", F.col("null_share").alias("previous"))
    return c.join(p, "column_name").where((F.col("current") - F.col("previous")) * 100 > points)


def segment_checks(df: DataFrame, radii: Sequence[int], cap: float = 2000.0, main_share: float = 0.8) -> DataFrame:
    """Network metrics present, reach growing with the radius, values in range, one main component: one aggregation."""
    metric = F.col("in_metric_graph") if "in_metric_graph" in df.columns else F.lit(True)
    present = [c for r in radii for c in (f"met_betweenness_{r}", f"met_reach_{r}") if c in df.columns]
    gone = sum((F.count(F.when(metric & F.col(c).isNull(), 1)) for c in present), F.lit(0))
    shrunk = sum((F.count(F.when(F.col(f"met_reach_{b}") < F.col(f"met_reach_{a}"), 1)) for a, b in zip(radii, radii[1:], strict=False) if f"met_reach_{b}" in df.columns), F.lit(0))
    limits = {"length_m": (1e-6, None), "building_coverage": (0, 1), "building_count": (0, None), "degree_min": (1, None)}
    limits |= {c: (0, None) for c in df.columns if c.startswith("poi_")} | {c: (0, cap) for c in df.columns if c.endswith("_dist_m")}
    out_of = F.lit(0)
    for c, (a, z) in limits.items():
        if c in df.columns:
            out_of = out_of + F.count(F.when((F.col(c) < a) | ((F.col(c) > z) if z is not None else F.lit(False)), 1))
    main = F.sum(F.when(F.col("in_main_component"), F.col("length_m")).otherwise(0)) / F.sum("length_m")
    rows = [("metrics present", ERROR, "gone", F.col("gone") == 0), ("reach grows with radius", ERROR, "shrunk", F.col("shrunk") == 0), ("ranges", ERROR, "out_of", F.col("out_of") == 0), ("main component share of length", WARNING, "main", F.col("main") >= main_share)]
    made = [F.struct(F.lit(n).alias("name"), F.lit(s).alias("severity"), ok.alias("passed"), F.round(F.col(v).cast("double"), 4).alias("observed")) for n, s, v, ok in rows]
    return df.agg(gone.alias("gone"), shrunk.alias("shrunk"), out_of.alias("out_of"), main.alias("main")).select(F.explode(F.array(*made)).alias("_c")).select("_c.*")


def failed(report: DataFrame, severity: str = ERROR) -> DataFrame:
    """The checks that must stop a run."""
    return report.where((F.col("severity") == severity) & ~F.col("passed"))


def message(report: DataFrame) -> DataFrame:
    """Warnings that failed as one text, or no row."""
    lines = F.array_join(F.array_sort(F.collect_list("name")), "\n")
    return report.where((F.col("severity") == WARNING) & ~F.col("passed")).agg(F.count("*").alias("n_warnings"), lines.alias("body")).where("n_warnings > 0")
