"""Column profiles, reference distributions and how far new rows drift from them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..lineage import written

QUANTILES = (0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)
MAX_CATEGORIES = 30


def profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A row for each column: null share and what its type has: true share; min, max, mean, std and median; or distinct values.

    All of it is one aggregation of the table.
    """
    types = dict(df.dtypes)
    aggs, structs = [], []
    for i, c in enumerate(columns or df.columns):
        t = types[c]
        got: dict[str, Column] = {"null_share": F.avg(F.col(c).isNull().cast("int"))}
        if t == "boolean":
            got["true_share"] = F.avg(F.col(c).cast("int"))
        elif t in ("tinyint", "smallint", "int", "bigint", "float", "double") or t.startswith("decimal"):
            v = F.col(c).cast("double")
            got |= {"min": F.min(v), "max": F.max(v), "mean": F.avg(v), "std": F.stddev_samp(v), "median": F.percentile(v, F.lit(0.5))}
        elif t.startswith("timestamp") or t == "date":
            got |= {"first": F.min(c).cast("string"), "last": F.max(c).cast("string")}
        else:
            got["n_distinct"] = F.count_distinct(c)
        aggs.append(F.struct(*[v.alias(k) for k, v in got.items()]).alias(f"_{i}"))

        def part(k: str, kind: str, got=got, i=i) -> Column:
            return (F.col(f"_{i}.{k}") if k in got else F.lit(None)).cast(kind).alias(k)

        doubles = [F.round(part(k, "double"), 4).alias(k) for k in ("null_share", "true_share", "min", "max", "mean", "std", "median")]
        structs.append(F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("data_type"), *doubles, part("first", "string"), part("last", "string"), part("n_distinct", "bigint")))
    return df.agg(*aggs).select(F.explode(F.array(*structs)).alias("_p")).select("_p.*")


def top_values(df: DataFrame, columns: Sequence[str], n: int = 5) -> DataFrame:
    """The most frequent values of each column, ties by value."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]))
    per = df.select(each.alias("_s")).select("_s.*").where("value is not null").groupBy("column_name", "value").agg(F.count("*").alias("n_rows"))
    rank = F.row_number().over(Window.partitionBy("column_name").orderBy(F.desc("n_rows"), "value"))
    return per.withColumn("place", rank).where(F.col("place") <= n)


def history_row(df: DataFrame, run_at: str, sensor: str, ts: str, value: str) -> DataFrame:
    """One line for the history of runs."""
    return df.agg(F.lit(run_at).alias("run_at"), F.count("*").alias("n_rows"), F.count_distinct(sensor).alias("n_sensors"), F.min(ts).alias("first_hour"), F.max(ts).alias("last_hour"), F.round(F.avg(value), 4).alias("mean_count"))


def long_values(df: DataFrame, columns: Sequence[str], *keep: str) -> DataFrame:
    """A row for each column's value: column_name and v."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in columns])).alias("_s")
    return df.select(*keep, each).select(*keep, "_s.*")


def exact_quantiles(counted: DataFrame, asked: Sequence[float]) -> DataFrame:
    """column_name and quantiles (interpolated between neighbours) of values v that occur n times each.

    Values are sorted into ranges, so no task has a whole column: each range is summed up within itself, ranges are
    offset by those before them, and only ranks that are asked are looked up.
    """
    dealt = written(counted.where("v is not null").repartitionByRange("column_name", "v").withColumn("part", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy("column_name", "part").agg(F.sum("n").alias("size"))
    before = Window.partitionBy("column_name").orderBy("part")
    placed = sizes.withColumn("end", F.sum("size").over(before)).withColumn("total", F.sum("size").over(Window.partitionBy("column_name")))
    # the ranks asked of each column, and the range each is in
    ranks = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(q)).alias("q")) for i, q in enumerate(asked)])).alias("r")
    wanted = placed.select("column_name", "part", "size", "end", ranks, ((F.col("total") - 1) * F.col("r.q")).alias("at"))
    both = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.floor("at").alias("rank")), F.struct(F.lit(1).alias("side"), F.ceil("at").alias("rank")))).alias("s")
    wanted = wanted.select("column_name", "part", "size", "end", "r.i", "at", both).select("column_name", "part", "i", "at", "s.side", "s.rank", (F.col("end") - F.col("size")).alias("start"), "end")
    wanted = wanted.where("start <= rank and rank < end").withColumn("rank", F.col("rank") - F.col("start")).drop("start", "end")
    up = F.sum("n").over(Window.partitionBy("column_name", "part").orderBy("v"))
    run = dealt.withColumn("upto", up)
    found = run.join(F.broadcast(wanted), ["column_name", "part"]).where((F.col("upto") - F.col("n") <= F.col("rank")) & (F.col("rank") < F.col("upto")))
    one = found.groupBy("column_name", "i", "at").agg(F.max(F.when(F.col("side") == 0, F.col("v"))).alias("a"), F.max(F.when(F.col("side") == 1, F.col("v"))).alias("b"))
    value = F.col("a") + (F.col("b") - F.col("a")) * (F.col("at") - F.floor("at"))
    return one.groupBy("column_name").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", value.alias("v")))), lambda x: x["v"]).alias("quantiles"))


def reference_quantiles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Of each column its null share, quantiles, number of values and decile edges (unique, ascending).

    Equal values are counted first.
    """
    counted = written(long_values(df, columns).groupBy("column_name", "v").agg(F.count("*").alias("n")), "values")
    null = F.sum(F.when(F.col("v").isNull(), F.col("n")).otherwise(0)) / F.sum("n")
    per = counted.groupBy("column_name").agg(null.alias("null_share"), F.count("v").alias("n_distinct"))
    n = len(QUANTILES)
    out = per.join(exact_quantiles(counted, [*QUANTILES, *(i / 10 for i in range(11))]).withColumnRenamed("quantiles", "_q"), "column_name", "left")
    return out.select("column_name", "null_share", F.slice("_q", 1, n).alias("quantiles"), "n_distinct", F.array_sort(F.array_distinct(F.slice("_q", n + 1, 11))).alias("edges"))


def bin_number(value: Column, edges: Column) -> Column:
    """Bin of [edge, next edge) from 0, of at most eleven edges; values outside go to the end bins."""
    steps = [F.when((F.size(edges) - 1 > i) & (F.get(edges, F.lit(i)) <= value), 1).otherwise(0) for i in range(1, 10)]
    return reduce(add, steps)


def shares(values: DataFrame, reference: DataFrame, *by: str) -> DataFrame:
    """Share of each column's values in each bin of its reference: a value of few, or a decile bin of many."""
    rows = values.where("v is not null").join(F.broadcast(reference.select("column_name", "n_distinct", "edges")), "column_name")  # a row for each column
    cell = F.when(F.col("n_distinct") <= MAX_CATEGORIES, F.col("v")).otherwise(bin_number(F.col("v"), F.col("edges")).cast("double"))
    per = rows.groupBy(*by, "column_name", cell.alias("cell")).agg(F.count("*").alias("_n"))
    return per.select(*by, "column_name", "cell", (F.col("_n") / F.sum("_n").over(Window.partitionBy(*by, "column_name"))).alias("share"))


def psi(both: DataFrame, floor: float = 1e-4) -> DataFrame:
    """Population stability index of each column, from shares with is_new. Values the reference never saw are one bin of their own."""
    e, a = F.max(F.when(~F.col("is_new"), F.col("share"))), F.max(F.when(F.col("is_new"), F.col("share")))
    per = both.groupBy("column_name", "cell").agg(e.alias("e"), a.alias("a"))
    known = F.col("e").isNotNull()
    merged = per.groupBy("column_name", known.alias("known"), F.when(known, F.col("cell")).alias("cell")).agg(F.coalesce(F.max("e"), F.lit(0.0)).alias("e"), F.coalesce(F.sum("a"), F.lit(0.0)).alias("a"))
    x, y = F.greatest("e", F.lit(floor)), F.greatest("a", F.lit(floor))
    return merged.groupBy("column_name").agg(F.sum((y - x) * F.ln(y / x)).alias("psi"))


def drift(reference_rows: DataFrame, rows: DataFrame, columns: Sequence[str], warn: float = 0.25) -> DataFrame:
    """PSI of each column of `rows` against the distribution of `reference_rows`, and whether it warns.

    Both sets are binned in one pass, so the reference distribution is computed once.
    """
    ref = reference_quantiles(reference_rows, columns)
    both = long_values(reference_rows.withColumn("is_new", F.lit(False)), columns, "is_new").unionByName(long_values(rows.withColumn("is_new", F.lit(True)), columns, "is_new"))
    return psi(shares(both, ref, "is_new")).withColumn("drifted", F.col("psi") > warn)
