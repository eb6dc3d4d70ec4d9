"""Mixing sources to target weights: temperature mixing, realised as budgeted block permutations.

A source's share of the tokens is raised to an exponent and normalised. The exponent is bisected so that the mixture's
entropy reaches a part of the greatest possible; where that would repeat a source more often than allowed, it is
bisected for the repetition limit instead. A source's weight times the budget is its number of tokens: so many whole
epochs, then a part of one. Each epoch orders the source's blocks, and the documents in a block, by a seeded hash; the
part of an epoch is the longest prefix of that order within the budget.

Only sources are planned on the driver (at most `most_sources`, else ValueError), and blocks (at most `most_blocks` of
a source) are ordered apart from documents, so a hot source is dealt like the others.

Edge cases: a null source is a source of its own; null and empty texts have no tokens and go with their block; rows
with a null id are ordered by their text; equal rows are interchangeable; without tokens every document is taken once;
an empty table gives no rows. A source whose part ends inside its first document gets no part of an epoch.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import written


@dataclass(frozen=True)
class Settings:
    """`budget` is in tokens; None takes as many as there are."""

    entropy: float = 0.97
    repeats: float = 4.0
    budget: int | None = None
    seed: int = 17
    block: int = 64
    most_blocks: int = 4096
    most_sources: int = 100_000


def weights(shares: list[float], exponent: float) -> list[float]:
    raised = [p**exponent if p > 0 else 0.0 for p in shares]
    total = math.fsum(raised)
    return [r / total for r in raised]


def entropy(q: list[float]) -> float:
    return -math.fsum(p * math.log(p) for p in q if p > 0)


def bisect(holds, low: float = 0.0, high: float = 1.0) -> float:
    """The greatest exponent in [low, high] for which `holds`, which is true from below."""
    if holds(high):
        return high
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if holds(mid) else (low, mid)
    return low


def exponent(tokens: list[int], s: Settings) -> float:
    """The exponent that meets the target entropy, raised as far as the repetition limit asks."""
    total = sum(tokens)
    shares = [t / total for t in tokens]
    budget = total if s.budget is None else s.budget
    target = s.entropy * math.log(max(sum(t > 0 for t in tokens), 1))
    a = bisect(lambda e: entropy(weights(shares, e)) >= target)

    def repeats(e: float) -> float:
        return max(w * budget / t for w, t in zip(weights(shares, e), tokens, strict=True) if t)

    if repeats(a) > s.repeats:
        if repeats(1.0) > s.repeats:
            return 1.0
        a = 1 - bisect(lambda d: repeats(1 - d) <= s.repeats, 0.0, 1 - a)
    return a


def plan(tokens: dict[str, tuple[int, int]], s: Settings) -> list[tuple[str, float, int, int, int]]:
    """(source, weight, whole epochs, tokens of the rest, blocks) from each source's tokens and documents."""
    names = sorted(tokens)
    have = [tokens[n][0] for n in names]
    blocks = [min(max(-(-tokens[n][1] // s.block), 1), s.most_blocks) for n in names]
    if not sum(have):
        return [(n, 0.0, 1, 0, b) for n, b in zip(names, blocks, strict=True)]
    q = weights([t / sum(have) for t in have], exponent(have, s))
    out = []
    for n, t, w, b in zip(names, have, q, blocks, strict=True):
        quota = int(w * (sum(have) if s.budget is None else s.budget))
        out.append((n, w, quota // t, quota % t, b) if t else (n, 0.0, 1, 0, b))
    return out


def mixed_rows(docs: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text", source: str = "source", keep: list[str] | None = None) -> DataFrame:
    """row (a struct of the chosen row's columns, or of those of `keep`), tokens, weight, epoch and block; a row stands once for each epoch it is in.

    Texts are read once, to count their tokens; what is kept of the rows is written with that.
    """
    names = docs.columns if keep is None else keep
    h = F.when(F.col(key).isNull(), F.xxhash64(F.col(text), F.lit(settings.seed))).otherwise(F.xxhash64(F.col(key), F.lit(settings.seed)))
    counted = written(
        docs.select(
            F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
            F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("null")).alias("source"),
            F.coalesce(F.regexp_count(F.col(text), F.lit("\\S+")), F.lit(0)).cast("long").alias("tokens"),
            h.alias("h"),
            F.xxhash64(F.col(text)).alias("tie"),
        ),
        "counted",
    )
    rows = counted.groupBy("source").agg(F.sum("tokens"), F.count("*")).limit(settings.most_sources + 1).collect()
    if len(rows) > settings.most_sources:
        raise ValueError(f"more than {settings.most_sources} sources")
    planned = docs.sparkSession.createDataFrame(plan({r[0]: (r[1], r[2]) for r in rows}, settings), "source string, weight double, epochs long, rest long, blocks int")
    dealt = counted.join(F.broadcast(planned), "source").withColumn("block", F.pmod(F.col("h"), F.col("blocks")).cast("int"))
    out = ["row", "tokens", "weight", "epoch", "block"]
    whole = dealt.where("epochs > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("epochs") - 1))).select(*out)
    # the rest: blocks in the order of the next epoch, up to the budget
    order = F.xxhash64("source", "block", "epochs", F.lit(settings.seed))
    by_block = dealt.where("rest > 0").groupBy("source", "block", "epochs", "rest").agg(F.sum("tokens").alias("size"))
    up = Window.partitionBy("source").orderBy(order, "block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = by_block.withColumn("end", F.sum("size").over(up)).where(F.col("end") - F.col("size") < F.col("rest"))
    cut = cut.select("source", "block", F.when(F.col("end") <= F.col("rest"), F.lit(None)).otherwise(F.col("rest") - F.col("end") + F.col("size")).alias("left"))
    # at most `most_blocks` rows of each source
    part = dealt.where("rest > 0").join(cut, ["source", "block"]).withColumn("epoch", F.col("epochs"))
    inside = Window.partitionBy("source", "block").orderBy(F.xxhash64("h", "epochs"), "h", "tokens", "tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = part.where("left is not null").withColumn("end", F.sum("tokens").over(inside)).where("end <= left")
    return whole.unionByName(part.where("left is null").select(*out)).unionByName(edge.select(*out))


def mix_sources(docs: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The chosen rows with their columns and _tokens, _weight, _epoch, _block; the rows' own columns of these names give way."""
    out = mixed_rows(docs, settings, key, text, source)
    own = ("tokens", "weight", "epoch", "block")
    return out.select(*[F.col("row").getField(c).alias(c) for c in docs.columns if c not in {f"_{n}" for n in own}], *[F.col(n).alias(f"_{n}") for n in own])


def op2_temperature_mixture(spark, sf_dir: str) -> DataFrame:
    out = mixed_rows(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep=["doc_id", "source"])
    return out.select("row.doc_id", "row.source", "epoch", "block", F.col("tokens").alias("n_tokens"), F.round("weight", 9).alias("weight"))
