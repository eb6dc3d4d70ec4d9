"""Near-duplicates by one-permutation MinHash, with links confirmed on full shingle sets.

1. A text's k-word shingles, hashed to 64 bits, fall into bins by their high bits; the least of a bin is its value, and
   empty bins borrow from others by optimal densification. Sets too small to fill bins use a permutation for each
   value instead; a range of sizes that is as wide as the threshold allows gets both, so no pair falls between.
2. Equal sets are one class, whose smallest id stands for it. Bands of the values make bucket keys. Every bucket gives
   star-shaped edges from its smallest id to the others, so candidate edges never outnumber bucket rows; the centres of
   one text are then joined to the smallest of them, so that it keeps one edge.
3. Any two similar sets share a bucket, but for a chance of about 1e-6, hence a star and a component of candidate
   edges. Components are dealt in blocks of `block` sets; a block, or two that meet, are searched exactly, on full sets,
   by growing clusters from a centre over those not yet reached. No task holds more than two blocks.
4. Of a component of several blocks, one block first meets all others. What it links is one cluster with it, mostly
   nearly all. Then those outside of their component's largest cluster meet all blocks, in rounds of doubling size,
   until none is left that hasn't. Two sets of different clusters are not both in the largest one, so one of them has
   met the other: no link is lost. Clusters come out as stars, and components of those are the result.

The cost is linear in the rows, and in the different texts of a candidate component, if most of them hang together. Only
one of many texts that are linked with few others costs the square of those.

Edge cases: null or empty texts have empty sets and are linked with nothing; a row with a null id keeps to itself (its
component_id is null, and it is kept); repeated rows share a component; fewer than k words count as one shingle; an
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import components
from .shared import arrow_map, written
from .textarrays import groups, mix, shingle_sets

U = np.uint64


@dataclass(frozen=True)
class Settings:
    """`percent` is the least similarity; by default five-word shingles and 80.

    There are as many bands as keep the chance that a pair at the least similarity shares none at `miss`: 32 of six
    values for 85 percent, 50 for 80. Sets of up to `small` shingles get a permutation for each value.
    """

    words: int = 5
    percent: int = 80
    rows: int = 6
    miss: float = 3e-7
    small: int = 128
    block: int = 128

    @property
    def bands(self) -> int:
        return max(1, math.ceil(math.log(self.miss) / math.log(1 - min(self.percent / 100, 0.999) ** self.rows)))


def _permuted(s: np.ndarray, n: int) -> np.ndarray:
    seeds = mix(np.arange(1, n + 1, dtype=np.uint64))
    return mix(s[:, None] ^ seeds[None, :]).min(0)


_probes: dict[int, np.ndarray] = {}


def one_permutation(s: np.ndarray, n: int) -> np.ndarray:
    """The least hash of each of `n` bins; an empty bin takes the value of the first filled one among its own random bins."""
    if n not in _probes:
        _probes[n] = (mix(np.arange(n * 4096, dtype=np.uint64) + U(77)) % U(n)).astype(np.int64).reshape(4096, n)
    bins = ((s >> U(32)) * U(n) >> U(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(bins, prepend=-1))
    out, full = np.zeros(n, np.uint64), np.zeros(n, bool)
    out[bins[first]], full[bins[first]] = s[first], True
    empty, k = np.flatnonzero(~full), 0
    while len(empty):
        at = _probes[n][k % 4096][empty] if k < 4096 else np.full(len(empty), bins[first[0]])
        found = full[at]
        out[empty[found]] = out[at[found]]
        empty, k = empty[~found], k + 1
    return out


def band_keys(s: np.ndarray, settings: Settings) -> np.ndarray:
    """Bucket keys of a sorted set; of both kinds near the size where the kinds change."""
    n, out = settings.bands * settings.rows, []
    if len(s) and len(s) * settings.percent <= 100 * settings.small:
        out.append((_permuted(s, n), 1))
    if len(s) >= settings.small:
        out.append((one_permutation(s, n), 2))
    keys = []
    for values, kind in out:
        k = mix(np.arange(settings.bands, dtype=np.uint64) * U(2) + U(kind))
        for column in values.reshape(settings.bands, settings.rows).T:
            k = mix(k + column)
        keys.append(k)
    return np.concatenate(keys) if keys else np.empty(0, np.uint64)


def signatures(docs: DataFrame, settings: Settings, key: str, text: str) -> DataFrame:
    def of_batch(cols: dict[str, list]) -> dict[str, list]:
        texts = [(t or "").encode() for t in cols["text"]]
        sets = [s for a, b in groups([len(t) for t in texts]) for s in shingle_sets(texts[a:b], settings.words)]
        with np.errstate(over="ignore"):
            return {
                "doc_id": cols["doc_id"], "n_shingles": [len(s) for s in sets], "h1": [int(s.sum(dtype=np.uint64).astype(np.int64)) for s in sets],
                "h2": [int(mix(s).sum(dtype=np.uint64).astype(np.int64)) for s in sets], "bands": [band_keys(s, settings).view(np.int64) for s in sets],
            }

    return arrow_map(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")), "doc_id long, n_shingles long, h1 long, h2 long, bands array<long>", of_batch, 256)


def clusters(sets: list[np.ndarray], percent: int) -> list[list[int]]:
    """Clusters of sets that links of at least `percent` connect; each has two or more members."""
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    sizes = np.array([len(s) for s in sets])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    left, out = np.ones(len(sets), bool), []
    own = np.zeros(int(ids.max()) + 1, np.int64)
    while left.any():
        todo = [int(left.argmax())]
        left[todo] = False
        cluster = []
        while todo:
            c = todo.pop()
            cluster.append(c)
            if not left.any():
                continue
            at = ids[starts[c] : starts[c] + sizes[c]]
            own[at] = 1
            both = np.add.reduceat(own[ids], starts)
            own[at] = 0
            new = np.flatnonzero(left & (100 * both >= percent * (sizes + sizes[c] - both)))
            left[new] = False
            todo += new.tolist()
        if len(cluster) > 1:
            out.append(cluster)
    return out


def _links(percent: int):
    arrow = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by task; a task's rows are one or two blocks."""
        at, ids, sets = None, [], []

        def solve() -> pa.RecordBatch:
            pairs = [(ids[min(c, key=lambda i: ids[i])], ids[m]) for c in clusters(sets, percent) for m in c]
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs if p[0] != p[1]], pa.int64()) for k in (0, 1)], schema=arrow)

        for b in batches:
            held = b.column(2)
            for k, (task, name) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)):
                if at is not None and task != at:
                    if len(ids) > 1:
                        yield solve()
                    ids, sets = [], []
                at = task
                ids.append(name)
                sets.append(np.frombuffer(held[k].as_buffer(), np.uint64))
        if len(ids) > 1:
            yield solve()

    return run


def near_duplicates(docs: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept, for every row."""
    signed = written(signatures(docs, settings, key, text), "signatures")
    held = signed.where("doc_id is not null and n_shingles > 0")
    classes = written(held.groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")).where("n > 1").select("h1", "h2", "rep"), "classes")
    member = written(signed.select("doc_id", "n_shingles", "h1", "h2").join(classes, ["h1", "h2"], "left").withColumn("rep", F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.coalesce("rep", "doc_id"))), "members")
    reps = member.where("doc_id = rep").select("doc_id", "h1", "h2").distinct()
    # a bucket's smallest id is the centre of its star
    banded = held.join(reps, ["doc_id", "h1", "h2"], "left_semi").select("doc_id", F.explode("bands").alias("bucket"))
    centres = banded.groupBy("bucket").agg(F.min("doc_id").alias("centre"), F.max("doc_id").alias("last")).where("centre < last").select("bucket", "centre")
    centres = written(centres, "centres")
    stars = banded.join(centres, "bucket").where("doc_id != centre").select(F.col("centre").alias("a"), F.col("doc_id").alias("b"))
    # a text hangs on the smallest of its centres only, and its other centres on that one too: connected as before, by
    # as many edges as texts and a few between centres
    hung = written(stars.groupBy("b").agg(F.min("a").alias("low"), F.collect_set("a").alias("every")), "stars")
    between = hung.select(F.col("low").alias("a"), F.explode(F.array_remove("every", F.col("low"))).alias("b")).distinct()
    candidates = components(hung.select(F.col("low").alias("a"), "b").unionByName(between))
    # blocks of each component
    sized = candidates.groupBy("component").count()
    dealt = candidates.join(sized, "component").select("node", "component", F.ceil(F.col("count") / settings.block).cast("int").alias("blocks"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    own = docs.select(F.col(key).cast("long").alias("node"), F.col(text).alias("text")).where("node is not null")

    def of_batch(cols: dict[str, list]) -> dict[str, list]:
        texts = [(t or "").encode() for t in cols["text"]]
        sets = [s.tobytes() for a, b in groups([len(t) for t in texts]) for s in shingle_sets(texts[a:b], settings.words)]
        return {"id": cols["node"], "component": cols["component"], "block": cols["block"], "blocks": cols["blocks"], "set": sets}

    sets = arrow_map(own.join(dealt.hint("merge"), "node").select("node", "component", "block", "blocks", "text"), "id long, component long, block int, blocks int, set binary", of_batch, 256)
    sets = written(sets, "sets")  # only of texts with candidates, and read in every round
    links = [solved(sets.where("blocks = 1").select(F.struct("component", F.lit(0).alias("i"), F.lit(0).alias("j")).alias("task"), "id", "set"), settings)]
    links += large_components(sets.where("blocks > 1"), settings)
    found = components(reduce(DataFrame.unionByName, links)).select(F.col("node").alias("rep"), "component")
    out = member.join(found, "rep", "left").select("doc_id", "n_shingles", F.coalesce("component", "rep", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def solved(tasks: DataFrame, settings: Settings) -> DataFrame:
    """Links within each task, from rows of task, id and set; a row may stand in many tasks."""
    return written(tasks.repartition("task").sortWithinPartitions("task").mapInArrow(_links(settings.percent), "a long, b long"), "links")


def large_components(sets: DataFrame, settings: Settings) -> list[DataFrame]:
    """Links that connect what is linked in components of several blocks, without meeting every pair of blocks."""
    pivots, links, rounds = sets.where("block = 0").select("id", "component", "blocks", F.lit(0).alias("i"), "set"), [], 0
    if sets.isEmpty():
        return links
    done = pivots.select("id")
    while True:
        # each block of pivots with each block, and in the first round each block by itself
        to = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j")
        asked = pivots.select("component", "i", to, "id", "set")
        blocks = pivots.select("component", "i").distinct()
        met = sets.withColumnRenamed("block", "j").join(blocks, "component").select("component", "i", "j", "id", "set")
        tasks = asked.unionByName(met).select(F.struct("component", "i", "j").alias("task"), "id", "set")
        links.append(solved(tasks, settings))
        # who is outside of the largest cluster and hasn't met all
        of = components(reduce(DataFrame.unionByName, links)).select(F.col("node").alias("id"), F.col("component").alias("cluster"))
        labelled = written(sets.select("id", "component", "blocks").join(of, "id", "left").withColumn("cluster", F.coalesce("cluster", "id")), "labelled")
        largest = labelled.groupBy("component", "cluster").count().groupBy("component").agg(F.max(F.struct("count", "cluster")).alias("top")).select("component", F.col("top.cluster").alias("top"))
        outside = labelled.join(largest, "component").where("cluster != top").join(done, "id", "left_anti")
        rounds += 1
        left = written(outside.select("id", "component"), "outside")
        if left.isEmpty():
            return links
        # as many of them as 2, 4, 8 ... blocks hold
        many = left.groupBy("component").agg(F.ceil(F.count("*") / settings.block).cast("int").alias("parts"))
        order = F.pmod(F.xxhash64("id", F.lit(rounds)), F.col("parts")).cast("int")
        chosen = left.join(many, "component").withColumn("i", order).where(F.col("i") < 2**rounds).select("id", "i")
        chosen = written(chosen, "pivots")
        done = done.unionByName(chosen.select("id"))
        pivots = sets.drop("block").join(chosen, "id").select("id", "component", "blocks", "i", "set")


def op7_near_duplicates(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), Settings(words=3, percent=85))
