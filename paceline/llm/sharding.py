"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

A key's hash is a cell of the ring; each shard owns many virtual nodes, and a cell belongs to the first one clockwise.
A shard takes keys, in ring order, up to its capacity; those over it continue clockwise to the next virtual node, in
rounds, until a shard has room. Capacities differ by one at most and add up to the number of rows, so loads do too.

What is planned on the driver are the counts of the ring's cells, whose number is fixed (2^16), never rows. Rows are
numbered within their cell and joined to that plan. Equal rows are counted first, so a hot key is one row until the end.

Edge cases: null texts have size 16 and the checksum of nothing; a row with a null id is dealt by its other values;
repeated rows get slots of their own; an empty table gives no rows. Columns that aren't asked for are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CELLS = 1 << 16


def ring(shards: int, nodes: int) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node, clockwise."""
    return sorted((int.from_bytes(hashlib.sha256(f"{s}/{v}".encode()).digest()[:2], "big"), s) for s in range(shards) for v in range(nodes))


def capacities(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def place(counts: Sequence[tuple[int, int]], shards: int, nodes: int) -> list[tuple[int, int, int, int, int]]:
    """(cell, from, to, shard, first slot) for the keys of each cell, numbered from 0, with bounded loads."""
    points = ring(shards, nodes)
    room = capacities(sum(n for _, n in counts), shards)
    load, plan, at, pending = [0] * shards, [], 0, []
    for cell, n in sorted(counts):
        while at < len(points) and points[at][0] < cell:
            at += 1
        pending.append((cell, 0, n, at % len(points)))
    while pending:
        rest = []
        for cell, a, z, p in pending:
            shard = points[p][1]
            n = min(z - a, room[shard] - load[shard])
            if n:
                plan.append((cell, a, a + n, shard, load[shard]))
                load[shard] += n
            if a + n < z:
                rest.append((cell, a + n, z, (p + 1) % len(points)))
        pending = rest
    return plan


def deal(rows: DataFrame, shards: int, nodes: int = 64, key: str = "doc_id") -> DataFrame:
    """The rows with shard and slot, gapless from 0 in each shard; all columns of `rows` are part of a row's identity.

    Columns of the rows that are named shard or slot give way.
    """
    names = [c for c in rows.columns if c not in ("shard", "slot")]
    h = F.when(F.col(f"`{key}`").isNull(), F.xxhash64(*[F.col(f"`{c}`") for c in names])).otherwise(F.xxhash64(F.col(f"`{key}`")))
    cell = F.pmod("h", F.lit(CELLS)).cast("int").alias("cell")
    keyed = rows.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), h.alias("h"))
    counted = keyed.groupBy("row", "h").agg(F.count("*").alias("n")).select("row", "h", "n", cell)
    # one row for each cell: a fixed number, however many rows there are
    counts = [(r[0], r[1]) for r in keyed.groupBy(cell).count().collect()]
    plan = rows.sparkSession.createDataFrame(place(counts, shards, nodes), "cell int, since long, upto long, shard int, slot long")
    order = Window.partitionBy("cell").orderBy("h", "row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = counted.withColumn("end", F.sum("n").over(order)).withColumn("begin", F.col("end") - F.col("n"))
    # at most 2^16 cells and as many pieces again as shards were full
    met = numbered.join(F.broadcast(plan), "cell").where((F.col("begin") < F.col("upto")) & (F.col("since") < F.col("end")))
    at = F.explode(F.sequence(F.greatest("begin", "since"), F.least("end", "upto") - 1)).alias("at")
    fields = [F.col("row").getField(c).alias(c) for c in names]
    return met.select("row", "shard", "since", "slot", at).select(*fields, "shard", (F.col("slot") + F.col("at") - F.col("since")).alias("slot"))


def op4_bounded_ring(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = docs.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    out = deal(rows, 40)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
