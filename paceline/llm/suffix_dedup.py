"""Removal of byte strings that an earlier document holds, by refined suffix buckets.

A string of `length` bytes belongs to the bucket of one of its q-grams, the one with the least hash; equal strings
share it. Keys of buckets travel whole (64 bits), so the number of chunks and of groups has no limit short of 2^31. Four
passes over rows that hold as many contexts as a chunk and a group share; at many chunks that is one, and what is
shuffled is about three times the input:

1. Every text's buckets are counted; those with one document only are done. Copies of a whole text are found by digest.
2. Documents meet the buckets they share with others, chunk by chunk. Neighbouring strings of a bucket go out as one
   context of bytes, equal contexts of a chunk once. A very common bucket is cut finer, to whole strings.
3. Within a bucket, suffixes are refined by sorting on the bucket identifiers of later offsets: identifiers of 8 bytes
   make those of 16, these those of 32, and these the full length; a suffix alone in its bucket drops out. Each class
   that is left is compared byte for byte, so it is one string, and its smallest document is known.
4. Chunks get the smallest document of each context's strings back and cut what others hold.

A hot string costs a row of a blob for each chunk, not for each document, so no task grows with its copies.

Edge cases: null text is empty; documents shorter than `length` stay whole and are not shuffled; rows with a null id come after all others
and never remove from each other; repeated rows of an id never remove from each other; an empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written
from .textarrays import U, groups, mix

LAST = np.iinfo(np.int64).max
#: Kinds of replies to chunks: copies of whole texts, shared buckets, very common ones, and what to cut.
COPIES, SHARED, HOT, VERDICT = 0, 1, 2, 3
REPLY = "chunk int, kind int, blob binary, copies array<bigint>"
_COUNT = np.dtype([("key", "<u8"), ("chunk", "<u4"), ("n", "u1")])
_CONTEXT = np.dtype([("key", "<u8"), ("own", "<u4"), ("n", "u1"), ("low", "<i8"), ("high", "<i8")])
_VERDICT = np.dtype([("own", "<u4"), ("place", "u1"), ("n", "u1"), ("least", "<i8")])


@dataclass(frozen=True)
class Settings:
    """`chunk` and `hot` bound what a task holds: bytes of text, and documents of a bucket before it is cut finer."""

    length: int = 50
    gram: int = 16
    chunk: int = 8 << 20
    least_chunks: int = 64
    hot: int = 4096
    flush: int = 1_000_000
    parts: int = 4


def _unaligned(data: np.ndarray) -> np.ndarray:
    return np.ndarray((len(data) - 7,), "<u8", data.data, strides=(1,)).astype(np.uint64)


class Strings:
    """The strings of neighbouring texts: hashes of q-grams at each byte, and of each string its bucket's least one."""

    def __init__(self, texts: list[bytes], s: Settings):
        self.s, sizes = s, np.array([len(t) for t in texts])
        self.data = np.frombuffer(b"\n".join([*texts, b"\n" * (s.length + 8)]), np.uint8)
        self.start = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        u = _unaligned(self.data)
        g = u[: len(u) - s.gram + 8] * U(0x9E3779B97F4A7C15) ^ u[s.gram - 8 :] * U(0xC2B2AE3D27D4EB4F)
        g ^= g >> U(29)
        g *= U(0x165667B19E3779F9)
        self.gram = g ^ (g >> U(32))
        span, m, w = s.length - s.gram + 1, self.gram, 1
        while w * 2 <= span:
            m = np.minimum(m[:-w], m[w:])
            w *= 2
        if w < span:
            m = np.minimum(m[: len(m) - span + w], m[span - w :])
        self.least = m
        # runs of neighbouring strings with one bucket, within a text
        n = np.maximum(sizes - s.length + 1, 0)
        change = np.zeros(len(m) + 1, bool)
        change[1:-1] = m[1:] != m[:-1]
        change[self.start] = True
        valid = np.zeros(len(m) + 1, np.int8)
        np.add.at(valid, self.start, (n > 0).astype(np.int8))
        np.add.at(valid, self.start + n, -(n > 0).astype(np.int8))
        valid = np.cumsum(valid, dtype=np.int8) > 0
        edge = np.flatnonzero(change | np.diff(valid, prepend=False))
        edge = edge[valid[edge] | ((edge > 0) & valid[edge - 1])]
        own = valid[edge]
        self.a = edge[own]
        self.z = edge[np.flatnonzero(own) + 1] if len(edge) else edge
        self.of = np.searchsorted(self.start, self.a, side="right") - 1
        self.key = mix(m[self.a])

    def whole(self, at: np.ndarray) -> np.ndarray:
        """Hashes of the whole strings that start at these bytes."""
        q, n, out = self.s.gram, self.s.length, np.zeros(len(at), np.uint64)
        for off in [*range(0, n - q, q), n - q]:
            out = mix(out + self.gram[at + off])
        return out


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of keys, up to 2^31 of them; a key is always sent whole."""
    return ((key >> U(32)) * U(buckets) >> U(32)).astype(np.int64)


def _new(*columns: np.ndarray) -> np.ndarray:
    """Where a sorted table has another key than the row before."""
    out = np.ones(len(columns[0]), bool)
    if len(out):
        out[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return out


def _packed(data: np.ndarray, edges: np.ndarray) -> pa.Array:
    """Binary values that lie behind each other in `data`, between these edges."""
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype("<i4")), pa.py_buffer(np.ascontiguousarray(data).view(np.uint8))])


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of binary values behind each other, and their sizes."""
    data, sizes = [np.empty(0, np.uint8)], [np.empty(0, np.int64)]
    for part in column.cast(pa.binary()).chunks:
        if len(part):
            edges = np.frombuffer(part.buffers()[1], "<i4")[part.offset : part.offset + len(part) + 1]
            sizes.append(np.diff(edges))
            if edges[-1] > edges[0]:
                data.append(np.frombuffer(part.buffers()[2], np.uint8)[edges[0] : edges[-1]])
    return np.concatenate(data), np.concatenate(sizes)


def _records(column: pa.ChunkedArray, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """The records in binary values, and how many are in each."""
    data, sizes = _flat(column)
    return data.view(kind), sizes // kind.itemsize


def _replies(kind: int, chunk: np.ndarray, records: np.ndarray, kinds: np.ndarray | None = None) -> pa.Table:
    """One reply for each chunk (and kind) of sorted records."""
    own = np.full(len(chunk), kind) if kinds is None else kinds
    at = np.flatnonzero(_new(chunk, own))
    blob = _packed(records, np.append(at, len(chunk)) * records.dtype.itemsize)
    return pa.table([pa.array(chunk[at], pa.int32()), pa.array(own[at], pa.int32()), blob, pa.nulls(len(at), pa.list_(pa.int64()))], names=["chunk", "kind", "blob", "copies"])


def _count(s: Settings, buckets: int):
    """Pass 1, map side: bucket, blob of (key, chunk, documents)."""
    arrow = pa.schema([("bucket", pa.int32()), ("blob", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, chunks = [], []

        def flush() -> pa.RecordBatch:
            key, chunk = np.concatenate(keys), np.concatenate(chunks)
            order = np.lexsort((chunk, key))
            key, chunk = key[order], chunk[order]
            at = np.flatnonzero(_new(key, chunk))
            out = np.empty(len(at), _COUNT)
            out["key"], out["chunk"], out["n"] = key[at], chunk[at], np.minimum(np.diff(np.append(at, len(key))), 255)
            bucket = _bucket(out["key"], buckets)
            at = np.flatnonzero(_new(bucket))
            keys.clear()
            chunks.clear()
            return pa.RecordBatch.from_arrays([pa.array(bucket[at], pa.int32()), _packed(out, np.append(at, len(out)) * out.itemsize)], schema=arrow)

        for batch in batches:
            texts = batch.column(1).to_pylist()
            chunk = batch.column(0).to_numpy()
            for a, z in groups([len(t) for t in texts]):
                x = Strings(texts[a:z], s)
                order = np.lexsort((x.key, x.of))
                of, key = x.of[order], x.key[order]
                first = _new(of, key)
                keys.append(key[first])
                chunks.append(chunk[a:z][of[first]])
                if sum(map(len, keys)) >= s.flush:
                    yield flush()
        if sum(map(len, keys)):
            yield flush()

    return run


def _shared(s: Settings):
    """Pass 1, reduce side: chunk, blob of the buckets it shares with other documents; very common ones apart."""

    def run(table: pa.Table) -> pa.Table:
        found, _ = _records(table.column("blob"), _COUNT)
        found = found[np.lexsort((found["chunk"], found["key"]))]
        at = np.flatnonzero(_new(found["key"]))
        total = np.repeat(np.add.reduceat(found["n"].astype(np.int64), at), np.diff(np.append(at, len(found))))
        key, chunk, kind = found["key"][total > 1], found["chunk"][total > 1].astype(np.int64), np.where(total[total > 1] >= s.hot, HOT, SHARED)
        order = np.lexsort((key, kind, chunk))
        key, chunk, kind = key[order], chunk[order], kind[order]
        once = _new(chunk, kind, key)
        return _replies(SHARED, chunk[once], key[once], kind[once])

    return run


class Contexts:
    """A chunk's texts and the contexts of its shared strings, in one order however often this is computed.

    Copies of a whole earlier text have nothing to send and nothing left; they stand as empty.
    """

    def __init__(self, table: pa.Table, replies: pa.Table, s: Settings):
        of_kind = lambda k: replies.filter(pc.equal(replies.column("kind"), k)).column("blob")
        cold, hot = (np.sort(_records(of_kind(k), np.dtype("<u8"))[0]) for k in (SHARED, HOT))
        self.verdicts = _records(of_kind(VERDICT), _VERDICT)[0]
        copies = np.array([i for ids in replies.column("copies").to_pylist() for i in ids or ()], np.int64)
        texts = table.column("text").to_pylist()
        self.ids, self.sizes = table.column("doc_id").to_pylist(), np.array([len(t) for t in texts], np.int64)
        self.copy = np.isin(table.column("row").to_numpy(), copies)
        texts = [b"" if c else t for c, t in zip(self.copy, texts, strict=True)]
        docs = np.array([LAST if i is None else i for i in self.ids], np.int64)
        self.start = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
        self.data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        most = s.length + 1  # so that a context's first and last string cover it
        key, same, at, n, doc = [], [], [], [], []
        for a, z in groups([len(t) for t in texts]):
            x = Strings(texts[a:z], s)
            for kind, step in ((cold, most), (hot, 1)):
                k = np.minimum(np.searchsorted(kind, x.key), max(len(kind) - 1, 0))
                own = np.flatnonzero(kind[k] == x.key) if len(kind) else np.empty(0, np.int64)
                pieces = -(-(x.z[own] - x.a[own]) // step)
                run = np.repeat(own, pieces)
                first = x.a[run] + step * (np.arange(len(run)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
                size = np.minimum(x.z[run] - first, step)
                w = x.whole(first)
                key.append(x.key[run] if step > 1 else mix(w + U(1)))
                same.append(mix(w + mix(x.whole(first + size - 1)) + size.astype(np.uint64)))
                at.append(first + self.start[a])
                n.append(size)
                doc.append(docs[a:z][x.of[run]])
        key, same, at, n, doc = (np.concatenate(v) if v else np.empty(0, np.int64) for v in (key, same, at, n, doc))
        order = np.lexsort((doc, same))
        self.at, self.doc = at[order], doc[order]
        first = np.flatnonzero(_new(same[order]))
        self.bounds = np.append(first, len(order))
        self.key, self.n, self.first = key[order][first], n[order][first], self.at[first]
        self.low, self.high = self.doc[first], self.doc[self.bounds[1:] - 1] if len(first) else self.doc[:0]


def _spread(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each size, one after the other."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _send(s: Settings, buckets: int):
    """Pass 2: bucket, chunk, the heads of contexts and their bytes; cells of one context are as good as those of many."""
    arrow = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("head", pa.binary()), ("bytes", pa.binary())])

    def run(docs: pa.Table, replies: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return arrow.empty_table()
        chunk, c = docs.column("chunk")[0].as_py(), Contexts(docs, replies, s)
        own = np.argsort(c.key, kind="stable")
        size = c.n[own] + s.length - 1
        head = np.empty(len(own), _CONTEXT)
        head["key"], head["own"], head["n"], head["low"], head["high"] = c.key[own], own, c.n[own], c.low[own], c.high[own]
        data = c.data[np.repeat(c.first[own], size) + _spread(size)]
        bucket = _bucket(c.key[own], buckets)
        at = np.flatnonzero(_new(bucket))
        edges, ends = np.append(at, len(own)), np.concatenate([[0], np.cumsum(size)])
        return pa.Table.from_arrays([pa.array(bucket[at], pa.int32()), pa.array(np.full(len(at), chunk), pa.int32()), _packed(head, edges * head.itemsize), _packed(data, ends[edges])], schema=arrow)

    return run


def _confirmed(data: np.ndarray, at: np.ndarray, cls: np.ndarray, length: int) -> np.ndarray:
    """Classes in which all strings are equal byte for byte, from ones in which their identifiers are; `cls` is sorted."""
    head = np.flatnonzero(_new(cls))
    first, words = at[np.repeat(head, np.diff(np.append(head, len(cls))))], _unaligned(data)
    odd = np.zeros(len(at), bool)
    for off in [*range(0, length - 8, 8), length - 8]:
        odd |= words[at + off] != words[first + off]
    if not odd.any():
        return cls
    out, n = cls.copy(), int(cls.max())
    for c in np.unique(cls[odd]):
        strings: dict[bytes, list[int]] = {}
        for i in np.flatnonzero(cls == c):
            strings.setdefault(data[at[i] : at[i] + length].tobytes(), []).append(i)
        for members in strings.values():
            n += 1
            out[members] = n if len(members) > 1 else -1
    return out


def refine(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Classes of equal strings of `length` bytes that start at `at`; -1 where no other is equal.

    Bucket identifiers of 8 bytes at every offset give those of 16, and so on; suffixes are sorted on their bucket and
    the identifier at the next offset, and leave when they are alone.
    """
    out = np.full(len(at), -1, np.int64)
    if not len(at):
        return out
    ids, reach, offset = mix(_unaligned(data)), 8, 0
    live, bucket = np.arange(len(at)), np.zeros(len(at), np.uint64)
    while len(live):
        last = offset + reach >= length
        pair = mix(bucket + ids[at[live] + (length - reach if last else offset)])
        order = np.argsort(pair)
        p = pair[order]
        new = np.concatenate([[True], p[1:] != p[:-1]])
        number = np.cumsum(new)
        kept = (np.diff(np.append(np.flatnonzero(new), len(p))) > 1)[number - 1]
        live, bucket = live[order[kept]], p[kept]
        if last:
            out[live] = _confirmed(data, at[live], number[kept], length)
            break
        offset += reach
        if offset == 2 * reach and offset <= length:  # identifiers of twice the bytes, from the one at a later offset
            ids, reach = mix(ids[:-reach] + mix(ids[reach:])), offset
    return out


def _resolve(s: Settings):
    """Pass 3: chunk, blob of (context, first string, strings, smallest document) where something is to go."""

    def run(table: pa.Table) -> pa.Table:
        head, many = _records(table.column("head"), _CONTEXT)
        data, _ = _flat(table.column("bytes"))
        key, own, low, high, n = head["key"], head["own"], head["low"], head["high"], head["n"].astype(np.int64)
        chunk = np.repeat(table.column("chunk").to_numpy(), many).astype(np.int64)
        begin = np.cumsum(n + s.length - 1) - (n + s.length - 1)
        # contexts alone in their bucket, of one document, have nothing to meet
        order = np.argsort(key)
        new = _new(key[order])
        alone = np.empty(len(key), bool)
        alone[order] = (np.diff(np.append(np.flatnonzero(new), len(key))) == 1)[np.cumsum(new) - 1]
        todo = np.flatnonzero(~alone | (low != high))
        chunks, rows = [np.empty(0, np.int64)], [np.empty(0, _VERDICT)]
        for part in range(s.parts):  # equal keys stay together; only a part's arrays are in memory
            mine = todo[key[todo] % U(s.parts) == part]
            if not len(mine):
                continue
            size = n[mine] + s.length - 1
            piece = data[np.repeat(begin[mine], size) + _spread(size)]
            context = np.repeat(mine, n[mine])
            place = _spread(n[mine])
            least = low[context]
            cls = refine(piece, np.repeat(np.cumsum(size) - size, n[mine]) + place, s.length)
            met = np.flatnonzero(cls >= 0)
            order = met[np.argsort(cls[met], kind="stable")]
            if len(order):
                at = np.flatnonzero(_new(cls[order]))
                least[order] = np.repeat(np.minimum.reduceat(least[order], at), np.diff(np.append(at, len(order))))
            gone = least < high[context]
            head = gone & (_new(context, least) | ~np.append(False, gone[:-1]))
            tail = gone & np.append(head[1:] | ~gone[1:] | _new(context, least)[1:], True)
            h, t = np.flatnonzero(head), np.flatnonzero(tail)
            out = np.empty(len(h), _VERDICT)
            out["own"], out["place"], out["n"], out["least"] = own[context[h]], place[h], t - h + 1, least[h]
            chunks.append(chunk[context[h]])
            rows.append(out)
        at, out = np.concatenate(chunks), np.concatenate(rows)
        order = np.argsort(at, kind="stable")
        return _replies(VERDICT, at[order], out[order])

    return run


def _cut(s: Settings):
    """Pass 4: what is left of each text."""
    arrow = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])

    def run(docs: pa.Table, replies: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return arrow.empty_table()
        c = Contexts(docs, replies, s)
        which, place, n, least = c.verdicts["own"].astype(np.int64), c.verdicts["place"].astype(np.int64), c.verdicts["n"], c.verdicts["least"]
        copies = c.bounds[which + 1] - c.bounds[which]
        seen = np.repeat(c.bounds[which], copies) + _spread(copies)
        verdict = np.repeat(np.arange(len(which)), copies)
        later = c.doc[seen] > least[verdict]
        seen, verdict = seen[later], verdict[later]
        a = c.at[seen] + place[verdict]
        step = np.zeros(len(c.data) + 1, np.int32)
        np.add.at(step, a, 1)
        np.add.at(step, a + n[verdict].astype(np.int64) - 1 + s.length, -1)
        gone = np.cumsum(step, out=step)[:-1] > 0
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        removed, spans = (np.concatenate([[0], np.cumsum(v, dtype=np.int32)]) for v in (gone, begins))
        i, j = c.start[:-1], c.start[1:] - 1
        kept = [c.data[x:y][~gone[x:y]].tobytes() for x, y in zip(i, j, strict=True)]
        n_removed, n_spans = np.where(c.copy, c.sizes, removed[j] - removed[i]), np.where(c.copy, 1, spans[j] - spans[i])
        return pa.Table.from_arrays([pa.array(v, f.type) for v, f in zip((c.ids, c.sizes, n_removed, n_spans, kept), arrow, strict=True)], schema=arrow)

    return run


def remove_repeats(docs: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (the remaining bytes), for every row."""
    every = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.encode(F.col(text), "UTF-8"), F.lit(b"")).alias("text"))
    # a text without any string of the length has nothing to meet
    short = every.where(F.octet_length("text") < settings.length).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.col("text").alias("kept"))
    own = every.where(F.octet_length("text") >= settings.length)
    total = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(settings.least_chunks, -(-total // settings.chunk))
    buckets = 2 * chunks
    own = own.withColumn("row", F.xxhash64("doc_id", "text")).withColumn("chunk", F.pmod("row", F.lit(chunks)).cast("int"))
    # copies of whole texts, by a digest: all but those with the smallest id go
    digests = own.where("doc_id is not null").select("doc_id", "row", "chunk", F.unhex(F.md5("text")).alias("digest"))
    first = written(digests.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("digest", "first"), "first")
    copies = digests.join(first, "digest").where("doc_id > first").groupBy("chunk").agg(F.collect_set("row").alias("copies"))
    copies = copies.select("chunk", F.lit(COPIES).alias("kind"), F.lit(None).cast("binary").alias("blob"), "copies")
    counted = own.select("chunk", "text").mapInArrow(_count(settings, buckets), "bucket int, blob binary")
    shared = written(counted.groupBy("bucket").applyInArrow(_shared(settings), REPLY).unionByName(copies), "shared")
    sent = own.groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInArrow(_send(settings, buckets), "bucket int, chunk int, head binary, bytes binary")
    verdicts = sent.groupBy("bucket").applyInArrow(_resolve(settings), REPLY)
    cut = own.groupBy("chunk").cogroup(shared.unionByName(verdicts).groupBy("chunk")).applyInArrow(_cut(settings), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return cut.unionByName(short)


def op3_repeated_bytes(spark, sf_dir: str) -> DataFrame:
    out = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
