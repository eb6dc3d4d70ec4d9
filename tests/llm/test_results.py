"""Results against brute force, exact round trips and held-out accuracy."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paceline.llm import boosting, chat, decontaminate, langid, line_dedup, media_jpeg, minhash, mixing, pii, queries, sharding, suffix_dedup, textarrays

from ..oracle import connection, same


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(name, spark, sf):
    same(queries.QUERIES[name](spark, sf), connection(sf), queries.ORACLES[name])


# 1: tiles


def greedy_tiles(a, b, least):
    """The definition: the longest match of unmarked words first, ties by place."""
    ua, ub, out = [w < 0 for w in a], [False] * len(b), 0
    while True:
        best = None
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and not ua[i + n] and not ub[j + n]:
                    n += 1
                if n >= least and (best is None or n > best[0]):
                    best = (n, i, j)
        if best is None:
            return out
        n, i, j = best
        ua[i : i + n] = ub[j : j + n] = [True] * n
        out += n


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40), st.lists(st.integers(0, 3), max_size=25), st.integers(2, 4))
def test_tiles_cover_like_greedy_string_tiling(a, b, least):
    got = decontaminate.tiles(a, b, least)
    for i, j, n in got:
        assert n >= least
        assert a[i : i + n] == b[j : j + n]
    for k in (0, 1):
        spans = sorted((t[k], t[k] + t[2]) for t in got)
        assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:], strict=False))
    # a tie may be broken otherwise, which may cost a short tile
    assert abs(sum(n for *_, n in got) - greedy_tiles(a, b, least)) <= 2 * least + 2


def test_reordered_passage_is_found(spark):
    words = [f"word{i}" for i in range(40)]
    item = " ".join(words)
    text = "Intro. " + " ".join(words[20:]).upper() + " -- between, other things -- " + " ".join(words[:20]) + "!"
    d = spark.createDataFrame([(1, text), (2, " ".join(words[:15])), (3, " ".join(words[::-1]))], "doc_id long, text string")
    b = spark.createDataFrame([(7, item)], "item_id long, text string")
    r = decontaminate.contaminated(d, b).collect()
    assert [(x.doc_id, x.item_id, x.n_tiles, x.coverage) for x in r] == [(1, 7, 2, 1.0)]
    blocks = decontaminate.contaminated(d, b.unionByName(b.withColumn("item_id", F.lit(8).cast("long")))).collect()
    assert sorted((x.doc_id, x.item_id) for x in blocks) == [(1, 7), (1, 8)]
    assert [x.doc_id for x in decontaminate.clean(d, b).orderBy("doc_id").collect()] == [2, 3]


def test_found_items_by_brute_force(spark):
    """Every pair of text and item whose greedy tiles cover enough, and no other, with common runs and reordered parts."""
    rng = random.Random(6)
    items = [(i, [f"w{rng.randrange(400)}" for _ in range(rng.choice([2, 4, 7, 12, 30, 60]))]) for i in range(24)]
    common = "this run of seven words is common".split()
    items = [(i, [*common, *w] if i % 3 == 0 else w) for i, w in items]
    docs_ = []
    for d in range(60):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randint(0, 60))] + (common if d % 2 else [])
        for _ in range(rng.randint(0, 3)):
            own = rng.choice(items)[1]
            cut, lost = rng.randrange(len(own)), rng.randrange(len(own))
            part = own[cut:] + (["other"] if rng.random() < 0.5 else []) + own[:cut]
            at = rng.randint(0, len(words))
            words[at:at] = part[lost:] if rng.random() < 0.4 else part
        docs_.append((d, words))
    want = set()
    for d, words in docs_:
        for i, own in items:
            code = {w: k for k, w in enumerate({*words, *own})}
            n = greedy_tiles([code[w] for w in words], [code[w] for w in own], min(5, len(own)))
            if n >= 0.6 * len(own):
                want.add((d, i, n))
    df = spark.createDataFrame([(d, ", ".join(w)) for d, w in docs_], "doc_id long, text string").repartition(3)
    b = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.n_covered) for r in decontaminate.contaminated(df, b).collect()}
    assert len(want) > 30
    assert got == want
    assert {r.doc_id for r in decontaminate.clean(df, b).collect()} == {d for d, _ in docs_} - {d for d, *_ in want}


def test_items_of_other_scripts_and_few_words(spark):
    items = [(1, "这是一个用来测试的句子，它没有空格。"), (2, "two plus two four"), (3, '"Don\'t stop," she said - and went on.'), (4, "ﬁne Ｆｕｌｌ width words here"), (5, "ภาษาไทยไม่มีช่องว่าง")]
    texts = ["前言。这是一个用来测试的句子，它没有空格。后记", "we say: Two plus two, four!", "x “Don’t stop,” she said — and went on. y", "fine full width words here", "คำนำ ภาษาไทยไม่มีช่องว่าง", "two plus four two", "这是另外一句话"]
    d = spark.createDataFrame(list(enumerate(texts, 1)), "doc_id long, text string")
    b = spark.createDataFrame([*items, (2, "two plus two four")], "item_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.contaminated(d, b).collect()) == [(1, 1), (2, 2), (2, 2), (3, 3), (4, 4), (5, 5)]


def test_runs_of_one_word_end(spark):
    import time

    began = time.time()
    assert sum(n for *_, n in decontaminate.tiles([1] * 2000, [1] * 200, 5)) == 200
    assert time.time() - began < 3


def test_bitmap_misses_no_seed():
    rng = np.random.default_rng(1)
    seeds = rng.integers(0, 1 << 64, 2000, dtype=np.uint64)
    for bits in (12, 26):
        slot = seeds >> np.uint64(64 - bits)
        words = np.zeros(1 << (bits - 6), np.uint64)
        np.bitwise_or.at(words, (slot >> np.uint64(6)).astype(np.int64), np.uint64(1) << (slot & np.uint64(63)))
        at = np.flatnonzero(words)
        b = decontaminate.Bitmap(at, words[at].view(np.int64), bits)
        assert b.has(seeds).all()
        assert b.has(rng.integers(0, 1 << 64, 2000, dtype=np.uint64)).mean() < 0.5


def test_benchmark_passages_are_found(spark, sf, docs):
    norm = lambda t: " ".join(re.findall(r"[^\W_]+", t.lower()))
    items = [(r.item_id, norm(r.text)) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = {(r.doc_id, i) for r in docs.collect() for i, t in items if f" {t} " in f" {norm(r.text)} "}
    got = {(r.doc_id, r.item_id) for r in queries.QUERIES["op1_string_tiling"](spark, sf).collect()}
    assert want
    assert want <= got


# 2: mixture


def test_exponent_meets_its_target():
    s = mixing.Settings()
    even, skewed = [100, 100, 100], [10_000, 500, 500]
    assert mixing.exponent(even, s) == 1
    a = mixing.exponent(skewed, mixing.Settings(entropy=0.9, repeats=100))
    q = mixing.weights([t / sum(skewed) for t in skewed], a)
    assert mixing.entropy(q) == pytest.approx(0.9 * np.log(3), abs=1e-9)
    a = mixing.exponent(skewed, mixing.Settings(entropy=1.0, repeats=2))
    q = mixing.weights([t / sum(skewed) for t in skewed], a)
    assert max(w * sum(skewed) / t for w, t in zip(q, skewed, strict=True)) == pytest.approx(2, abs=1e-6)
    assert mixing.exponent(skewed, mixing.Settings(entropy=1.0, repeats=0.5)) == 1


def test_weights_by_another_way(spark, docs):
    """The weights of the query from the definition: shares to a power on a fine grid, the last that keeps the entropy."""
    got = {r.source: r["_weight"] for r in mixing.mix_sources(docs).select("source", "_weight").distinct().collect()}
    tokens = {}
    for r in docs.collect():
        tokens[r.source] = tokens.get(r.source, 0) + len(re.findall(r"[^ \t\n\x0b\f\r]+", r.text))
    p = np.array([tokens[k] for k in sorted(tokens)]) / sum(tokens.values())
    want = None
    for a in np.linspace(0, 1, 20_001):
        q = p**a / (p**a).sum()
        if -(q * np.log(q)).sum() < 0.97 * np.log(len(p)) - 1e-12:
            break
        want = q
    assert max(want / p) < 4
    assert [got[k] for k in sorted(tokens)] == pytest.approx(list(want), abs=1e-4)


def test_mixture_by_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, "src" + str(0 if i % 3 else i % 7), " ".join(["w"] * rng.randint(0, 30))) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5)
    s = mixing.Settings(entropy=0.99, repeats=3.0, block=8)
    got = mixing.mix_sources(df, s).collect()
    tokens = {i: len(t.split()) for i, _, t in rows}
    assert all(r["_tokens"] == tokens[r.doc_id] for r in got)
    per = {}
    for i, n, _ in rows:
        per.setdefault(f"={n}", []).append(i)
    plan = {p[0]: p[1:] for p in mixing.plan({n: (sum(tokens[i] for i in ids), len(ids)) for n, ids in per.items()}, s)}
    for n, ids in per.items():
        weight, epochs, rest, blocks = plan[n]
        own = [r for r in got if "=" + r.source == n]
        for e in range(epochs):
            assert sorted(r.doc_id for r in own if r["_epoch"] == e) == ids
        part = [r for r in own if r["_epoch"] == epochs]
        assert len({r.doc_id for r in part}) == len(part)
        assert not [r for r in own if r["_epoch"] > epochs]
        size = sum(tokens[r.doc_id] for r in part)
        assert rest - 30 <= size <= rest
        assert {r["_block"] for r in own} <= set(range(blocks))
        # all blocks but one of the part are whole
        every = {}
        for r in mixing.mix_sources(df, mixing.Settings(entropy=0.0, block=8)).where(F.col("source") == n[1:]).collect():
            every.setdefault(r["_block"], set()).add(r.doc_id)
        held = {}
        for r in part:
            held.setdefault(r["_block"], set()).add(r.doc_id)
        assert sum(held[b] != every[b] for b in held) <= 1
        assert weight > 0


# 3: suffixes


def removed_by_definition(rows, n=50):
    first, out = {}, {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        gone = [False] * len(b)
        for j in range(len(b) - n + 1):
            if first.setdefault(b[j : j + n], i) < i:
                gone[j : j + n] = [True] * n
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out[i] = (len(b), sum(gone), sum(g and (j == 0 or not gone[j - 1]) for j, g in enumerate(gone)), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("settings_", [{}, {"hot": 2, "chunk": 20_000, "least_chunks": 7, "flush": 2000}])
def test_suffixes_by_definition(spark, docs, settings_):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows += [(10_000 + k, "ab" * 300 + str(k)) for k in range(3)] + [(10_010 + k, "x" * (49 + k)) for k in range(4)] + [(10_020, "é" * 60), (10_021, "é" * 60 + "!")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = suffix_dedup.remove_repeats(df, suffix_dedup.Settings(**settings_)).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    assert {r[0]: tuple(r)[1:] for r in out.collect()} == removed_by_definition(rows)


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=60, max_size=300), st.integers(8, 60))
def test_refined_classes_are_equal_strings(data, length):
    small = bytes(b % 3 for b in data)
    at = np.arange(len(small) - length + 1)
    got = suffix_dedup.refine(np.frombuffer(small, np.uint8), at, length)
    strings = [small[i : i + length] for i in at]
    for i in range(len(at)):
        assert (got[i] >= 0) == (strings.count(strings[i]) > 1)
    assert len({(c, s) for c, s in zip(got, strings, strict=True) if c >= 0}) == len({c for c in got if c >= 0}) == len({s for s in strings if strings.count(s) > 1})


def test_keys_stay_whole_with_many_buckets():
    """Every key that two documents share comes back as it was, with groups for 100 TB and beyond."""
    s = suffix_dedup.Settings(hot=3)
    rng = np.random.default_rng(0)
    keys = np.sort(rng.integers(0, 1 << 64, 3000, dtype=np.uint64, endpoint=False))
    for buckets in (128, 1 << 24, (1 << 31) - 1):
        bucket = suffix_dedup._bucket(keys, buckets)
        assert bucket.min() >= 0
        assert bucket.max() < buckets
        assert (np.diff(bucket) >= 0).all()
        found = {suffix_dedup.SHARED: set(), suffix_dedup.HOT: set()}
        for b in np.unique(bucket):
            own = np.repeat(keys[bucket == b], 3)
            rows = np.zeros(len(own), suffix_dedup._COUNT)
            rows["key"], rows["chunk"], rows["n"] = own, np.arange(len(own)) % 3, 1
            rows = rows[(np.arange(len(rows)) % 3 < 2) | (rows["key"] % np.uint64(2) == 0)]
            blob = suffix_dedup._packed(rows, np.array([0, len(rows) * rows.itemsize]))
            out = suffix_dedup._shared(s)(pa.table([pa.array([b], pa.int32()), blob], names=["bucket", "blob"]))
            for kind, value in zip(out.column("kind").to_pylist(), out.column("blob").to_pylist(), strict=True):
                found[kind] |= set(np.frombuffer(value, "<u8").tolist())
        assert found[suffix_dedup.HOT] == {k for k in keys.tolist() if k % 2 == 0}
        assert found[suffix_dedup.SHARED] == {k for k in keys.tolist() if k % 2}


def test_classes_are_confirmed_by_their_bytes():
    data = np.frombuffer(b"abcdefghijkl" * 2 + b"abcdefghijkX" + b"zzzzzzzzzzzz" * 2 + b"........", np.uint8)
    at, cls = np.array([0, 12, 24, 36, 48]), np.array([1, 1, 1, 1, 1])
    assert suffix_dedup._confirmed(data, at, cls, 12).tolist() == [2, 2, -1, 4, 4]
    assert suffix_dedup._confirmed(data, at[:2], cls[:2], 12).tolist() == [1, 1]


# 4: ring


def test_ring_is_balanced_and_moves_little(spark, docs):
    rows = docs.select("doc_id", F.length("text").alias("size"))
    a, b = (sharding.deal(rows, n).collect() for n in (8, 9))
    for got, n in ((a, 8), (b, 9)):
        sizes = np.bincount([r.shard for r in got], minlength=n)
        assert sizes.max() - sizes.min() <= 1
        assert sorted((r.shard, r.slot) for r in got) == [(s, k) for s in range(n) for k in range(sizes[s])]
    before = {r.doc_id: r.shard for r in a}
    assert np.mean([before[r.doc_id] != r.shard for r in b]) < 0.45  # dealt by remainder, 8 of 9 would move


def test_ring_by_brute_force():
    rng = random.Random(2)
    counts = [(c, rng.randint(1, 9)) for c in rng.sample(range(sharding.CELLS), 300)]
    plan = sharding.place(counts, 7, 5)
    points, room, load = sharding.ring(7, 5), sharding.capacities(sum(n for _, n in counts), 7), [0] * 7
    # one key at a time, in rounds: each asks the next virtual node clockwise of where it was turned away
    keys = [[c, k, next((i for i, p in enumerate(points) if p[0] >= c), 0)] for c, n in sorted(counts) for k in range(n)]
    want = {}
    while keys:
        rest = []
        for c, k, at in keys:
            s = points[at][1]
            if load[s] < room[s]:
                want[c, k] = s
                load[s] += 1
            else:
                rest.append([c, k, (at + 1) % len(points)])
        keys = rest
    assert {(c, k): s for c, a, z, s, _ in plan for k in range(a, z)} == want


def test_shard_columns_by_brute_force(spark, sf, docs):
    import zlib

    got = {r.doc_id: r for r in queries.QUERIES["op4_bounded_ring"](spark, sf).collect()}
    rows = docs.collect()
    assert set(got) == {r.doc_id for r in rows}
    for r in rows:
        raw, g = (r.text or "").encode(), got[r.doc_id]
        assert (g.size, g.text_crc32, g.law, g.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "rows", None)
    for s in range(40):
        assert sorted(g.slot for g in got.values() if g.shard == s) == list(range(len(rows) // 40 + (s < len(rows) % 40)))


def test_hot_key(spark):
    rows = spark.createDataFrame([(1, "same")] * 1000 + [(i, "x") for i in range(2, 50)], "doc_id long, text string")
    got = sharding.deal(rows, 5).groupBy("shard").agg(F.count("*").alias("n"), F.count_distinct("slot").alias("k"), F.max("slot").alias("m")).collect()
    assert {r.n for r in got} <= {209, 210}
    assert all(r.n == r.k == r.m + 1 for r in got)


# 5: personal data

_BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def by_pattern(text):
    out = {}
    for kind, pattern in _BASE.items():
        out[kind] = []
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))
            good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else 0, "card": 13 <= len(digits) <= 19 and total % 10 == 0, "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out[kind].append(m.span())
    return out


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="019a@.+- (é\n_", max_size=60))
def test_base_spans_are_those_of_the_patterns(text):
    assert pii.base_spans(text) == by_pattern(text)


def test_base_spans_of_documents(spark, sf, docs):
    got = {r.doc_id: r for r in queries.QUERIES["op5_personal_data"](spark, sf).collect()}
    seen = 0
    for r in docs.collect():
        want = by_pattern(r.text)
        line = ",".join(f"{k}:{a}:{z}" for k in pii.KINDS for a, z in want[k])
        assert got[r.doc_id].base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert set(filter(None, line.split(","))) <= set(got[r.doc_id].spans.split(","))
        seen += len(line) > 0
    assert seen


def test_added_spans_by_brute_force(spark, docs):
    """Added spans are the candidates over their kind's threshold that meet no base span nor a likelier one, by comparing all with all."""
    model = pii.fit(docs)
    texts = [r.text for r in docs.collect() if re.search("[0-9]", r.text)][:60] + ["call 555-123-4567 or (555) 123-4567, card 4111.1111.1111.1111", 'token = "9f86d081884c7d659a2feaa0c55ad015" jim [at] corp dot org']
    some = 0
    for t in texts:
        base = pii.base_spans(t)
        taken, want = [s for v in base.values() for s in v], []
        found = [c for c in pii.candidates(t) if not any(c[1] < z and a < c[2] for a, z in taken)]
        p = model.trees.predict(np.array([pii.features(t, *c) for c in found])) if found else []
        for q, (k, a, z) in sorted(zip(-np.array(p), found, strict=True), key=lambda x: (x[0], x[1][1], -x[1][2])):
            if -q >= model.cut[k] and not any(a < y and x < z for _, x, y in want):
                want.append((k, a, z))
        got = pii.select(t, base, model)
        assert sorted(got) == sorted(want)
        some += len(got)
    assert some


def test_long_texts_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 100_000, "+1" + "(" * 300_000, "1 " * 150_000):
        pii.base_spans(text)


def test_trees_learn_secrets(spark):
    rng = random.Random(1)
    hexes = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    rows = [(i, f'some words token = "{hexes()}" and more 12') for i in range(150)] + [(200 + i, f"commit {hexes()} was merged, see 1{i}") for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = pii.fit(df)
    new = [f'and api_key: "{hexes()}" there' for _ in range(20)], [f"revision {hexes()} there" for _ in range(20)]
    hit, miss = ([bool(pii.select(t, pii.base_spans(t), model)) for t in x] for x in new)
    assert sum(hit) >= 18
    assert sum(miss) == 0
    red = pii.find(spark.createDataFrame([(1, new[0][0] + " me@x.org")], "doc_id long, text string"), model).first().redacted
    assert red == 'and api_key: "<secret>" there <email>'


def test_small_tables_lose_no_kind(spark):
    """The same texts are redacted whether the table has many candidates, few, or many of other kinds only."""
    rng = random.Random(2)
    hexes = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    own = [(1, f'token = "{hexes()}" and more'), (2, "ask jane [at] mail dot example dot org"), (3, f"commit {hexes()} was merged")]
    numbers = [(10 + i, f"order {rng.randint(10**8, 10**9)} of +61 3 9{rng.randint(10**6, 10**7 - 1)}") for i in range(200)]
    for rows in (own, own + numbers):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got = {r.doc_id: r.redacted for r in pii.find(df, pii.fit(df)).collect()}
        assert [got[i] for i in (1, 2, 3)] == ['token = "<secret>" and more', "ask <email>", rows[2][1]]


def test_every_kind_is_found_and_look_alikes_are_not(spark, docs):
    """Precision and recall on what was held out, and on values written here, whatever the table."""
    model = pii.fit(docs)
    for kind in ("email", "phone", "card", "secret"):
        precision, recall = model.quality[kind]
        assert precision > 0.93
        assert recall > 0.85
    real = ["call 555-123-4567 now", "tel. (0161) 496 0123", "phone: 020 7946 0958 ok", "write to jim.b (at) corp [dot] com please", "visa 4111.1111.1111.1111 thanks", 'password="hT7xQ29bLm4WqZ81nVk3"', "api_key: 9f86d081884c7d659a2feaa0c55ad015"]
    other = ["order 123456789 shipped", "dated 2024-05-16 12.30", "invoice no. 20240516", "isbn 978-3-16-148410-0", "commit 9f86d081884c7d659a2feaa0c55ad015a3bf4f1b", "tracking 4111 1111 1111 1112", "we met [at] 10.30", "path /usr/share/python312/lib"]
    hit, miss = ([bool(pii.select(t, pii.base_spans(t), model)) for t in x] for x in (real, other))
    assert sum(hit) >= 6
    assert sum(miss) <= 1


def test_boosting_and_threshold():
    rng = np.random.default_rng(0)
    x = rng.random((600, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    p = boosting.Boosted().fit(x[:400], y[:400]).predict(x[400:])
    assert ((p > 0.5) == y[400:]).mean() > 0.9
    assert boosting.threshold(np.array([0.9, 0.8, 0.7]), np.array([1, 1, 0]), 0.99) == 0.8
    assert boosting.threshold(np.array([0.9]), np.array([0]), 0.5) == 2.0


# 6: languages


def test_held_out_languages(spark, sf, docs):
    got = queries.QUERIES["op6_language_centroids"](spark, sf).join(docs, "doc_id").where("held_out")
    n = got.count()
    assert n > 30
    assert got.where("lang_pred = lang").count() / n > 0.97
    assert got.where("rejected and n_chars > 20").count() <= 0.005 * n
    assert got.where("score < 0 or score > 1").count() == 0


def test_what_is_no_language_is_rejected(spark, docs):
    """Of junk and of languages never seen nearly all is rejected, of known ones nearly nothing, at every length."""
    model = langid.fit(docs, langid.remainder() != 1)
    assert model.passed.min() > 0.95
    rng = random.Random(9)
    latin = "abcdefghijklmnopqrstuvwxyz"
    junk = [bytes(rng.randrange(256) for _ in range(200)).hex() for _ in range(20)]
    junk += [" ".join("".join(rng.choice(latin) for _ in range(rng.randint(2, 9))) for _ in range(40)) for _ in range(20)]
    junk += ["これは日本語の文章です。" * 9, "Η γλώσσα είναι ένα σύστημα επικοινωνίας " * 6, "for (int i = 0; i < n; ++i) { x[i] = foo(bar, baz); } // " * 4]
    assert np.mean(langid.predict(junk, model, langid.Settings())[2]) > 0.95
    known = [r.text for r in docs.where(langid.remainder() == 1).collect() if len(r.text) > 20]
    assert np.mean(langid.predict(known, model, langid.Settings())[2]) < 0.01


def test_any_number_of_languages(spark):
    """1,200 languages are all learned; more than allowed raise; without labels nothing is dropped."""
    rng = random.Random(3)
    words = {k: ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(12)] for k in range(1200)}
    rows = [(5 * k + j, f"l{k:04}", " ".join(rng.choice(words[k]) for _ in range(20))) for k in range(1200) for j in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(4)
    s = langid.Settings(dims=1 << 10, clusters=1)
    model = langid.fit(df, F.lit(True), s)
    assert len(model.langs) == 1200
    got = langid.identify(df, model, s).join(df, "doc_id")
    assert got.where("lang_pred = lang").count() > 0.95 * len(rows)
    with pytest.raises(ValueError, match="languages"):
        langid.fit(df, F.lit(True), langid.Settings(most_languages=1199))
    none = df.withColumn("lang", F.lit(None).cast("string"))
    assert langid.identified(none, langid.fit(none, F.lit(True))).count() == len(rows)


# 7: near-duplicates


def components_by_definition(rows, k, percent):
    sets = {}
    for i, t in rows:
        w = re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode().translate(bytes(c + 32 if 65 <= c < 91 else c for c in range(256))))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    where = {}
    for i in ids:
        for s in sets[i]:
            where.setdefault(s, []).append(i)
    for i in ids:
        for j in {x for s in sets[i] for x in where[s] if x > i}:
            n = len(sets[i] & sets[j])
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize(("k", "percent", "block"), [(3, 85, 128), (5, 80, 128), (3, 85, 4)])
def test_components_by_definition(spark, docs, k, percent, block):
    rng = random.Random(3)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for g in range(6):  # groups of near copies around the threshold, short and long
        words = [f"g{g}w{i}" for i in range((12, 30, 60, 70, 120, 300)[g])]
        for c in range(25):
            own = list(words)
            for _ in range(rng.randint(0, max(1, len(words) // 60))):
                own[rng.randrange(len(own))] = f"e{rng.random()}"
            rows.append((10_000 + 100 * g + c, " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df, minhash.Settings(words=k, percent=percent, block=block)).collect()}
    assert got == components_by_definition(rows, k, percent)


def test_large_components_cost_in_proportion(spark, monkeypatch):
    """Sets that are sent for different, near-identical texts of one component: twice the texts, about twice the rows."""
    sent, solved = [], minhash.solved

    def counted(tasks, settings):
        sent[-1] += tasks.count()
        return solved(tasks, settings)

    monkeypatch.setattr(minhash, "solved", counted)
    for n in (500, 1000):
        rng = random.Random(n)
        rows = []
        for i in range(n):
            words = [f"w{k}" for k in range(60)]
            words[rng.randrange(60)] = f"e{i}"
            rows.append((i, " ".join(words)))
        sent.append(0)
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        got = minhash.near_duplicates(df, minhash.Settings(words=3, percent=85, block=16))
        assert got.where("kept").count() == 1
    assert sent[0] < 12 * 500
    assert sent[1] < 2.5 * sent[0]


def test_densified_values_agree_like_the_sets():
    rng = np.random.default_rng(4)
    agree = []
    for _ in range(60):
        both, a, b = (np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (160, 20, 20))
        x, y = (minhash.one_permutation(np.unique(np.concatenate([both, s])), 192) for s in (a, b))
        agree.append((x == y).mean())
    assert np.mean(agree) == pytest.approx(160 / 200, abs=0.02)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB \n\té", max_size=12), max_size=5))
def test_word_hashes_tell_words_apart(texts):
    h, of = textarrays.word_hashes([t.encode() for t in texts])
    low = bytes(c + 32 if 65 <= c < 91 else c for c in range(256))
    want = [(i, w) for i, t in enumerate(texts) for w in re.findall(rb"[^\x20\x09-\x0d]+", t.encode().translate(low))]
    assert of.tolist() == [i for i, _ in want]
    assert len(set(zip(h.tolist(), [w for _, w in want], strict=True))) == len(set(h.tolist())) == len({w for _, w in want})


# 8: media


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=900), min_size=1, max_size=5))
def test_media_round_trip(payloads):
    own = [media_jpeg.padded(p) for p in payloads]
    assert [p for p, *_ in media_jpeg.unpack(media_jpeg.pack(own))] == own


def plain_jpeg(dc, h, v, interval, apart=False):
    """A JPEG written bit by bit: one luminance and one chroma component, DC only, all codes four bits; in one scan, or chroma first in one of its own."""
    rows, cols = len(dc), len(dc[0])
    out = bytearray(b"\xff\xd8")

    def segment(marker, body):
        out.extend(bytes([0xFF, marker]) + (len(body) + 2).to_bytes(2, "big") + body)

    segment(0xDB, b"\0" + b"\4" * 64)
    segment(0xC0, b"\x08" + (rows * 8).to_bytes(2, "big") + (cols * 8).to_bytes(2, "big") + b"\x02" + bytes([1, h << 4 | v, 0, 2, 0x11, 0]))
    for kind in (0, 0x10):
        segment(0xC4, bytes([kind, 0, 0, 0, 12, *[0] * 12]) + bytes(range(12)))
    if interval:
        segment(0xDD, interval.to_bytes(2, "big"))
    bits, last, n = "", 0, 0

    def flush():
        nonlocal bits
        bits += "1" * (-len(bits) % 8)
        out.extend(b"".join(bytes([x]) + b"\0" * (x == 255) for x in (int(bits[i : i + 8], 2) for i in range(0, len(bits), 8))))
        bits = ""

    def block(diff):
        nonlocal bits
        size = abs(diff).bit_length()
        bits += f"{size:04b}" + (f"{diff if diff > 0 else diff + (1 << size) - 1:0{size}b}" if size else "") + "0000"

    if apart:
        segment(0xDA, b"\x01\x02\x00\x00\x3f\x00")
        for k in range(-(-rows // v) * -(-cols // h)):
            if interval and k and k % interval == 0:
                flush()
                out.extend(bytes([0xFF, 0xD0 + (k // interval - 1) % 8]))
            block(0)
        flush()
    segment(0xDA, b"\x01\x01\x00\x00\x3f\x00" if apart else b"\x02\x01\x00\x02\x00\x00\x3f\x00")
    if apart:
        h = v = 1
    for y in range(0, rows, v):
        for x in range(0, cols, h):
            if interval and n and n % interval == 0:
                flush()
                out.extend(bytes([0xFF, 0xD0 + (n // interval - 1) % 8]))
                last = 0
            for j in range(v):
                for i in range(h):
                    block(dc[y + j][x + i] - last)
                    last = dc[y + j][x + i]
            if not apart:
                block(0)
            n += 1
    flush()
    return bytes(out) + b"\xff\xd9"


@pytest.mark.parametrize("apart", [False, True])
@pytest.mark.parametrize(("h", "v", "interval"), [(1, 1, 0), (2, 2, 0), (2, 1, 2), (1, 2, 1)])
def test_thumbnails_of_other_encoders(h, v, interval, apart):
    rng = random.Random(h * 10 + v)
    dc = [[rng.randint(-200, 200) for _ in range(6)] for _ in range(4)]
    f = media_jpeg.parse(plain_jpeg(dc, h, v, interval, apart))
    grey = media_jpeg.thumbnail(f, media_jpeg.decode([f])[0])
    assert (f.width, f.height) == (48, 32)
    assert grey.tolist() == [[max(0, min(255, (x * 4 + 4) // 8 + 128)) for x in row] for row in dc]


def test_media_columns_by_brute_force(spark, sf, docs):
    """Every column of the query from the text and the stored form, image by image; equal texts have equal values."""
    import zlib

    got, seen = {r.doc_id: r for r in queries.QUERIES["op8_jpeg_columns"](spark, sf).collect()}, {}
    rows = docs.collect()
    assert set(got) == {r.doc_id for r in rows}
    for r in rows:
        raw, g = (r.text or "").encode(), got[r.doc_id]
        own = raw + b" " * (max(-(-len(raw) // 192), 1) * 192 - len(raw))
        media = media_jpeg.pack([own])[0]
        frame = media_jpeg.parse(media)
        grey = media_jpeg.thumbnail(frame, media_jpeg.decode([frame])[0])
        assert (g.n_bytes, g.payload_bytes, g.payload_sha256, g.tail_crc32) == (len(raw), len(own), hashlib.sha256(own).hexdigest(), zlib.crc32(own[-16:]))
        assert (g.media_bytes, g.media_sha256, g.feature) == (len(media), hashlib.sha256(media).hexdigest(), media_jpeg.feature(frame, grey))
        assert seen.setdefault(own, g.media_sha256) == g.media_sha256


def test_progressive_is_refused():
    data = media_jpeg.pack([b" " * 192])[0].replace(b"\xff\xc0", b"\xff\xc2")
    with pytest.raises(ValueError, match="not baseline"):
        media_jpeg.parse(data)


# 9: lines


def lines_by_definition(rows, n, alone=None):
    seen, out = set(), {}
    for i, t in sorted(rows):
        lines = t.split("\n")
        gone = [False] * len(lines)
        runs = [("run", j, n) for j in range(len(lines) - n + 1)]
        if alone is not None:
            runs += [("line", j, 1) for j, x in enumerate(lines) if len(x.encode()) >= alone]
            runs += [("text", 0, len(lines))] if len(lines) < n and t else []
        for kind, j, m in runs:
            key = kind, tuple(lines[j : j + m])
            if key in seen:
                gone[j : j + m] = [True] * m
            seen.add(key)
        out[i] = ("\n".join(x for x, g in zip(lines, gone, strict=True) if not g), sum(gone), sum(g and (j == 0 or not gone[j - 1]) for j, g in enumerate(gone)))
    return out


@pytest.mark.parametrize(("gram", "window", "alone"), [(1, 4, None), (2, 2, None), (1, 1, None), (2, 4, 2), (1, 4, 2), (1, 5, 1)])
def test_lines_by_definition(spark, gram, window, alone):
    rng = random.Random(gram * 10 + window)
    rows = [(i, "\n".join(rng.choice(["a", "b", "c", "dd", ""]) for _ in range(rng.randint(1, 24)))) for i in range(80)]
    for i in range(20):  # copies of stretches, moved and inside one text
        lines = rows[i][1].split("\n")
        rows.append((100 + i, "\n".join([f"own {i}", *lines[i % 3 : 12], "x", *lines[4:], *lines[: i % 9]])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.text, r.n_removed, r.n_runs) for r in line_dedup.dedup_lines(df, line_dedup.Settings(gram, window, alone)).collect()}
    assert got == lines_by_definition(rows, gram + window - 1, alone)


def test_fewer_positions_than_lines(spark):
    """Of random lines, two of `window + 1` windows select another one; each window belongs to one selected position."""
    rng = random.Random(4)
    rows = [(i, 0, [str(rng.random()) for _ in range(200)]) for i in range(20)]
    got = line_dedup.minima(spark.createDataFrame(rows, "doc long, same long, lines array<string>"), line_dedup.Settings(alone=None)).collect()
    assert len(got) == pytest.approx(0.4 * 200 * 20, rel=0.1)
    assert sum(len(r.runs) for r in got) == 197 * 20
    for i in range(20):
        own = sorted((r.at, len(r.runs)) for r in got if r.doc == i)
        assert [a for a, _ in own] == list(np.cumsum([0, *(n for _, n in own[:-1])]))


def test_passages_of_few_lines(spark):
    """A long line without a repeated neighbour and a short text go after their first occurrence; empty and short ones stay."""
    long, other = "a long line of many words " * 4, "x" * 100
    rows = [(1, f"a\n{long}\nb"), (2, f"c\n{long}\nd\n{other}"), (3, long), (4, "short"), (5, "short"), (6, ""), (7, ""), (8, "e\nshort\n\nf"), (9, f"{other}\ng\n{other}"), (10, f"a\n{long}\nh"), (11, "p\nq"), (12, "p\nq")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.text, r.n_removed, r.n_runs) for r in line_dedup.dedup_lines(df, line_dedup.Settings(alone=100)).collect()}
    want = dict(rows) | {2: f"c\nd\n{other}", 3: "", 5: "", 9: "g", 10: "a\nh", 12: ""}
    assert {k: v[0] for k, v in got.items()} == want
    assert [got[k][1:] for k in range(1, 13)] == [(0, 0), (1, 1), (1, 1), (0, 0), (1, 1), (0, 0), (0, 0), (0, 0), (2, 2), (1, 1), (0, 0), (2, 1)]


def test_null_texts_in_lines_and_sql(spark, tmp_path):
    import duckdb

    rows = [(1, None), (2, "a\nb\nc\nd"), (3, "x\na\nb\nc\nd"), (4, ""), (5, "only"), (6, "only")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    same(queries.QUERIES["op9_line_winnowing"](spark, str(tmp_path)), con, queries.ORACLES["op9_line_winnowing"])


def test_native_plans_hold_no_python(spark, sf):
    for name in ("op4_bounded_ring", "op9_line_winnowing"):
        plan = queries.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas", plan)


# 10: chats


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="<|\\im_endstar>\n x", max_size=40))
def test_escapes_round_trip(text):
    assert chat.unescape(chat.escape(text)) == text
    assert chat.unescape_role(chat.escape_role(text)) == text
    assert "<|" not in chat.escape(text)
    ids, mask = chat.encode_turn("assistant", text, chat.TOKENIZER)
    _, start, end = chat.encoding(chat.TOKENIZER)
    assert (ids == start).sum() == (ids == end).sum() == 1
    assert mask.sum() == len(ids) - len(chat.encode_turn("assistant", "", chat.TOKENIZER)[0])


@pytest.mark.parametrize("text", ["some words, and 12 numbers!\n\n  here " * 2700, "a" * 100_000, ("x" * 997 + "'s  \t\n ") * 100, "naïve 日本 🙂\u00a0\u2003  y" * 6000, "<|" * 40_000])
def test_long_texts_get_the_tokenizers_own_ids(text):
    enc, _, _ = chat.encoding(chat.TOKENIZER)
    assert chat.encode(text, enc) == enc.encode_ordinary(text)
    ids, mask = chat.encode_turn("assistant", text, chat.TOKENIZER)
    assert ids[mask > 0].tolist() == enc.encode_ordinary(chat.escape(text))
