"""What every operator does with nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from paceline.llm import chat, decontaminate, langid, line_dedup, media_jpeg, minhash, mixing, pii, sharding, suffix_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _h long, rep string, bucket string, h1 string"
LONG = "alpha beta gamma delta " * 20_000


@pytest.fixture(scope="module")
def odd(spark):
    texts = [(1, None), (2, ""), (3, "   \n\t"), (4, "one"), (5, LONG), (6, "twin text here, the very same words twice over and over again until fifty bytes"), (7, "twin text here, the very same words twice over and over again until fifty bytes"), (7, "twin text here, the very same words twice over and over again until fifty bytes"), (None, "no id here"), (None, None), (8, "Grüße! éèà 🙂 1.2.3.4 a@b.co"), (9, "12345 67890")]
    rows = [(i, t, None if i in (1, 4) else "en", None if i == 2 else "s", None, 1, "x", "y", "z") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def operators(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma delta alpha beta"), (2, "short"), (3, None), (None, "never seen words in this corpus at all")], "item_id long, text string")
    return {
        "decontaminate": lambda d: decontaminate.contaminated(d, items), "mixing": lambda d: mixing.mix_sources(d), "suffix": lambda d: suffix_dedup.remove_repeats(d, suffix_dedup.Settings(least_chunks=3)),
        "sharding": lambda d: sharding.deal(d, 4), "pii": lambda d: pii.find(d, pii.fit(d)), "langid": lambda d: langid.identify(d, langid.fit(d, F.lit(True))),
        "minhash": lambda d: minhash.near_duplicates(d), "jpeg": lambda d: media_jpeg.thumbnails(media_jpeg.store(d)), "lines": lambda d: line_dedup.dedup_lines(d), "clean": lambda d: decontaminate.clean(d, items),
        "identified": lambda d: langid.identified(d, langid.fit(d, F.lit(True))),
    }


NAMES = ("decontaminate", "mixing", "suffix", "sharding", "pii", "langid", "minhash", "jpeg", "lines", "clean", "identified")
ONE_FOR_ONE = ("suffix", "sharding", "pii", "langid", "minhash", "jpeg", "lines")


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(name, spark, odd):
    n = operators(spark)[name](odd).count()
    if name in ONE_FOR_ONE:
        assert n == odd.count()


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(name, spark, odd):
    assert operators(spark)[name](odd.limit(0)).count() == 0


def test_odd_suffixes(spark, odd):
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(odd, suffix_dedup.Settings(least_chunks=3)).collect()}
    assert (got[6].n_removed, got[7].n_removed, got[7].n_spans) == (0, 79, 1)
    assert bytes(got[7].kept) == b""
    assert got[5].n_removed == 0
    assert (got[1].n_bytes, got[2].n_bytes) == (0, 0)


def test_odd_near_duplicates(spark, odd):
    got = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(odd).collect()]
    assert (6, 11, 6, True) in got
    assert got.count((7, 11, 6, False)) == 2
    assert got.count((None, 1, None, True)) == 1
    assert got.count((None, 0, None, True)) == 1
    assert (1, 0, 1, True) in got
    assert (2, 0, 2, True) in got
    assert (4, 1, 4, True) in got


def test_odd_languages(spark, odd):
    got = {r.doc_id: r for r in langid.identify(odd, langid.fit(odd, F.lit(True))).collect()}
    for k in (1, 2, 3, 9):
        assert (got[k].lang_pred, got[k].score, got[k].rejected) == ("und", 0.0, True)
    assert got[5].lang_pred == "en"
    none = {r.lang_pred for r in langid.identify(odd, langid.fit(odd.where("lang is null"), F.lit(True))).collect()}
    assert none == {"und"}


def test_odd_lines(spark, odd):
    got = {r.doc_id: r for r in line_dedup.dedup_lines(odd).collect()}
    assert (got[1].text, got[1].n_lines) == (None, 0)
    assert (got[2].text, got[2].n_lines) == ("", 1)
    # a text of one line goes after its first occurrence; what has the id and text of another row is treated like it
    assert {k: r.n_removed for k, r in got.items() if r.n_removed} == {7: 1}
    assert [r.text for r in line_dedup.dedup_lines(odd).where("doc_id = 7").collect()] == ["", ""]


def test_odd_mixture(spark, odd):
    got = mixing.mix_sources(odd)
    assert set(got.columns) == {*odd.columns, "_tokens", "_weight", "_epoch", "_block"}
    assert got.where("_tokens < 0 or _tokens is null").count() == 0


def test_clashing_names_keep_their_values(spark):
    """Columns with the names that operators use inside come back as they were; those of their results give way."""
    inside = ("_h", "_n", "_from", "_to", "_slot", "_source", "_cell", "row", "h", "n", "cell", "end", "block", "tokens", "epochs", "rest", "weight", "t", "u", "node", "tie")
    rows = [(i, f"text of {i % 7}", f"s{i % 2}", i % 3, *[-7 - k for k in range(len(inside))], 99) for i in range(40)]
    df = spark.createDataFrame(rows, ["doc_id", "text", "source", "shard", *inside, "_block"]).repartition(3)
    want = {r.doc_id: tuple(r[c] for c in ("text", "source", *inside)) for r in df.collect()}
    value = lambda r: tuple(r[c] for c in ("text", "source", *inside))
    dealt = sharding.deal(df, 4)
    assert dealt.columns == [*[c for c in df.columns if c != "shard"], "shard", "slot"]
    got = dealt.collect()
    assert {r.doc_id: value(r) for r in got} == want
    assert sorted((r.shard, r.slot) for r in got) == [(s, k) for s in range(4) for k in range(10)]
    mixed = mixing.mix_sources(df)
    assert mixed.columns == [*[c for c in df.columns if c != "_block"], "_tokens", "_weight", "_epoch", "_block"]
    got = mixed.collect()
    assert all(value(r) == want[r.doc_id] and r["_tokens"] == 3 and r["_block"] == 0 and r.shard == r.doc_id % 3 for r in got)
    items = spark.createDataFrame([(1, "text of 3")], "item_id long, text string")
    kept = decontaminate.clean(df, items)
    assert kept.columns == df.columns
    assert {r.doc_id: value(r) for r in kept.collect()} == {k: v for k, v in want.items() if v[0] != "text of 3"}


def test_odd_tiles(spark, odd):
    got = decontaminate.contaminated(odd, spark.createDataFrame([(1, "alpha beta gamma delta alpha beta"), (2, "short")], "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id, r.coverage) for r in got] == [(5, 1, 1.0)]


def test_odd_chats(spark):
    rows = [(1, 0, "user", None), (1, None, None, "x"), (1, 1, "assistant", "a <|im_end|> b <\\| c <\\\\|"), (1, 1, "assistant", "a <|im_end|> b <\\| c <\\\\|"), (None, 0, "ro\nle\\n", ""), (2, 0, "assistant", LONG[:200_000])]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit("clash"))
    got = {r.conv_id: r for r in chat.digests(chat.format_chats(df, part=1000)).collect()}
    turns = "\nx\n" + "user\n\n" + ("assistant\n" + rows[2][3] + "\n") * 2
    assert (got[1].n_turns, got[1].turns_sha256) == (4, hashlib.sha256(turns.encode()).hexdigest())
    assert (got[1].loss_chars, got[1].loss_sha256) == (2 * len(rows[2][3]), hashlib.sha256((rows[2][3] * 2).encode()).hexdigest())
    assert got[None].turns_sha256 == hashlib.sha256(b"ro\nle\\n\n\n").hexdigest()
    assert got[2].loss_chars == 200_000
    assert chat.digests(chat.format_chats(df.limit(0))).count() == 0


def test_odd_media(spark, odd):
    got = media_jpeg.thumbnails(media_jpeg.store(odd)).where("error is not null")
    assert got.count() == 0
    bad = spark.createDataFrame([(1, None), (2, b""), (3, b"\xff\xd8\xff\xd9"), (4, media_jpeg.pack([b"x" * 192])[0][:-20])], "doc_id long, media binary")
    assert media_jpeg.thumbnails(bad).where("error is not null and width is null").count() == 4
