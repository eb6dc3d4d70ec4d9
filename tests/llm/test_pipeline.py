"""The pipeline: each stage's decisions take effect on all that the one before kept."""

from __future__ import annotations

import re

import pytest

import corpus_pipeline

from .test_results import components_by_definition


@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    for k, (_, f) in enumerate(corpus_pipeline.STAGES):
        at = str(tmp_path_factory.mktemp("stage") / str(k))
        f(spark, docs, sf).write.parquet(at)
        docs = spark.read.parquet(at)
        out.append(docs)
    return out


def test_columns(spark, sf, stages):
    names = spark.read.parquet(f"{sf}/documents.parquet").columns
    assert all(s.columns == names for s in stages[:-1])
    assert stages[-1].columns == [*names, "shard", "slot"]


def test_stages_by_brute_force(spark, sf, stages):
    held = spark.read.parquet(f"{sf}/documents.parquet").collect()
    first = {r.doc_id for r in stages[0].collect()}
    assert first <= {r.doc_id for r in held}
    assert {r.doc_id for r in held if len(r.text) > 60} <= first
    known = [(r.doc_id, r.text) for r in held if r.doc_id in first]
    comps = components_by_definition(known, 5, 80)
    second = {r.doc_id for r in stages[1].collect()}
    assert second == {i for i, (_, c) in comps.items() if i == c}
    norm = lambda t: " " + " ".join(re.findall(r"[^\W_]+", t.lower())) + " "
    items = [norm(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    third = {r.doc_id for r in stages[2].collect()}
    texts = {i: norm(t) for i, t in known if i in second}
    assert third == {i for i, t in texts.items() if not any(x in t for x in items)}
    assert {r.doc_id for r in stages[3].collect()} <= third
    last = stages[4].collect()
    assert len(last) == stages[3].count()
    sizes = [sum(r.shard == s for r in last) for s in range(corpus_pipeline.SHARDS)]
    assert max(sizes) - min(sizes) <= 1


def test_run_equals_its_stages(spark, sf, stages):
    got = corpus_pipeline.run(spark, sf)
    assert got.exceptAll(stages[-1]).count() == 0
    assert got.count() == stages[-1].count()


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and names that stages use inside."""
    texts = [(1, None), (2, ""), (3, "  "), (4, "one"), (5, "alpha beta gamma delta " * 20_000), (None, "no id here at all"), (None, None), (11, "the same words again, twice over"), (12, "the same words again, twice over"), (12, "the same words again, twice over")]
    rows = [(i, t, None if k % 3 == 0 else "en", None if k % 4 == 0 else "s", None, k, k, "x", "y", 5) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _h long, _source long, rep string, kept string, _block int").repartition(3)


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
def test_odd_rows(stage, spark, sf, odd):
    name, f = corpus_pipeline.STAGES[stage]
    names = odd.columns
    empty = f(spark, odd.limit(0), sf)
    assert empty.count() == 0
    out = f(spark, odd, sf)
    assert out.columns == (names if stage < 4 else [*names, "shard", "slot"])
    given, got = [tuple(r) for r in odd.collect()], [tuple(r)[: len(names)] for r in out.collect()]
    assert set(got) <= set(given)
    ids = sorted((g[0] or 0, g[1] or "") for g in got)
    if name == "language ID":  # without a letter there is no language
        assert [i for i, t in ids if t.strip() == ""] == []
    if name == "near-dedup":
        assert [i for i, _ in ids if i in (11, 12)] == [11]
        assert len(got) == len(given) - 2
    if name in ("decontamination", "sharding"):
        assert sorted(map(str, got)) == sorted(map(str, given))
    if name == "mixing":
        assert {4, 5, 11} & {i for i, _ in ids}


def test_unlabelled_documents_stay(spark, sf, odd):
    none = odd.selectExpr("*").drop("lang").selectExpr("*", "cast(null as string) as lang")
    assert corpus_pipeline.language_id(spark, none, sf).count() == odd.count()
