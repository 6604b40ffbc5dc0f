"""The pipeline, stage by stage, and the registered queries' columns."""

import collections

import corpus_pipeline
from atlaspanel.llm import packing, quality, queries, simhash
from atlaspanel.llm.common import ranked, stored


def test_stages_keep_what_they_should(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    at = docs
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = at
        at = stored(stage(spark, before, sf), "test-stage")
        assert at.columns == docs.columns
        sizes.append(at.count())
        if name == "quality rules":
            verdict = {r.doc_id: r.kept for r in quality.assess(spark, before).collect()}
            assert {r.doc_id for r in at.collect()} == {k for k, v in verdict.items() if v}
        if name == "simhash near-dedup":
            groups = collections.Counter(r.component_id for r in simhash.near_duplicates(spark, before).collect())
            assert {r.doc_id for r in at.collect()} == set(groups)
    assert sizes[0] > sizes[1] > sizes[2] > 0 and sizes[3] <= sizes[2]
    packed = corpus_pipeline.STAGES[-1][1](spark, at, sf)
    pieces = packed.collect()
    assert collections.Counter(r.doc_id for r in pieces if r.piece == 0) == collections.Counter(r.doc_id for r in at.collect())


def test_stages_on_odd_documents(spark, clashing, no_docs, sf):
    for docs in (clashing, no_docs):
        at = docs
        for _, stage in corpus_pipeline.STAGES[:-1]:
            at = stored(stage(spark, at, sf), "test-odd")
            assert at.columns == docs.columns
        corpus_pipeline.STAGES[-1][1](spark, at, sf).collect()
    # each stage on all of them, not only on what the rules before it left
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, clashing, sf).collect()


def test_registered_names():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert len(corpus_pipeline.STAGES) == 5


def test_ranks_are_gapless(spark):
    df = spark.createDataFrame([(i * 7919 % 101, i) for i in range(500)], "a long, b long")
    got = sorted((r.a, r.b, r["rank"]) for r in ranked(df, ["a", "b"], "test-rank").collect())
    assert [r[2] for r in got] == list(range(500))
    assert ranked(df.limit(0), ["a"], "test-rank").count() == 0


def test_pieces_cut_first(spark):
    assert packing.cuts(1, 4) == [(0, 1)] and packing.cuts(4, 4) == [(0, 4)] and packing.cuts(9, 4) == [(0, 1), (1, 4), (5, 4)]
