"""Every stage of the corpus pipeline against a plain version, on its own input."""

import numpy as np
import pytest

import brute
import corpus_pipeline
from siltline.llm import packing, quality
from siltline.llm.common import table
from test_text import check_packing

STAGES = dict(corpus_pipeline.STAGES)
AWKWARD = [
    (70_001, None, None, None, None), (70_002, "", "en", "s", 0), (70_003, "one", "en", "s", 3), (None, "no id here", "en", None, 10),
    (70_004, "twice told " * 30, "en", "s", 330), (70_004, "twice told " * 30, "en", "s", 330), (70_004, "another text of that id", "de", "t", 23),
]


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.unionByName(spark.createDataFrame(AWKWARD, docs.schema))


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def same(df, want, schema):
    assert df.schema.simpleString() == schema.simpleString()
    assert sorted(pairs(df), key=str) == sorted(want, key=str)


def test_quality_stage(spark, docs, sf_dir):
    model, features = quality.fit(docs, table(spark, sf_dir, "labels")), quality.Features()
    want = [p for p in pairs(docs) if model.score(features(p[1])) >= 0.3]
    same(STAGES["quality classifier"](spark, docs, sf_dir), want, docs.schema)
    assert 0 < len(want) < docs.count()


def test_simhash_stage(spark, docs, sf_dir):
    rows = pairs(docs)
    groups = brute.simhash_groups(rows)
    want = {(i, t) for (i, t), g in zip(rows, groups, strict=True) if i == g}
    same(STAGES["SimHash near-dedup"](spark, docs, sf_dir), want, docs.schema)
    assert len(want) < len(rows)


def test_substring_stage(spark, docs, sf_dir):
    rows = pairs(docs)
    left = brute.substring_dedup(rows, 20)
    got = STAGES["substring dedup"](spark, docs, sf_dir)
    same(got, [(i, t) for (i, _), t in zip(rows, left, strict=True)], docs.schema)
    before = {(r.doc_id, r.text): r.n_chars for r in docs.collect()}
    for r in got.collect():
        assert r.n_chars == before.get((r.doc_id, r.text), len(r.text or ""))


def test_benchmark_stage(spark, docs, sf_dir):
    items = [(r.item_id, r.text) for r in table(spark, sf_dir, "benchmark").collect()]
    want = [p for p in pairs(docs) if not brute.contained([p], items)]
    same(STAGES["benchmark decontamination"](spark, docs, sf_dir), want, docs.schema)
    assert len(want) < docs.count()


def test_packing_stage(spark, docs, sf_dir):
    texts = {i: t for i, t in pairs(docs.where("doc_id < 70000"))}
    packed = STAGES["best-fit packing"](spark, docs.where("doc_id < 70000"), sf_dir).collect()
    encode = packing.encoder(**packing.public_vocabulary()).ids
    rows = []
    for r in packed:
        ids = encode(texts[r.doc_id] or "") + (2).to_bytes(4, "little")
        rows.append(r.asDict() | {"doc": r.doc_id, "ids": ids[4 * r.start : 4 * (r.start + r.length)]})
    bins, least = check_packing(rows, list(texts.items()))
    assert bins <= least + 1


def test_stages_take_empty_tables(spark, docs, sf_dir):
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs.limit(0), sf_dir)
        assert got.collect() == []
        if name != "best-fit packing":
            assert got.schema.simpleString() == docs.schema.simpleString()


def test_run_chains_the_stages(spark, sf_dir):
    packed = corpus_pipeline.run(spark, sf_dir).toPandas()
    ids = set(table(spark, sf_dir, "documents").toPandas().doc_id)
    assert 0 < packed.doc_id.nunique() < len(ids) and set(packed.doc_id) <= ids
    assert (packed.groupby("sequence_id").length.sum() <= 1024).all()
    assert np.all(packed.groupby("doc_id").piece.max() + 1 == packed.groupby("doc_id").piece.count())
