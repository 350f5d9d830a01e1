"""The pipeline: stages on small and odd tables, and their order."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from tests.llm.conftest import frame
from tests.llm.test_texts import prose
from tidalframe.llm import divergence, quality


@pytest.fixture
def tables(spark, tmp_path, odd_rows):
    """Documents: prose, marked junk, copies and a benchmark passage, beside the odd rows."""
    rng = random.Random(8)
    rows = [(1000 + k, prose(rng, 90)) for k in range(120)]
    rows += [(2000 + k, " ".join(w + "***" for w in prose(rng, 90).split())) for k in range(60)]
    rows += [(3000 + k, rows[k][1]) for k in range(10)]
    passage = prose(rng, 30)
    rows += [(4000, f"{rows[50][1]} {passage} {rows[51][1]}")]
    labels = [(k, int(k < 2000), 0) for k, _ in rows if k < 3000]
    frame(spark, rows + odd_rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), passage


def test_stages_one_after_another(spark, tables, tmp_path):
    root, passage = tables
    docs, held = spark.read.parquet(f"{root}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, root).write.parquet(f"{root}/out-{name}")
        docs = held[name] = spark.read.parquet(f"{root}/out-{name}")
        if name != "best_fit_packing":
            assert docs.columns == columns
    ids = {name: {r.doc_id for r in df.collect()} for name, df in held.items()}
    clean = {*range(1000, 1120), 4000}
    assert clean <= ids["quality_classifier"] and not ids["quality_classifier"] & set(range(2000, 2060))
    assert clean <= ids["quality_rules"]
    assert clean <= ids["near_duplicates"] and not ids["near_duplicates"] & set(range(3000, 3010))
    text = next(r for r in held["decontamination"].collect() if r.doc_id == 4000)
    assert passage[:-1] not in text.text and text.n_chars == len(text.text)
    assert {r.doc_id for r in held["best_fit_packing"].collect()} == ids["near_duplicates"] == {r.doc_id for r in corpus_pipeline.run(spark, root).collect()}


def test_each_stage_on_odd_and_empty_tables(spark, tables, odd, nothing):
    root, _ = tables
    for name, stage in corpus_pipeline.STAGES:
        out, n = stage(spark, odd, root), odd.count()
        want = {
            "quality_classifier": lambda: quality.quality_scores(odd, spark.read.parquet(f"{root}/labels.parquet")).filter("predicted = 1").count(),
            "quality_rules": lambda: divergence.quality_rules(odd).filter("kept").count(),
            "near_duplicates": lambda: n - 1,
            "decontamination": lambda: n,
        }
        if name == "best_fit_packing":
            assert out.filter("piece = 0").count() == n
        else:
            assert out.count() == want[name]()
        assert stage(spark, nothing, root).count() == 0
