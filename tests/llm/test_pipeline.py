"""The registered queries and the pipeline."""

import zlib

import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from entityloom.llm.common import stored
from entityloom.llm.queries import QUERIES, SQL
from tests.llm.conftest import LONG, SF


def test_every_operator_is_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry_points.queries()) and set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", ["op3_source_mix", "op5_line_dedup", "op7_fingerprints"])
def test_native_plans_hold_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "CartesianProduct" not in plan


def test_stages_keep_the_columns_and_clean_documents(spark, documents):
    docs, before = documents, documents.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stored(stage(spark, docs, SF))
        assert out.dtypes == docs.dtypes, name
        kept = out.select("doc_id").distinct()
        assert kept.join(docs, "doc_id", "left_anti").count() == 0
        if name == "quality":
            good = spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").join(docs, "doc_id").select("doc_id")
            assert good.join(kept, "doc_id", "left_anti").count() <= 0.03 * good.count()
        if name == "near_dedup":
            assert out.count() == kept.count()
        if name == "mixing":
            assert kept.count() == docs.count()
        docs = out
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert len(tokens) == docs.count() and all(r.round_trip and r.n_tokens == len(r.ids) for r in tokens)
    assert 0 < len({r.doc_id for r in tokens}) < before


def test_stages_take_odd_rows(spark, odd_docs, no_docs, tmp_path):
    spark.createDataFrame([(i, int(i != 12)) for i in range(16)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            assert name == "tokens" or out.columns == docs.columns
            out.count()
    lines = corpus_pipeline.drop_repeated_lines(spark, odd_docs, str(tmp_path)).collect()
    assert [r for r in lines if r.doc_id == 5] == [] and [r.n_chars for r in lines if r.doc_id == 9] == [len(LONG + " end")]
    kept = corpus_pipeline.drop_near_copies(spark, odd_docs, str(tmp_path)).collect()
    assert sum(r.doc_id == 0 for r in kept) == 1 and sum(not (r.text or "").split() for r in kept) == 1


def test_quality_keeps_all_without_bad_labels(spark, odd_docs, tmp_path):
    cases = {"none": ([], True), "good": ([(1, 1)], True), "held": ([(i, 0) for i in range(16) if zlib.crc32(str(i).encode()) % 4 == 2], True), "bad": ([(1, 0)], False)}
    for name, (labels, stay) in cases.items():
        spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
        out = corpus_pipeline.keep_quality(spark, odd_docs, f"{tmp_path}/{name}")
        assert out.columns == odd_docs.columns and out.count() == (odd_docs.count() if stay else 0), name
