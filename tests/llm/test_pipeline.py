import plain
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from casegauge.llm import queries
from oracle import compare

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(spark, FOLDER, queries.QUERIES[name], queries.ORACLES[name]) == []


def test_all_operators_and_the_pipeline_are_registered():
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries()) and set(queries.ORACLES) <= set(entry.oracle_sql())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact", "near", "benchmark", "pieces"]


def test_stages_against_plain_versions(spark, documents, benchmark_items):
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality"](spark, documents, FOLDER).cache()
    assert kept.columns == documents.columns and documents.count() * 0.6 < kept.count() <= documents.count()
    kept = documents.where(F.col("doc_id") % 7 != 3)
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    exact = stages["exact"](spark, kept, FOLDER)
    assert exact.columns == documents.columns
    want = {i for i, (_, _, stays, _) in plain.exact(rows).items() if stays}
    assert sorted(r.doc_id for r in exact.collect()) == sorted(want)
    near = stages["near"](spark, kept, FOLDER)
    assert near.columns == documents.columns
    assert sorted(r.doc_id for r in near.collect()) == sorted(i for i, (_, _, stays) in plain.near(rows).items() if stays)
    items = [(r.item_id, r.text) for r in benchmark_items.collect()]
    cut = stages["benchmark"](spark, kept, FOLDER)
    assert cut.columns == documents.columns
    for r in cut.collect():
        old = dict(rows)[r.doc_id]
        assert (r.text == old) == (not any(plain.hit(old, items)[1]))
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for r in stages["pieces"](spark, kept, FOLDER).collect():
        assert r.ids == library.encode(dict(rows)[r.doc_id], add_eos=True) and r.n_tokens == len(r.ids) and r.exact


def test_stages_with_nulls_repeats_and_no_rows(spark, documents):
    odd = spark.createDataFrame([(None, None, None, None, None), (None, None, None, None, None), (-1, "", "en", "s", 0), (-2, "a b c", None, "s", 5),
                                 (-2, "a b c", None, "s", 5)], documents.schema)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, FOLDER)
        assert name == "pieces" or out.columns == documents.columns
        n = out.count()
        assert n == {"exact": 2, "near": 4}.get(name, n) and (name not in ("benchmark", "pieces") or n == 5)
        assert stage(spark, odd.limit(0), FOLDER).count() == 0


def test_run_is_the_stages_one_after_another(spark):
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.columns == ["doc_id", "n_tokens", "ids", "exact"]
    rows = got.collect()
    assert 50 < len(rows) == len({r.doc_id for r in rows})


def test_plans_without_products(spark):
    for name in ("op4_decontaminate", "op6_exact_dedup", "op8_substring_dedup", "op10_near_dedup"):
        plan = queries.QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "BatchEvalPython" not in plan, name
