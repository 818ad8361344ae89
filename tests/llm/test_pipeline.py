import corpus_pipeline
from pyspark.sql import functions as F

from trendlens.llm import lines, packing, pii, quality, simhash
from trendlens.llm.common import BATCH_BYTES, BATCH_KEY, written

from .test_lines import brute as brute_lines
from .test_packing import verify
from .test_simhash import brute_components, brute_fingerprint


def test_stages_equal_brute_force(spark, documents):
    docs = documents.withColumn("spans", F.lit("clash")).withColumn("fp", F.lit(1))
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["quality_rules", "near_duplicates", "repeated_passages", "personal_data", "packing"]

    kept = written(stage["quality_rules"](spark, docs, ""), "t")
    assert kept.columns == docs.columns
    judged = {r.doc_id for r in quality.judge(docs, ["doc_id"]).filter("_q_kept").collect()}
    assert {r.doc_id for r in kept.collect()} == judged

    single = written(stage["near_duplicates"](spark, kept, ""), "t")
    rows = [(r.doc_id, brute_fingerprint(r.text)) for r in kept.collect()]
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(brute_components(rows)))

    cut = written(stage["repeated_passages"](spark, single, ""), "t")
    ordered = sorted((r.doc_id, r.text) for r in single.collect())
    assert sorted((r.doc_id, r.text) for r in cut.collect()) == sorted((d, x[1]) for (d, _), x in zip(ordered, brute_lines(ordered)))

    clean = written(stage["personal_data"](spark, cut, ""), "t")
    assert clean.columns == docs.columns
    again = pii.with_spans(clean, keep=["doc_id"])
    assert again.filter(F.size("_s_base") > 0).count() == 0
    assert clean.filter("n_chars <> length(text)").count() == 0

    tokens = packing.tokens_of(packing.default_tokenizer())
    verify([tuple(r) for r in stage["packing"](spark, clean, "").collect()], {r.doc_id: [*tokens.ids(r.text).tolist(), 0] for r in clean.collect()})


def test_odd_and_empty_tables(spark, odd):
    docs = odd
    for _, f in corpus_pipeline.STAGES[:-1]:
        docs = written(f(spark, docs, ""), "t")
        assert docs.columns == odd.columns
    empty = odd.limit(0)
    for name, f in corpus_pipeline.STAGES:
        assert f(spark, empty, "").count() == 0, name


def test_near_duplicates_keep_one_row_of_repeated_and_null_ids(spark):
    rows = [(None, "a b c d"), (None, "a b c d"), (3, "q r s t u"), (3, "q r s t u"), (4, "q r s t u"), (None, "q r s t u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((r.doc_id or 0, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())
    assert kept == [(0, "a b c d"), (3, "q r s t u")]


def test_run(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and {r.offset + r.length <= packing.WINDOW for r in rows} == {True}
    assert lines and simhash


def test_every_stage_bounds_its_batches(spark, documents):
    for _, stage in corpus_pipeline.STAGES:
        spark.conf.unset(BATCH_KEY)
        stage(spark, documents.limit(3), "")
        assert int(spark.conf.get(BATCH_KEY)) == BATCH_BYTES
    spark.conf.unset(BATCH_KEY)
