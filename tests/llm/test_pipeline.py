"""Registered queries against their SQL, and the pipeline stage by stage."""

import pytest
import sentencepiece
from oracle import compare, connect

import corpus_pipeline
from watchspan.llm.common import documents, stored
from watchspan.llm.queries import ORACLES, PIECES, QUERIES


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    result = compare(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name])
    assert result["ok"], result


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_one_row_for_each_document(spark, sf_dir, name):
    ids = sorted(r.doc_id for r in documents(spark, sf_dir).select("doc_id").collect())
    assert sorted(r.doc_id for r in QUERIES[name](spark, sf_dir).select("doc_id").collect()) == ids


def test_stages(spark, sf_dir):
    docs = documents(spark, sf_dir).limit(120)
    columns, sizes = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
        sizes.append(docs.select("doc_id").distinct().count())
        if name != "sentencepiece":
            assert docs.columns == columns
    assert sizes[0] >= sizes[1] >= sizes[2] == sizes[3] == sizes[4] > 0
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for r in docs.limit(20).collect():
        assert r.ids == sp.encode(r.text)


def test_stages_take_an_empty_table(spark, sf_dir):
    docs = documents(spark, sf_dir).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0


def test_run_equals_its_stages_on_planted_copies(spark, sf_dir, tmp_path):
    """run() on whole texts with hot copies, missing ids and texts: every decision is that of its operator, and nothing else goes."""
    import shutil

    from pyspark.sql import functions as F

    from watchspan.llm import language_id, toxicity
    from watchspan.llm.near_dedup import near_groups

    docs = documents(spark, sf_dir).limit(60)
    copies = docs.limit(1).select(*(F.col(c) for c in docs.columns if c != "doc_id"), F.explode(F.sequence(F.lit(10_000), F.lit(10_040))).alias("doc_id"))
    odd = spark.createDataFrame([(None, "words of a text without an id in plain English and then some more", "en", "x", 1), (20_000, None, "en", "x", 0)], docs.schema)
    whole = stored(docs.unionByName(copies).unionByName(odd), "planted")
    whole.write.parquet(str(tmp_path / "documents.parquet"))
    shutil.copy(f"{sf_dir}/labels.parquet", tmp_path / "labels.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")

    found = corpus_pipeline.run(spark, str(tmp_path))
    kept = whole
    scored = toxicity.score(kept, toxicity.train(kept, labels))
    kept = stored(scored.filter(F.col("toxic_score") < corpus_pipeline.LEAST_TOXIC).select(*docs.columns), "one")
    told = language_id.identify(kept, language_id.train(kept))
    kept = stored(told.filter((F.col("lang_pred") != "und") & (F.col("lang_score") >= corpus_pipeline.LEAST_LANGUAGE)).select(*docs.columns), "two")
    groups = {r.doc_id: r.component_id for r in near_groups(kept).collect()}
    want = {i for i, c in groups.items() if i == c}
    got = found.select("doc_id").distinct()
    assert {r.doc_id for r in got.collect()} == want
    assert len(want & set(range(10_000, 10_041))) <= 1
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = {r.doc_id: r.text for r in whole.collect()}
    for r in found.collect():
        assert r.text == texts[r.doc_id] and r.ids == sp.encode(r.text) and r.decoded == sp.decode(r.ids)
    per_row = found.groupBy("doc_id").count().agg(F.min("count")).first()[0]
    assert per_row >= 1
