"""The registered queries of the text operators against their SQL, and the pipeline."""

import os

import duckdb
import pytest

import corpus_pipeline
from basketry.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    result = con.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    want = sorted(map(repr, result.fetchall()))
    got = sorted(repr(tuple(r)) for r in QUERIES[name](spark, FOLDER).select(*columns).collect())
    assert got == want and got


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_runs(spark, name):
    """One row per document with its own id (found pairs for the decontamination, ranks for the search), and the same again."""
    first = sorted(map(repr, QUERIES[name](spark, FOLDER).collect()))
    again = sorted(map(repr, QUERIES[name](spark, FOLDER).collect()))
    assert first == again and first
    if name.split("_")[0] in ("op1", "op5", "op6", "op8"):
        ids = [r["doc_id"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
        assert len(first) == len(ids)


def test_benchmark_copies_are_found(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()
    want = {(d["doc_id"], b["item_id"]) for d in docs for b in items if b["text"] in d["text"]}
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op4_decontaminate"](spark, FOLDER).collect()}
    assert want <= got and len(got) <= len(want) + 1


def test_quality_agrees_with_given_labels(spark):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    scored = QUERIES["op8_weak_label_quality"](spark, FOLDER).join(labels, "doc_id")
    right = scored.where("kept = (quality = 1)").count()
    assert right >= 0.95 * scored.count()


def test_quality_drops_bad_documents_of_a_larger_table(spark):
    folder = FOLDER.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    counts = {(r["quality"], r["kept"]): r["count"] for r in QUERIES["op8_weak_label_quality"](spark, folder).join(labels, "doc_id").groupBy("quality", "kept").count().collect()}
    assert counts.get((0, False), 0) >= 0.95 * (counts.get((0, False), 0) + counts.get((0, True), 0)) > 0
    assert counts.get((1, True), 0) >= 0.98 * (counts.get((1, False), 0) + counts.get((1, True), 0))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.count()
        docs = stage(spark, docs, FOLDER)
        assert docs.count() <= before
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    assert corpus_pipeline.run(spark, FOLDER).count() == docs.count() > 0
    empty = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, FOLDER)
    assert empty.count() == 0
