"""The pipeline and the registered queries of the subpackage."""

import hashlib

import oracle
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from millrace.llm import catalog, language

SF = "/root/testdata/sf0.001"


def test_queries_are_registered():
    names = entry_points.queries()
    assert [n for n in range(1, 11) if any(q.startswith(f"op{n}_") for q in names)] == [*range(1, 11)]
    assert "pipeline" in names and set(catalog.SQL) <= set(catalog.QUERIES)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(spark, name):
    found = oracle.spark_rows(entry_points.queries()[name](spark, SF))
    assert found == oracle.sql_rows(oracle.connect(SF), catalog.SQL[name])


def test_stages_take_effect(spark, odd_documents):
    plain = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for docs in (plain, odd_documents):
        before = docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, before, SF)
            rows = after.collect()
            assert after.columns == docs.columns
            assert [f.dataType for f in after.schema] == [f.dataType for f in docs.schema]
            before = spark.createDataFrame(rows, after.schema)
            kept[name, docs is plain] = rows
    assert {r.doc_id for r in kept["language", False]} >= {1, 4, 5, 6, None}
    assert not {r.doc_id for r in kept["language", False]} & {2, 3, 7, 9}
    assert 5 not in {r.doc_id for r in kept["near_dedup", False]}
    found = {r.doc_id: r for r in kept["near_dedup", False]}
    assert (found[1].score, found[1].row, found[1].kept) == ("y", 9, "z")
    texts = [r.text for r in kept["near_dedup", True]]
    assert len(texts) == len({hashlib.sha256(t.encode()).digest() for t in texts})
    passages = set()
    for r in sorted(kept["substring_dedup", True], key=lambda r: r.doc_id):
        words = r.text.split()
        own = {tuple(words[i : i + 50]) for i in range(len(words) - 49)}
        assert not own & passages
        passages |= own
    assert len(kept["secrets", True]) == len(kept["substring_dedup", True])
    assert all("token = " not in r.text for r in kept["secrets", True])


def test_clean_documents_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    told = corpus_pipeline.identify(spark, docs, SF)
    gone = docs.join(told.select("doc_id"), "doc_id", "left_anti").collect()
    assert all(not language.HAS_LETTER.search(r.text) or len(r.text) < 20 for r in gone)


def test_empty_tables(spark, no_documents):
    docs = no_documents
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
