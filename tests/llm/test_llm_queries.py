"""The registered training-data queries and the pipeline, on the smallest tables."""

import checker
import corpus_pipeline
import pytest

from riskscan.llm import queries

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, taken string"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    assert checker.compare(queries.QUERIES[name](spark, SF_DIR), checker.connect(SF_DIR), queries.ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES) - {"pipeline"}))
def test_query_has_a_row_for_every_row(spark, name):
    table = "pages" if name.startswith("op3") else "documents"
    found = queries.QUERIES[name](spark, SF_DIR)
    key = "page_id" if table == "pages" else "doc_id"
    assert found.select(key).distinct().count() == spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()


def test_stages_take_effect_and_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = spark.createDataFrame(stage(spark, before, SF_DIR).collect(), docs.schema)
        assert after.columns == docs.columns
        assert {r[0] for r in after.select("doc_id").collect()} <= {r[0] for r in before.select("doc_id").collect()}
        before = after
        if name == "near_dedup":
            groups = queries.simhash.near_duplicates(after)
            assert groups.select("component_id").distinct().count() == after.count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, before, SF_DIR).collect()
    assert {r["doc_id"] for r in pieces} == {r["doc_id"] for r in before.collect()}
    whole = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(map(str, whole.collect())) == sorted(map(str, pieces))


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None, "x"), (1, None, None, "a", 0, None), (1, "", "en", None, 0, "x")]])
def test_stages_on_odd_tables(spark, rows):
    docs = spark.createDataFrame(rows, DOCS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).columns == docs.columns
        stage(spark, docs, SF_DIR).collect()
    corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
