"""The registered queries against their SQL, and the pipeline against its parts."""

import __spark_entry__ as driver
import corpus_pipeline
import pytest
from test_catalogue import SF_DIR, SPARK_TYPES, canonical, duck  # noqa: F401

from streamlog.llm import decontam, quality, queries


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, duck, name):  # noqa: F811
    result = queries.QUERIES[name](spark, SF_DIR)
    types = {column: SPARK_TYPES[str(kind)] for column, kind, *_ in duck.execute(queries.SQL[name]).description}
    assert dict(result.dtypes) == types
    expected, actual = duck.execute(queries.SQL[name]).fetchdf(), result.toPandas()
    assert len(expected) > 0
    assert canonical(actual) == canonical(expected)


def test_all_thirteen_and_the_pipeline_are_registered():
    names = list(driver.queries())
    assert [n for n in names if n.startswith("op")] == list(queries.QUERIES)
    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES] == list(range(1, 14))
    assert "pipeline" in names


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = docs
    counts = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, found, SF_DIR)
        assert found.columns == docs.columns and found.dtypes == docs.dtypes
        counts.append(found.count())
    assert counts[0] > counts[1] > counts[2] == counts[3] > counts[4] > 0
    assert found.filter("n_chars <> char_length(text)").count() == 0
    kept = {r.doc_id for r in found.collect()}
    packed = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id for r in packed} == kept
    assert not quality.quality(docs).filter("NOT kept").join(found, "doc_id", "left_semi").count()
    bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    assert not decontam.find_contamination(found, bench).count()


def test_pipeline_on_odd_and_no_documents(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        found = docs
        for _, stage in corpus_pipeline.STAGES[:-1]:
            found = stage(spark, found, SF_DIR)
            assert found.schema == docs.schema
        corpus_pipeline.STAGES[-1][1](spark, found, SF_DIR).collect()


def test_good_documents_are_kept(spark):
    """Labelled documents of good quality pass unless the base rules fail them."""
    judged = queries.op7_quality(spark, SF_DIR).join(spark.read.parquet(f"{SF_DIR}/labels.parquet"), "doc_id")
    good = judged.filter("quality = 1 AND NOT base_failed")
    assert good.filter("kept").count() >= 0.99 * good.count()
    bad = judged.filter("quality = 0")
    assert bad.filter("NOT kept").count() >= 0.5 * bad.count()
