"""The sample that op3 fits on is drawn from documents that have labels, not from labels that may have no document."""

import pytest

from glycotide.llm import quality


def test_labels_without_documents_do_not_fill_the_sample(spark):
    docs = spark.createDataFrame([(i, f"fine clear text {i % 5} " * 4 if i % 2 else f"junk $$$ !!! text {i % 5} " * 4) for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in [*range(40), *range(10_000, 14_000)]], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels, quality.grade_column(), 3, sample=100)
    assert model is not None
    kept = {r.doc_id for r in quality.keep_good(docs, model, least=2).collect()}
    assert kept == {i for i in range(40) if i % 2}


def test_no_model_is_said(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    with pytest.warns(UserWarning, match="no two grades among 1 labelled"):
        assert quality.fit(docs, labels, quality.grade_column(), 3) is None
