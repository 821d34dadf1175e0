"""Plan-shape guarantees for every registered query: no Cartesian product or
nested-loop join, no Python stage, no partition count of its own, and scans
read only the columns they need."""

import pytest

import __spark_entry__ as E
from wordloom.plans import catalog
from tests.conftest import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInArrow", "MapInPandas", "REPARTITION_BY_NUM")


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_plan_shape(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # the permutation deals rows by the range of their hash, over the session's number of partitions
    for op in FORBIDDEN[:-1] if name == "shuffled_lines" else FORBIDDEN:
        assert op not in plan, f"{name}: {op}"


def test_scan_prunes_columns(spark):
    plan = E.queries()["word_sources"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema: struct<text:string>") == plan.count("ReadSchema") == 3  # the text column of three corpora, once each


def optimised(spark, name):
    return E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name, most", [("dataset_build", 2), ("vocab", 2), ("word_sources", 1), ("line_dedupe", 1), ("hebrew_common_words", 1)])
def test_documents_are_not_scanned_again_and_again(spark, name, most):
    assert sum("Relation [doc_id" in line and "source" in line for line in optimised(spark, name).splitlines()) <= most


@pytest.mark.parametrize("name, step, most", [("articles", "split(", 2), ("page_paragraphs", "split(", 4), ("dataset_build", "try_parse_json", 1)])
def test_texts_are_worked_on_once(spark, name, step, most):
    assert optimised(spark, name).count(step) <= most
