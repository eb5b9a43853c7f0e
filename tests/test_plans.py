"""Plans: what reaches the scan, what limits before the exchange, and that no pairs are crossed."""

import os

import pytest

from colloqua.plans import dealt_queries, reference_queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("module", [dealt_queries, reference_queries])
def test_nothing_is_crossed(spark, module):
    for name, query in module.QUERIES.items():
        if name.startswith("stream_") or name.endswith("_roundtrip"):
            continue
        text = plan(query(spark, FOLDER))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_copies_are_dropped_before_the_exchange(spark):
    text = plan(dealt_queries.p4_found(spark, FOLDER))
    assert text.index("row_number(), 1, Final") < text.index("row_number(), 1, Partial")


def test_scans_read_what_they_need(spark):
    text = plan(reference_queries.dedup_keep_first(spark, FOLDER))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text
    text = plan(reference_queries.msg_clean_filter(spark, FOLDER))
    assert "EqualTo(type_name,text)" in text and "talker" not in text


def test_only_the_missing_subpackage_is_passed_over(monkeypatch):
    import importlib

    import __spark_entry__ as entry

    def without(name):
        def load(_):
            raise ModuleNotFoundError(name=name)
        monkeypatch.setattr(importlib, "import_module", load)

    without("colloqua.llm")
    assert set(entry.queries()) == {n for m in (dealt_queries, reference_queries) for n in m.QUERIES}
    without("colloqua.functions.text")
    with pytest.raises(ModuleNotFoundError):
        entry.queries()
