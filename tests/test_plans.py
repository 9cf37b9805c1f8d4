"""Plan shape of every batch query: no cross join, no Python stage, row limits pushed below the shuffle."""

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")
#: Folds that rest on the decisions before them run in Python over sorted rows; of the dealt operators these four are DataFrame code alone.
FOLDS, NATIVE = ("T2_can_afford", "W3_drop_reuploads"), ("op1_", "op2_", "op10_", "op13_")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in entry.queries() if not n.endswith("_stream")])
def test_no_cross_join_and_no_python(spark, name):
    p = plan(entry.queries()[name](spark, FOLDER))
    free = name.startswith(FOLDS) or name == "pipeline" or (name.startswith("op") and not name.startswith(NATIVE))
    assert not [k for k in FORBIDDEN + (() if free else ("MapInArrow", "FlatMapGroupsInArrow")) if k in p]


@pytest.mark.parametrize("name", ["W1_newest_n", "W2_newest_n_where", "S7_search_recent", "W4_fill_budgets", "A1_performance", "W11_bounded_long_count"])
def test_row_limits_are_applied_before_the_shuffle(spark, name):
    lines = plan(entry.queries()[name](spark, FOLDER)).splitlines()
    partial = [i for i, line in enumerate(lines) if "WindowGroupLimit" in line and "Partial" in line]
    assert partial and any("Exchange hashpartitioning" in line for line in lines[: partial[0]])


def test_metrics_shuffle_items_once_per_entity(spark):
    p = plan(entry.queries()["A6_upload_frequency"](spark, FOLDER))
    assert p.count("Exchange hashpartitioning") == 1


def test_filters_and_columns_reach_the_scan(spark):
    p = plan(entry.queries()["S7_search_recent"](spark, FOLDER))
    assert "GreaterThanOrEqual(o_orderdate" in p and "o_totalprice" not in p.split("ReadSchema")[1]
    day = plan(entry.queries()["A11_added_on"](spark, FOLDER))
    assert "GreaterThanOrEqual(ts" in day and "props" not in day.split("ReadSchema")[1]


def test_the_contact_chain_reads_its_texts_once(spark):
    p = plan(entry.queries()["F28_resolve_contact"](spark, FOLDER))
    assert p.count("FileScan parquet") == 1 and "WindowGroupLimit" in p
