"""The physical plans: what is read, what is shuffled, what leaves the JVM."""

import re

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.01"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plan_of(spark):
    return lambda name: plan(entry.queries()[name](spark, FOLDER))


@pytest.mark.parametrize("name", ["canonical_o", "canonical_m", "offers_all", "nav_hrefs", "kv_o"])
def test_row_wise_work_does_not_shuffle(plan_of, name):
    assert "Exchange" not in plan_of(name)


@pytest.mark.parametrize("name,readers", [("canonical_o", 1), ("canonical_m", 1), ("nav_hrefs", 1), ("heading_text", 1)])
def test_a_page_is_read_once(plan_of, name, readers):
    assert len(re.findall(r"ArrowEvalPython \[select\(", plan_of(name))) == readers


def test_only_page_selection_leaves_the_jvm(plan_of):
    assert len(re.findall("(Arrow|Batch)EvalPython", plan_of("offers_all"))) == 2  # one selection per site
    assert "Python" not in plan_of("wrapped_descriptions")


@pytest.mark.parametrize(
    "name", ["kv_o", "price_text_o", "description_chunks", "strip_styling", "json_scalars", "longest_script", "link_status"]
)
def test_cells_stay_in_the_jvm(plan_of, name):
    assert "Python" not in plan_of(name)


def test_diff_is_one_counted_shuffle_without_join(plan_of):
    text = plan_of("link_status")
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text
    assert "partial_sum" in text and "Generate" not in text


def test_scans_read_only_what_they_need(plan_of):
    text = plan_of("link_status")
    assert "o_totalprice" not in text and "l_comment" not in text
    assert "ReadSchema: struct<l_orderkey:bigint" in text


def test_no_cartesian_products(spark):
    for name in ("offers_deactivated", "registry_after_delete", "new_links", "stage_flags", "run_number"):
        text = plan(entry.queries()[name](spark, FOLDER))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
