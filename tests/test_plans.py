"""Scale properties of the physical plans (checked on sf0.001 tables)."""

import re

import pytest

import __spark_entry__ as entry
from parcelflow.operators.integrate import union_main_sub
from parcelflow.plans.queries import QUERIES
from parcelflow.sources.testdata import ck, tx
from tools.plan_summary import explain, summary

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plans(spark):
    return {name: explain(fn(spark, SF)) for name, fn in entry.queries().items() if name in QUERIES}


def test_no_python_in_any_query(plans):
    assert {name for name, text in plans.items() if summary(text)["python"]} == set()


def test_check_list_semi_join_pushed_into_both_union_branches(spark):
    t, todo = tx(spark, SF), ck(spark, SF).where("done_yn is null")
    main, sub = t.where("tx_date < '2000-01-01'"), t.where("tx_date >= '1999-12-01'")
    tree = explain(union_main_sub(main, sub, todo, ["city", "district"])).split("\n\n")[0]
    assert tree.count("LeftSemi") == 2
    assert tree.index("Union") < tree.index("LeftSemi")


def test_replace_keys_broadcast_to_anti_join(plans):
    assert re.search(r"BroadcastHashJoin LeftAnti BuildRight", plans["replace_by_key"])


def test_renumber_range_partitions_instead_of_per_key_window(plans):
    text = plans["renumber"]
    assert "rangepartitioning(city" in text
    # The only window runs over the small block table (partitioned by key, ordered by partition id).
    windows = re.findall(r"\(\d+\) Window\nInput \[\d+\]: \[(\w+)", text)
    assert windows == ["_pid"]


def test_month_range_reaches_scan(plans):
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate,1997-01-01", plans["period_filter"])


def test_column_pruning_on_wide_tables(plans):
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in plans["pk_violations"]
    assert "ReadSchema: struct<page_id:bigint,html:string>" in plans["visible_text"]


def test_queries_run_over_whole_tables(plans):
    for name, text in plans.items():
        tree = text.split("\n\n")[0]
        assert not re.search(r"GlobalLimit|LocalLimit|CollectLimit|TakeOrderedAndProject|\bSample\b", tree), name
