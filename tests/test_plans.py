"""Plan shapes that matter at scale, read from the optimised physical plans."""

import re

import pytest

import __spark_entry__ as E
from quarry.plans import catalog

SF = "/root/testdata/sf0.01"


def plan(spark, name):
    df = E.queries()[name](spark, SF)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_cross_or_python(spark, name):
    p = plan(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                "PythonRDD", "applySchemaToPythonRDD"):
        assert bad not in p, (name, bad)


def test_year_filter_reaches_scan(spark):
    p = plan(spark, "q_revenue_by_category")
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate,1998-01-01", p)
    assert re.search(r"PushedFilters: \[[^\]]*LessThan\(o_orderdate,1999-01-01", p)


def test_scans_read_only_needed_columns(spark):
    p = plan(spark, "q_category_sales_and_score")
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int>" in p
    p = plan(spark, "q_docs_per_lang")
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in p  # the text column is never read


def test_top_k_limits_before_shuffle(spark):
    p = plan(spark, "q_top_words").split("\n\n")[0]
    # a partial WindowGroupLimit sits below the exchange that feeds the window
    assert re.search(r"Exchange[^\n]*\n\s*\+- WindowGroupLimit", p)


def test_fact_aggregated_before_dimension_join(spark):
    p = plan(spark, "q_item_rating_stats").split("\n\n")[0]
    lines = p.splitlines()
    join = next(i for i, ln in enumerate(lines) if "Join" in ln)
    assert any("HashAggregate" in ln for ln in lines[join + 1:])  # aggregation below the join


def test_stop_list_broadcast(spark):
    assert "BroadcastHashJoin LeftAnti" in plan(spark, "q_frequent_words")


def test_report_reads_its_facts_and_sorts_once(spark):
    for name, table in (("q_group_report_lines", "events"), ("q_year_report_lines", "orders")):
        tree = plan(spark, name).split("\n\n")[0]
        assert tree.count("Scan parquet") - tree.count("customer") <= 2, name
        text = plan(spark, name)
        assert len(re.findall(rf"Location: [^\n]*/{table}\.parquet", text)) == 1, name
        assert text.count("rangepartitioning") == 1, name


def test_titles_join_the_summed_groups(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tree = plan(spark, "q_item_by_group_long_titled").split("\n\n")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # one full shuffle of the ratings (for the user join); the rest carries (item, group) sums
    assert len(re.findall(r"Join", tree)) == 2
    below = tree[tree.rindex("Join"):]
    assert "HashAggregate" not in below
