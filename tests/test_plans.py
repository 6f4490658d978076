"""What the plans must look like, whatever the size of the data."""

import re

import pytest
from pyspark.sql import functions as F

from millrace.catalog import cleaning, joins, reports, streams, windows
from millrace.operators.reports import totals_by
from millrace.plans.reading import plan_steps, plan_text, pushed_filters, read_columns

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_filters_and_columns_reach_the_scan(spark):
    frame = cleaning.filter_gt(spark, SF)
    assert read_columns(frame) == [{"o_orderkey", "o_totalprice"}]
    assert "GreaterThan(o_totalprice,250000.0)" in pushed_filters(frame)[0]
    assert "EqualTo(p_type,PROMO)" in pushed_filters(cleaning.filter_eq(spark, SF))[0]
    assert "GreaterThan(p_size,25)" in pushed_filters(cleaning.filter_flag(spark, SF))[0]
    assert "GreaterThanOrEqual(c_acctbal,0.0)" in pushed_filters(cleaning.clean_lookup(spark, SF))[0]
    assert read_columns(windows.win_tumbling(spark, SF)) == [{"ts"}]
    assert read_columns(reports.word_count(spark, SF)) == [{"text"}]


def test_a_grouped_sum_is_partial_then_final(spark):
    steps = plan_steps(reports.partial_final(spark, SF))
    assert steps.count("HashAggregate") == 2
    assert steps.count("Exchange") == 1


def test_category_report_shuffles_keys_not_sales(spark, no_broadcast):
    report = cleaning.category_report(spark, SF)
    steps = plan_steps(report)
    # keys, lookup, categories
    assert steps.count("Exchange") == 3
    assert steps.count("HashAggregate") == 4
    below_join = plan_text(report).split("SortMergeJoin")[1]
    assert "partial_sum" in below_join or "HashAggregate" in below_join


def test_join_then_group_has_no_wider_shuffle(spark, no_broadcast):
    assert plan_steps(reports.join_then_group(spark, SF)).count("Exchange") == 3


def test_a_preview_keeps_n_rows_per_task(spark):
    assert "TakeOrderedAndProject" in plan_steps(reports.preview(spark, SF))


def test_row_comparison_is_one_shuffle(spark):
    steps = plan_steps(cleaning.row_differences(spark, SF))
    assert steps.count("Exchange") == 1
    assert not [s for s in steps if "Join" in s]


def test_no_query_plans_a_product(spark, no_broadcast):
    for module in (cleaning, reports, joins, windows):
        for name, query in module.QUERIES.items():
            steps = plan_steps(query(spark, SF))
            assert "CartesianProduct" not in steps, name
            if name != "join_band":
                assert "BroadcastNestedLoopJoin" not in steps, name


def test_final_plan_shows_after_an_action(spark):
    frame = totals_by(spark.range(100).withColumn("amount", F.col("id")), "id")
    frame.collect()
    assert "isFinalPlan=true" in plan_text(frame)


def test_schema_and_rows_can_be_shown(spark, capsys):
    frame = spark.range(2)
    frame.printSchema()
    frame.show(truncate=False)
    for mode in ("extended", "formatted"):
        assert "Physical Plan" in plan_text(frame, mode)
    assert "id: long" in capsys.readouterr().out


def test_no_python_in_any_plan(spark):
    for module in (cleaning, reports, joins, windows):
        for name, query in module.QUERIES.items():
            text = plan_text(query(spark, SF))
            assert not re.search("EvalPython|InPandas|InArrow", text), name


def test_caching_is_released(spark):
    frame = reports.cached_two_results(spark, SF)
    assert "InMemoryTableScan" not in plan_text(frame)
    kept = spark.range(10).groupBy().agg(F.sum("id")).cache()
    try:
        kept.collect()
        assert kept.is_cached and "InMemoryTableScan" in plan_text(kept)
    finally:
        kept.unpersist()
    assert not kept.is_cached


def test_every_stream_query_has_a_check():
    assert set(streams.QUERIES) == set(streams.SQL)
