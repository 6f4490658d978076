from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.operators import cleaning, joins, quality, reports


def test_schema_differences(raw):
    assert quality.schema_differences(
        raw, "sale_id STRING, product_id STRING, amount_raw STRING, sold_at_raw STRING"
    ) == []
    found = quality.schema_differences(raw, "sale_id BIGINT, shop STRING, product_id STRING")
    assert "missing column shop" in found
    assert "unexpected column amount_raw" in found
    assert "column sale_id is string, not bigint" in found
    assert tuple(quality.input_summary(raw, raw.schema).first()) == (11, 0)


def test_lookup_problems(spark):
    rows = [("a",), ("a",), ("",), (None,), ("b",), ("",)]
    lookup = spark.createDataFrame(rows, "product_id STRING")
    assert tuple(quality.lookup_problems(lookup).first()) == (3, 2)
    assert quality.blank_keys(lookup).count() == 3
    assert {tuple(r) for r in quality.repeated_keys(lookup, "product_id").collect()} == {
        ("a", 2),
        ("", 2),
    }
    assert tuple(quality.lookup_problems(lookup.where("product_id = 'b'")).first()) == (0, 0)


def test_reconcile_and_reasons(raw):
    cleaned = cleaning.clean_sales(raw)
    assert tuple(quality.reconcile(cleaned).first()) == (11, 4, 7)
    found = {r.reject_reason: r.rejected_rows
             for r in quality.reasons(cleaning.rejected(cleaned)).collect()}
    assert found == {
        "missing product key": 2,
        "invalid or missing amount": 3,
        "invalid or missing timestamp": 2,
    }


def test_split_problems_sees_lost_and_repeated_rows(raw):
    cleaned = cleaning.clean_sales(raw)
    good, bad = cleaning.accepted(cleaned), cleaning.rejected(cleaned)
    assert quality.split_problems(raw, good, bad).isEmpty()
    lost = quality.split_problems(raw, good.where("sale_id <> 'a1'"), bad)
    assert [tuple(r) for r in lost.collect()] == [("a1", 1, 0, 0)]
    twice = quality.split_problems(raw, good.unionByName(good.where("sale_id = 'a2'")), bad)
    assert [tuple(r) for r in twice.collect()] == [("a2", 1, 2, 0)]


def test_population_and_totals(raw, products):
    good = cleaning.accepted(cleaning.clean_sales(raw))
    lookup = cleaning.clean_lookup(products)
    enriched = joins.enrich(good, lookup)
    assert tuple(quality.population(good, enriched).first()) == (0, 0, 0)
    inner = good.join(lookup.unionByName(lookup.where("category = 'tools'")), "product_id")
    assert tuple(quality.population(good, inner).first()) == (1, 0, 2)
    assert tuple(quality.population(inner, good).first()) == (0, 1, 2)
    kept = quality.totals_kept(enriched, reports.daily_totals(enriched)).first()
    assert kept["total_before"] == kept["total_after"] == Decimal("116.65")


def test_stored_once(spark):
    frame = spark.createDataFrame([("a",), ("b",), ("b",)], "sale_id STRING")
    assert tuple(quality.stored_once(frame).first()) == (3, 2, 1)


def test_row_differences_count_copies(spark):
    first = spark.createDataFrame([("a", 1), ("a", 1), (None, 2)], "k STRING, v INT")
    second = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "v INT, k STRING")
    found = {(r.k, r.v): r.surplus for r in quality.row_differences(first, second).collect()}
    assert found == {("a", 1): 1, (None, 2): -1}
    assert not quality.same_rows(first, second)
    assert quality.same_rows(first, first.orderBy(F.desc("v")).select("v", "k"))
    assert [tuple(r) for r in quality.surplus_rows(first, second).collect()] == [("a", 1)]
    with pytest.raises(ValueError):
        quality.row_differences(first, second.drop("v"))


def test_copies_of_a_hot_row_leave_through_many_tasks(spark):
    first = spark.range(200_000).select(F.when(F.col("id") < 150_000, -1).otherwise(F.col("id")).alias("k"))
    more = quality.surplus_rows(first, spark.createDataFrame([(-1,), (-1,), (150_001,)], "k BIGINT"))
    sizes = [r["count"] for r in more.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 199_997 and max(sizes) < 100_000
    assert more.where("k = -1").count() == 149_998


def test_totals_kept_sees_every_digit(spark):
    fine = spark.sql("SELECT CAST(1.004 AS DECIMAL(10,3)) AS amount")
    coarse = spark.sql("SELECT CAST(1.001 AS DECIMAL(12,4)) AS total")
    found = quality.totals_kept(fine, coarse).first()
    assert str(found["difference"]) == "0.0030"


def test_report_differences(spark):
    first = spark.createDataFrame([("x", 1), ("y", 2)], "category STRING, sales INT")
    assert quality.same_report(first, first.orderBy("category"))
    wrong = spark.createDataFrame([("x", 1), ("y", 3)], "category STRING, sales INT")
    assert {r.category for r in quality.report_differences(first, wrong).collect()} == {"y"}
    twice = first.unionByName(first)
    assert not quality.same_report(twice, twice), "a report has one row per category"
