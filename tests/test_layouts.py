"""Buckets, periods, mergeable counts, histories, running totals, chained windows."""

import glob
import os
import random

from pyspark.sql import functions as F

from millrace.operators import distinct, history, joins, running
from millrace.plans.reading import plan_text
from millrace.scratch import fresh_folder
from millrace.sinks import layouts


def test_a_bucketed_join_has_no_exchange(spark):
    left = spark.range(1000).select((F.col("id") % 50).alias("k"), F.col("id").alias("v"))
    right = spark.range(40).select(F.col("id").alias("k"), F.lit("x").alias("w"))
    name = fresh_folder(spark, "t").rsplit("/", 1)[1].replace("-", "_")
    one = layouts.write_bucketed(left, f"{name}_l", "k", 4)
    other = layouts.write_bucketed(right, f"{name}_r", "k", 4)
    joined = layouts.bucketed_join(one, other, "k")
    assert joined.count() == 1000 and joined.where("w IS NULL").count() == 200
    plan = plan_text(layouts.bucketed_join(one, other, "k"))
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    grouped = plan_text(one.groupBy("k").count())
    assert "Exchange" not in grouped


def stamps(folder):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{folder}/**/*.parquet", recursive=True)}


def test_only_the_files_of_replaced_periods_change(spark):
    rows = [(i, f"2031-0{1 + i % 3}-05 10:00:00") for i in range(30)] + [(99, None)]
    frame = spark.createDataFrame(rows, "v INT, at STRING").withColumn("at", F.col("at").cast("timestamp"))
    folder = layouts.write_by_period(frame, fresh_folder(spark, "periods"), "at")
    before = stamps(folder)
    fixed = frame.where(F.month("at") == 2).withColumn("v", F.col("v") + 1000)
    for _ in range(2):
        layouts.replace_periods(fixed, folder, "at")
        after = stamps(folder)
        kept = {f for f in before if "period=2031-02-01" not in f}
        assert {f: after[f] for f in kept} == {f: before[f] for f in kept}
        assert {f for f in after if f not in kept} and not set(before) - kept & set(after)
        read = layouts.read_periods(spark, folder)
        assert read.count() == 31 and read.where("v > 900").count() == 10
    assert read.where("v = 99").first()["period"] is None


def test_wanted_periods_prune_the_scan(spark):
    frame = spark.range(90).select("id", F.date_add(F.lit("2031-01-01").cast("date"), F.col("id").cast("int")).alias("at"))
    folder = layouts.write_by_period(frame, fresh_folder(spark, "periods"), "at", ways=1)
    asked = fresh_folder(spark, "asked")
    spark.sql("SELECT explode(array(DATE'2031-02-01', DATE'2031-05-01')) AS period, 'x' AS why").write.parquet(asked)
    wanted = spark.read.parquet(asked).where("why = 'x'")
    found = layouts.read_periods(spark, folder, wanted)
    assert found.count() == 28
    assert "dynamicpruning" in plan_text(layouts.read_periods(spark, folder, wanted), "extended").lower()


def test_distinct_counts_merge(spark):
    draw = random.Random(1)
    rows = [(draw.randrange(5), draw.randrange(12), draw.choice([draw.randrange(-50, 50), draw.randrange(10**12)])) for _ in range(3000)]
    rows += [(1, 1, None), (None, 2, 7), (None, 2, -7), (2, 3, 2**63 - 1), (2, 3, -(2**63))]
    frame = spark.createDataFrame(rows, "month INT, day INT, who BIGINT")
    daily = distinct.id_bitmaps(frame, "who", "month", "day")
    folder = fresh_folder(spark, "bitmaps")
    daily.write.parquet(folder)
    stored = spark.read.parquet(folder)
    found = {r.month: r.distinct_ids for r in distinct.distinct_ids(stored, "month").collect()}
    wanted = {r.month: r.n for r in frame.groupBy("month").agg(F.countDistinct("who").alias("n")).collect()}
    assert found == wanted
    assert distinct.distinct_ids(stored).first()[0] == frame.select("who").where("who IS NOT NULL").distinct().count()
    assert distinct.distinct_ids(stored.limit(0)).first()[0] in (None, 0)


def test_versions_close_where_values_change_or_keys_vanish(spark):
    rows = [
        ("a", 1, "x"), ("a", 2, "x"), ("a", 3, "y"), ("a", 4, "y"),
        ("b", 1, None), ("b", 2, None), ("b", 4, None),
        ("c", 2, "x"), ("c", 2, "x"), ("c", 3, "x"), (None, 4, "n"), ("d", None, "z"),
    ]
    frame = spark.createDataFrame(rows, "k STRING, day INT, v STRING")
    frame = frame.withColumn("at", F.to_timestamp(F.concat(F.lit("2031-01-0"), F.col("day").cast("string")))).drop("day")
    made = history.versions(frame, "k", "at")
    found = {(r.k, r.v, r.valid_from.day, r.valid_to and r.valid_to.day, r.is_current) for r in made.collect()}
    assert found == {
        ("a", "x", 1, 3, False), ("a", "y", 3, None, True), ("b", None, 1, 3, False), ("b", None, 4, None, True),
        ("c", "x", 2, 4, False), (None, "n", 4, None, True),
    }
    assert history.versions(frame.limit(0), "k", "at").count() == 0
    sales = spark.createDataFrame([("a", "2031-01-02"), ("a", "2031-01-03"), ("b", "2031-01-03")], "k STRING, sold STRING")
    sales = sales.withColumn("sold", F.col("sold").cast("timestamp"))
    at = joins.version_at(sales, made, "k", "sold")
    assert {(r.k, r.sold.day, r.v) for r in at.collect()} == {("a", 2, "x"), ("a", 3, "y"), ("b", 3, None)}


def test_running_totals_without_a_single_task(spark):
    draw = random.Random(2)
    rows = [(draw.choice([None, 5, draw.randrange(50)]), i, draw.choice([None, draw.randrange(-9, 9)])) for i in range(2000)]
    frame = spark.createDataFrame(rows, "t INT, id INT, v INT").repartition(7)
    told = running.running_totals(frame, "t", "id", measure="v")
    total, wanted = 0, []
    for n, (t, i, v) in enumerate(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])), 1):
        total += v or 0
        wanted.append((n, t, i, v, total))
    found = sorted((r.position, r.t, r.id, r.v, r.running_total) for r in told.collect())
    assert found == wanted
    assert [r.position for r in running.page(told, 3, 7).orderBy("position").collect()] == list(range(15, 22))
    same = running.running_totals(frame.select(F.lit(1).alias("one")), "one")
    assert sorted(r.position for r in same.collect()) == list(range(1, 2001))
    assert running.running_totals(frame.limit(0), "t", measure="v").count() == 0
    plan = plan_text(running.running_totals(frame, "t", measure="v"))
    assert plan.count("SinglePartition") <= 1, "only the sums of the ranges meet in one task"
