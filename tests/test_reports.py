import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.operators import cleaning, joins, reports, windows


def test_daily_totals(raw, products):
    good = cleaning.accepted(cleaning.clean_sales(raw))
    enriched = joins.enrich(good, cleaning.clean_lookup(products))
    found = {
        (r.sale_date, r.category): (r.total, r.largest_sale)
        for r in reports.daily_totals(enriched).collect()
    }
    assert found == {
        (date(2031, 3, 4), "tools"): (Decimal("19.75"), Decimal("12.50")),
        (date(2031, 3, 5), "kitchen"): (Decimal("100.00"), Decimal("100.00")),
        (date(2031, 3, 5), "unmapped"): (Decimal("-3.10"), Decimal("-3.10")),
    }


def test_profile_treats_null_as_a_group(spark):
    rows = [("a", 1, "x"), ("a", None, "x"), (None, 3, "y"), (None, 5, None)]
    frame = spark.createDataFrame(rows, "k STRING, v INT, d STRING")
    found = {r.k: r for r in reports.profile_by(frame, "k", "v", "d").collect()}
    assert (found["a"].rows, found["a"].known, found["a"].distinct_values) == (2, 1, 1)
    assert (found[None].smallest, found[None].mean, found[None].largest) == (3, 4.0, 5)
    assert found[None].distinct_values == 1


def test_global_totals_of_nothing(spark):
    empty = spark.createDataFrame([], "amount DECIMAL(12,2)")
    assert tuple(reports.totals_by(empty).first()) == (0, None)


def test_word_count_and_tags(spark):
    lines = spark.createDataFrame([("to be or",), ("not to be",)], "value STRING")
    counts = {r.word: r["count"] for r in reports.word_count(lines).collect()}
    assert counts == {"to": 2, "be": 2, "or": 1, "not": 1}
    tagged = spark.createDataFrame([(1, "red|big"), (2, "red")], "id INT, tags STRING")
    tags = reports.tag_rows(tagged, "id", "tags")
    assert {tuple(r) for r in tags.collect()} == {(1, "red"), (1, "big"), (2, "red")}
    assert tags.select("tag").distinct().count() == 2


def test_sorted_rows_cut_through_a_hot_key(spark):
    frame = spark.range(0, 20000, 1, 8).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    frame = frame.unionByName(spark.createDataFrame([(0, -1), (2, -2)], "k INT, v LONG"))
    ordered = reports.sorted_rows(frame, "k")
    assert ordered.columns == ["k", "v"]
    keys = [r.k for r in ordered.collect()]
    assert keys == sorted(keys) and len(keys) == 20002
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["count"] for r in
                 reports.sorted_rows(frame, "k").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(sizes) < 10000


def test_preview_and_calendar(spark):
    frame = spark.createDataFrame(
        [(datetime(2031, 1, 1, 8), Decimal("2.00")), (datetime(2031, 1, 4, 9), Decimal("3.00"))],
        "sold_at TIMESTAMP, amount DECIMAL(12,2)",
    )
    found = {r.sale_date.day: (r.sales, r.total)
             for r in reports.calendar_totals(frame).collect()}
    assert found == {1: (1, Decimal("2.00")), 2: (0, None), 3: (0, None), 4: (1, Decimal("3.00"))}
    assert reports.calendar_totals(frame.where("false")).isEmpty()
    assert [r.id for r in reports.preview(spark.range(100), ["id"], 3).collect()] == [0, 1, 2]


def _events(seed, n):
    rng = random.Random(seed)
    start = datetime(2031, 5, 1)
    rows = []
    for _ in range(n):
        user = 1 if rng.random() < 0.4 else rng.randrange(2, 9)
        step = rng.choice([rng.randrange(0, 90000), 60 * rng.randrange(0, 1500)])
        rows.append((user, start + timedelta(seconds=step, microseconds=rng.choice([0, 1, 999999]))))
    return rows


def _sessions_by_hand(rows, gap):
    sessions = []
    for user in {u for u, _ in rows}:
        times = sorted(t for u, t in rows if u == user)
        first, last, n = times[0], times[0], 0
        for t in times:
            if t - last > gap and n:
                sessions.append((user, first, last + gap, n))
                first, n = t, 0
            last, n = t, n + 1
        sessions.append((user, first, last + gap, n))
    return sorted(sessions)


@pytest.mark.parametrize("chunk_gaps", [1, 3, 256])
@pytest.mark.parametrize("share", [0.02, 0.999])
def test_sessions_equal_brute_force(spark, chunk_gaps, share):
    for seed, gap in ((1, 60), (2, 600), (3, 7)):
        rows = _events(seed, 400)
        frame = spark.createDataFrame(rows, "user_id INT, ts TIMESTAMP_NTZ").repartition(5)
        found = windows.session_counts(
            frame, "ts", gap, "user_id", chunk_gaps=chunk_gaps, share=share
        ).collect()
        got = sorted((r.user_id, r.session_start, r.session_end, r.events) for r in found)
        assert got == _sessions_by_hand(rows, timedelta(seconds=gap))


def test_sessions_without_a_key(spark):
    rows = [(1, t) for _, t in _events(8, 200)]
    frame = spark.createDataFrame([(t,) for _, t in rows] + [(None,)], "ts TIMESTAMP_NTZ")
    found = windows.session_counts(frame, "ts", 120, chunk_gaps=4).collect()
    got = sorted((1, r.session_start, r.session_end, r.events) for r in found)
    assert got == _sessions_by_hand(rows, timedelta(seconds=120))


def test_a_pause_of_exactly_the_gap_keeps_a_session(spark):
    start = datetime(2031, 5, 1)
    rows = [(1, start), (1, start + timedelta(seconds=60)), (2, start), (2, start + timedelta(seconds=61))]
    frame = spark.createDataFrame(rows, "user_id INT, ts TIMESTAMP_NTZ")
    found = windows.session_counts(frame, "ts", 60, "user_id").groupBy("user_id").count().collect()
    assert {r.user_id: r["count"] for r in found} == {1: 1, 2: 2}


def test_sessions_equal_the_builtin_window(spark):
    frame = spark.createDataFrame(_events(21, 800), "user_id INT, ts TIMESTAMP_NTZ")
    builtin = frame.groupBy("user_id", F.session_window("ts", "10 minutes")).count()
    found = windows.session_counts(frame, "ts", 600, "user_id")
    assert sorted(
        (r.user_id, r.session_window.start, r.session_window.end, r["count"])
        for r in builtin.collect()
    ) == sorted((r.user_id, r.session_start, r.session_end, r.events) for r in found.collect())


def test_sliding_counts_equal_direct_windows(spark):
    frame = spark.createDataFrame(_events(9, 500), "user_id INT, ts TIMESTAMP_NTZ")
    direct = (
        frame.groupBy(F.window("ts", "1 hour", "10 minutes"), "user_id")
        .agg(F.count(F.lit(1)).alias("events"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                "user_id", "events")
    )
    paned = windows.sliding_counts(frame, "ts", "1 hour", "10 minutes", "user_id")
    assert sorted(map(tuple, paned.collect())) == sorted(map(tuple, direct.collect()))
    tumbling = windows.tumbling_counts(frame, "ts", "1 hour")
    assert tumbling.agg(F.sum("events")).first()[0] == 500
