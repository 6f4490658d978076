"""Misfit lines, repeated deliveries, state read as a table, silent keys, metrics of a running stream."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import cleaning, quality
from millrace.scratch import fresh_folder
from millrace.sinks import files
from millrace.sinks import streams as sinks
from millrace.sources.streams import arrivals
from millrace.sources.tables import read_records
from millrace.streaming import dedup, event_time, metrics, runs, silence, state

NOW = runs.AVAILABLE_NOW
EVENTS = "id BIGINT, ts TIMESTAMP, who STRING"


def lines(spark, folder, *rows):
    spark.createDataFrame([(r,) for r in rows], "value STRING").coalesce(1).write.text(folder)
    return folder


def events(spark, *rows):
    return spark.createDataFrame(list(rows), "id BIGINT, at STRING, who STRING").select(
        "id", F.col("at").cast("timestamp").alias("ts"), "who"
    )


def test_every_line_is_read_or_kept_raw(spark):
    given = ["k,v,d", "", "1,a,2031-01-01", "2,b", "3,c,2031-01-03,more", "x,d,2031-01-04", "5,,", '6,"e, f",2031-01-06', "7,g,2031-13-01"]
    folder = lines(spark, fresh_folder(spark, "csv"), *given)
    rows = cleaning.explain_malformed(read_records(spark, folder, "k INT, v STRING, d DATE", header="k,v,d"))
    good, bad = cleaning.accepted(rows), cleaning.rejected(rows)
    assert {(r.k, r.v, str(r.d)) for r in good.collect()} == {(1, "a", "2031-01-01"), (5, None, "None"), (6, "e, f", "2031-01-06")}
    assert {r.raw_line for r in bad.collect()} == {"2,b", "3,c,2031-01-03,more", "x,d,2031-01-04", "7,g,2031-13-01"}
    assert {(r.k, r.v, r.reject_reason) for r in bad.collect()} == {(None, None, "malformed line")}
    for little in ("reject_reason", "k", "d"):
        assert rows.where("reject_reason IS NOT NULL").select(little).count() == 4, "however little is read"
    assert [r.reject_reason is None for r in rows.select("k", "reject_reason").collect()].count(False) == 4


def test_a_misfit_comes_before_other_reasons(spark):
    folder = lines(spark, fresh_folder(spark, "json"), '{"k": 1, "v": "a"}', '{"k": 2', '{"k": null, "v": "b"}', "[]", "{}")
    rows = read_records(spark, folder, "k INT, v STRING", source="json")
    told = cleaning.explain_rejects(rows, [(F.col("k").isNull(), "no key")])
    found = [(r.k, r.raw_line, r.reject_reason) for r in cleaning.explain_malformed(told).collect()]
    assert (1, None, None) in found and (None, '{"k": 2', "malformed line") in found
    assert found.count((None, None, "no key")) >= 2


def test_copies_are_dropped_across_batches_and_state_expires(spark):
    landing, output, checkpoint = (fresh_folder(spark, p) for p in ("events", "once", "checkpoint"))
    days = [
        events(spark, (1, "2031-01-01 10:00:00", "a"), (1, "2031-01-01 10:00:00", "a"), (2, "2031-01-01 10:05:00", "b")),
        events(spark, (2, "2031-01-01 10:05:00", "b"), (3, "2031-01-01 10:30:00", "a")),
        events(spark, (4, "2031-01-03 10:00:00", "a"), (3, "2031-01-01 10:30:00", "a")),
        events(spark, (1, "2031-01-01 10:00:00", "a"), (5, "2031-01-03 10:01:00", "b")),
    ]
    for number, rows in enumerate(days):
        files.publish_arrival(rows, landing, str(number))
        once = dedup.once_within(arrivals(spark, landing, EVENTS), "ts", "1 hour", "id")
        runs.finish(sinks.to_files(once, output, checkpoint, trigger=NOW))
    assert sorted(r.id for r in spark.read.parquet(output).collect()) == [1, 2, 3, 4, 5]
    held = state.flat_state(state.state_rows(spark, checkpoint))
    assert sorted(r.id for r in held.collect()) == [4, 5], "keys behind the watermark are forgotten"
    assert state.state_operators(spark, checkpoint).first()["operatorName"] == "dedupeWithinWatermark"


def test_state_of_an_earlier_batch_and_its_changes(spark, raw):
    landing, output, checkpoint = (fresh_folder(spark, p) for p in ("sales", "report", "checkpoint"))
    for number, part in enumerate(("sale_id < 'a3'", "sale_id >= 'a3'")):
        files.publish_arrival(raw.where(part), landing, str(number))
        counts = arrivals(spark, landing, raw.schema).groupBy("product_id").count()
        runs.finish(sinks.to_batches(counts, sinks.batch_folder(output), checkpoint, "complete", NOW))
    first = state.flat_state(state.state_rows(spark, checkpoint, batch=0))
    assert {tuple(r) for r in first.collect()} == {(" t7 ", 1), ("T7", 1)}
    assert state.state_rows(spark, checkpoint).count() == raw.select("product_id").distinct().count()
    changed = state.state_changes(spark, checkpoint, 1, 1).select("key.product_id", "change_type")
    assert ("K2", "update") in {tuple(r) for r in changed.collect()}


def test_silence_is_told_once_and_survives_a_restart(spark):
    landing, output, checkpoint = (fresh_folder(spark, p) for p in ("events", "alerts", "checkpoint"))
    days = [
        events(spark, (1, "2031-01-01 10:00:00", "a"), (2, "2031-01-01 10:00:00", None), (3, "2031-01-01 10:30:00", "a")),
        events(spark, (4, "2031-01-01 11:00:00", "a"), (5, "2031-01-01 13:00:00.5", "b"), (6, None, "a")),
        events(spark, (7, "2031-01-01 18:00:00", "b")),
    ]
    for number, rows in enumerate(days):
        files.publish_arrival(rows, landing, str(number))
        seen = event_time.watermarked(arrivals(spark, landing, EVENTS), "ts", "10 minutes")
        runs.finish(sinks.to_files(silence.silence_alerts(seen, "who", "ts", 3600), output, checkpoint, trigger=NOW))
    found = sorted(((r.who, str(r.last_seen), str(r.silent_at)) for r in spark.read.parquet(output).collect()), key=str)
    assert found == [
        ("a", "2031-01-01 11:00:00", "2031-01-01 12:00:00"),
        ("b", "2031-01-01 13:00:00.500000", "2031-01-01 14:00:00.500000"),
        (None, "2031-01-01 10:00:00", "2031-01-01 11:00:00"),
    ]
    held = state.state_rows(spark, checkpoint, stateVarName="last_seen")
    assert [r[0] for r in held.select("key.who").collect()] == ["b"], "only the key still active is held"


def test_metrics_are_kept_per_batch(spark, raw):
    landing, output, checkpoint, stored = (fresh_folder(spark, p) for p in ("sales", "cleaned", "checkpoint", "metrics"))
    with metrics.BatchMetrics(spark) as kept:
        for number, part in enumerate(("sale_id < 'a3'", "sale_id >= 'a3'")):
            files.publish_arrival(raw.where(part), landing, str(number))
            stream = metrics.observed(cleaning.clean_sales(arrivals(spark, landing, raw.schema)), metrics.outcome_counts())
            query = runs.finish(sinks.to_files(stream, output, checkpoint, trigger=NOW))
            kept.save(str(query.runId), stored)
            kept.save(str(query.runId), stored)
    rows = metrics.saved_metrics(spark, stored).orderBy("batch").collect()
    assert [(r.batch, r.input_rows, r.accepted_rows + r.rejected_rows) for r in rows] == [(0, 2, 2), (1, 9, 9)]
    with pytest.raises(TimeoutError):
        kept.rows("no such run", 0.1)


# What was wrong before


def test_the_guard_tells_columns_of_one_name_apart(spark, raw):
    left, right = raw.alias("l"), raw.withColumn("amount_raw", F.upper("amount_raw")).alias("r")
    joined = left.join(right, F.col("l.sale_id") == F.col("r.sale_id"))
    marks = {runs.plan_fingerprint(joined.select(F.col(f"{side}.amount_raw"))) for side in ("l", "r", "l")}
    assert len(marks) == 2


def test_totals_of_whole_numbers_keep_every_digit(spark):
    fine = spark.sql("SELECT * FROM VALUES (9007199254740993L), (9223372036854775807L) AS t(amount)")
    coarse = spark.sql("SELECT * FROM VALUES (9007199254740992L), (9223372036854775807L) AS t(total)")
    assert int(quality.totals_kept(fine, coarse).first()["difference"]) == 1
    mixed = spark.sql("SELECT CAST(9232379236109516799.5 AS DECIMAL(25,1)) AS total")
    assert str(quality.totals_kept(fine, mixed).first()["difference"]) == "0.5"


def test_readers_pass_over_an_unfinished_batch(spark, raw):
    folder = fresh_folder(spark, "split")
    save = sinks.split_by_reason(folder)
    cleaned = cleaning.clean_sales(raw)
    save(cleaned, 0)
    whole = sinks.accepted_batches(spark, folder).count(), sinks.rejected_batches(spark, folder).count()
    save(cleaned, 1)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/batch_id=1/_SUCCESS")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)
    assert (sinks.accepted_batches(spark, folder).count(), sinks.rejected_batches(spark, folder).count()) == whole
    with pytest.raises(FileNotFoundError):
        sinks.all_batches(spark, fresh_folder(spark, "none"))


def test_of_two_deliverers_one_wins(spark, raw):
    landing = fresh_folder(spark, "landing")
    store = spark._jvm.org.apache.hadoop.fs.Path(landing).getFileSystem(spark._jsc.hadoopConfiguration())
    claim = spark._jvm.org.apache.hadoop.fs.Path(f"{landing}/_unfinished/_01.claim")
    assert files._claimed(spark, store, claim, "somewhere") and not files._claimed(spark, store, claim, "elsewhere")
    # One that was lost between its claim and the rename is finished by the next.
    staged = files.write_once(raw.limit(3), f"{landing}/_unfinished/02-x")
    assert files._claimed(spark, store, spark._jvm.org.apache.hadoop.fs.Path(f"{landing}/_unfinished/_02.claim"), staged)
    for _ in range(2):
        with pytest.raises(FileExistsError):
            files.publish_arrival(raw, landing, "02")
    assert spark.read.parquet(f"{landing}/02").count() == 3
    files.publish_arrival(raw, landing, "03")
    assert spark.read.parquet(f"{landing}/03").count() == 11
