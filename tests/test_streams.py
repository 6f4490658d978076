import json
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F

from millrace.operators import cleaning, joins, quality, reports
from millrace.scratch import fresh_folder
from millrace.sinks import streams as sinks
from millrace.plans.reading import plan_text
from millrace.sinks.files import publish_arrival
from millrace.sources.streams import arrivals, read_stream
from millrace.streaming import event_time, runs
from millrace.streaming.lookups import enrich_stream

NOW = runs.AVAILABLE_NOW


@pytest.fixture
def landing(spark, raw):
    folder = fresh_folder(spark, "landing")
    publish_arrival(raw.where("sale_id < 'a5'"), folder, "01")
    return folder


def report_of(stream, products):
    good = cleaning.accepted(cleaning.clean_sales(stream))
    return reports.category_totals(joins.enrich(good, cleaning.clean_lookup(products)))


def test_batch_and_stream_agree_across_a_restart(spark, raw, products, landing):
    output, checkpoint = fresh_folder(spark, "out"), fresh_folder(spark, "checkpoint")

    def run():
        stream = report_of(arrivals(spark, landing, raw.schema), products)
        return runs.run_now(
            lambda: sinks.to_batches(
                stream, sinks.batch_folder(output), checkpoint, "complete", NOW
            )
        )

    run()
    publish_arrival(raw.where("sale_id >= 'a5'"), landing, "02")
    seen = run()
    assert seen["input_rows"] == 7, "the first arrival is not read again"
    assert not seen["active"]
    assert quality.same_report(sinks.latest_batch(spark, output), report_of(raw, products))


def test_a_repeated_batch_replaces_itself(spark, raw):
    folder = fresh_folder(spark, "batches")
    save = sinks.batch_folder(folder)
    save(raw, 0)
    save(raw, 0)
    save(raw.limit(2), 1)
    assert sinks.all_batches(spark, folder).count() == 13
    assert sinks.latest_batch(spark, folder).count() == 2


def test_latest_per_key(spark):
    folder = fresh_folder(spark, "updates")
    save = sinks.batch_folder(folder)
    save(spark.createDataFrame([("x", 1), ("y", 1)], "k STRING, n INT"), 0)
    save(spark.createDataFrame([("x", 5)], "k STRING, n INT"), 1)
    latest = sinks.latest_per_key(spark, folder, "k")
    assert {tuple(r) for r in latest.collect()} == {("x", 5), ("y", 1)}
    assert "SortAggregate" not in plan_text(latest)


def test_folded_batches_read_like_unfolded(spark):
    plain, folded = fresh_folder(spark, "plain"), fresh_folder(spark, "folded")
    saves = (sinks.batch_folder(plain), sinks.folded_batches(folded, "k", every=2))
    for batch_id in range(5):
        rows = spark.createDataFrame([(f"k{batch_id % 3}", batch_id), ("all", -batch_id)], "k STRING, n INT")
        for save in (*saves, saves[1]):
            save(rows, batch_id)
    assert quality.same_rows(
        sinks.latest_per_key(spark, plain, "k"), sinks.latest_per_key(spark, folded, "k")
    )
    opened = " ".join(sinks.latest_per_key(spark, folded, "k").inputFiles())
    assert "batch_id=4" in opened and "through=3" in opened and "batch_id=3" not in opened


def test_the_guard_sees_every_column(spark, raw, landing):
    stream = arrivals(spark, landing, raw.schema)
    wide = [F.col("sale_id").alias(f"c{i}") for i in range(40)]
    one = stream.select(*wide, F.length("sale_id").alias("last"))
    other = stream.select(*wide, (F.length("sale_id") + 1).alias("last"))
    again = arrivals(spark, landing, raw.schema).select(*wide, F.length("sale_id").alias("last"))
    assert runs.plan_fingerprint(one) == runs.plan_fingerprint(again) != runs.plan_fingerprint(other)


def test_the_guard_lets_a_lookup_grow(spark, raw, products, landing):
    good = cleaning.accepted(cleaning.clean_sales(arrivals(spark, landing, raw.schema)))
    lookup = cleaning.clean_lookup(products)
    small, large = enrich_stream(good, lookup), enrich_stream(good, lookup, max_rows=1)
    assert runs.plan_fingerprint(small) == runs.plan_fingerprint(large)


@pytest.mark.parametrize("mode", ["append", "update", "complete"])
def test_word_count_modes(spark, tmp_path, mode):
    """Append would never be final without event time and is refused; the others agree."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.txt").write_text("cat dog\ncat\n")
    counts = reports.word_count(read_stream(spark, "text", str(tmp_path / "in")))
    output, checkpoint = fresh_folder(spark, "words"), fresh_folder(spark, "checkpoint")

    def run():
        runs.finish(sinks.to_batches(counts, sinks.batch_folder(output), checkpoint, mode, NOW))

    if mode == "append":
        with pytest.raises(AnalysisException):
            run()
        return
    run()
    (tmp_path / "in" / "2.txt").write_text("dog owl\n")
    run()
    newest = {tuple(r) for r in sinks.latest_per_key(spark, output, "word").collect()}
    assert newest == {("cat", 2), ("dog", 2), ("owl", 1)}
    last = {r.word for r in sinks.latest_batch(spark, output).collect()}
    assert last == ({"dog", "owl"} if mode == "update" else {"cat", "dog", "owl"})


def test_unsuitable_modes_are_refused(spark, raw, landing):
    rows = arrivals(spark, landing, raw.schema)
    checkpoint = fresh_folder(spark, "checkpoint")
    with pytest.raises(AnalysisException):
        sinks.write_stream(rows, "noop", "complete", checkpoint)
    counts = rows.groupBy("product_id").count()
    with pytest.raises(AnalysisException):
        sinks.write_stream(counts, "parquet", "complete", checkpoint, fresh_folder(spark, "out"))
    with pytest.raises(AnalysisException):
        sinks.to_files(counts, fresh_folder(spark, "out"), checkpoint)
    left = event_time.watermarked(_timed(spark), "at", "1 hour")
    right = left.withColumnsRenamed({"at": "at2", "id": "id2"})
    pairs = event_time.follow_ups(left, right, "k", "at", "at2", 60)
    with pytest.raises(AnalysisException):
        sinks.write_stream(pairs, "noop", "update", checkpoint)


def _timed(spark, source="rate"):
    return read_stream(spark, source, options={"rowsPerSecond": 50}).select(
        F.col("timestamp").alias("at"), F.col("value").alias("id"), (F.col("value") % 3).alias("k")
    )


def test_rate_source_with_a_processing_time_trigger(spark):
    query = sinks.to_memory(
        _timed(spark), "rated", trigger={"processingTime": "1 second"}
    )
    try:
        assert query.isActive and query.id in [q.id for q in spark.streams.active]
        assert not query.awaitTermination(4)
    finally:
        runs.stop_all(spark)
    assert not query.isActive
    seen = runs.status(query)
    assert seen["name"] == "rated" and seen["batch"] is not None
    ids = [r.id for r in spark.table("rated").collect()]
    assert sorted(ids) == list(range(len(ids))) and ids


def test_finish_stops_a_query_that_does_not_end(spark):
    query = sinks.write_stream(_timed(spark), "noop")
    with pytest.raises(TimeoutError):
        runs.finish(query, 2)
    assert not query.isActive


def test_a_lookup_too_large_to_copy_is_spread(spark, raw, products, landing):
    lookup = cleaning.clean_lookup(products)
    doubled = lookup.unionByName(lookup.where("category = 'tools'"))
    for limits in ({}, {"max_rows": 1}, {"max_rows": 1, "hot": [("T7",), ("gone",)], "salts": 5}):
        for side in (lookup, doubled):
            good = cleaning.accepted(cleaning.clean_sales(arrivals(spark, landing, raw.schema)))
            output = fresh_folder(spark, "labelled")
            runs.finish(
                sinks.to_files(
                    enrich_stream(good, side, **limits),
                    output,
                    fresh_folder(spark, "checkpoint"),
                    trigger=NOW,
                )
            )
            batch = cleaning.accepted(cleaning.clean_sales(raw.where("sale_id < 'a5'")))
            assert quality.same_rows(spark.read.parquet(output), joins.enrich(batch, side))


def test_memory_table_and_drain(spark, raw, products, landing):
    query = sinks.to_memory(
        report_of(arrivals(spark, landing, raw.schema), products), "report_now", "complete"
    )
    runs.drain(query)
    assert quality.same_report(
        spark.table("report_now"), report_of(raw.where("sale_id < 'a5'"), products)
    )


def test_console_sink_runs(spark, raw, landing):
    runs.finish(sinks.to_console(arrivals(spark, landing, raw.schema), trigger=NOW))


def test_row_writer(spark, raw, landing, tmp_path):
    class LineWriter:
        """Appends each row to a file per partition and batch."""

        def __init__(self, folder):
            self.folder = folder

        def open(self, partition_id, epoch_id):
            self.file = open(f"{self.folder}/{epoch_id}-{partition_id}.jsonl", "w")
            return True

        def process(self, row):
            self.file.write(json.dumps(row.asDict()) + "\n")

        def close(self, error):
            self.file.close()

    stream = arrivals(spark, landing, raw.schema)
    runs.finish(
        sinks.to_row_writer(
            stream, LineWriter(str(tmp_path)), fresh_folder(spark, "checkpoint"), trigger=NOW
        )
    )
    lines = [json.loads(x) for f in tmp_path.glob("*.jsonl") for x in f.read_text().splitlines()]
    assert {x["sale_id"] for x in lines} == {"a1", "a2", "a3", "a4"} and len(lines) == 4


def test_kafka_goes_through_the_same_calls(spark, raw, landing):
    """The connector is not installed here, so Spark refuses by name; nothing else differs."""
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        read_stream(
            spark, "kafka", options={"kafka.bootstrap.servers": "host:1", "subscribe": "sales"}
        )
    query_error = (AnalysisException, StreamingQueryException)
    with pytest.raises(query_error, match="(?i)kafka"):
        sinks.write_stream(
            arrivals(spark, landing, raw.schema).select(F.col("sale_id").alias("value")),
            "kafka",
            checkpoint=fresh_folder(spark, "checkpoint"),
            options={"kafka.bootstrap.servers": "host:1", "topic": "out"},
        )


def test_rejects_go_to_their_own_place(spark, raw, landing):
    publish_arrival(raw.where("sale_id >= 'a5'"), landing, "02")
    output = fresh_folder(spark, "split")
    parsed = cleaning.clean_sales(arrivals(spark, landing, raw.schema))
    runs.finish(
        sinks.to_batches(
            parsed, sinks.split_by_reason(output), fresh_folder(spark, "checkpoint"),
            trigger=NOW,
        )
    )
    whole = cleaning.clean_sales(raw)
    stored = sinks.rejected_batches(spark, output)
    assert quality.same_rows(stored, cleaning.rejected(whole))
    assert quality.split_problems(raw, sinks.accepted_batches(spark, output), stored).isEmpty()


def test_resuming_needs_the_same_boundary_and_transformations(spark, raw, products, landing):
    folder = fresh_folder(spark, "guard")
    lookup = cleaning.clean_lookup(products)

    def build(how="left"):
        good = cleaning.accepted(cleaning.clean_sales(arrivals(spark, landing, raw.schema)))
        return reports.category_totals(good.join(lookup, "product_id", how))

    runs.remember_boundary(build(), folder, 1)
    runs.require_boundary(build(), folder, after=1)
    with pytest.raises(ValueError, match="arrival 1"):
        runs.require_boundary(build(), folder, after=2)
    with pytest.raises(ValueError, match="another computation"):
        runs.require_boundary(build("inner"), folder, after=1)
    runs.remember_boundary(build(), folder, 2)
    runs.require_boundary(build(), folder, after=2)


def test_a_late_row_inside_the_delay_counts(spark, tmp_path):
    start = datetime(2031, 1, 1, 12)
    batches = [["12:01", "12:04", "12:12"], ["12:03"], ["12:40"]]
    folder = fresh_folder(spark, "late")
    output, checkpoint = fresh_folder(spark, "out"), fresh_folder(spark, "checkpoint")
    for number, times in enumerate(batches):
        rows = [(start.replace(minute=int(t[3:])),) for t in times]
        publish_arrival(spark.createDataFrame(rows, "at TIMESTAMP"), folder, str(number))
        stream = event_time.watermarked(arrivals(spark, folder, "at TIMESTAMP"), "at", "10 minutes")
        counts = event_time.window_counts(stream, "at", "10 minutes")
        runs.finish(sinks.to_files(counts, output, checkpoint, trigger=NOW))
    found = {r.window_start.minute: r.events for r in spark.read.parquet(output).collect()}
    assert found == {0: 3, 10: 1}, "the last window is still open"


def test_follow_ups_equal_a_plain_join(spark):
    rows = [(k, k * 100 + i, datetime(2031, 1, 1, i // 6, (i * 10 + k) % 60)) for k in (1, 2)
            for i in range(40)]
    frame = spark.createDataFrame(rows, "k INT, id INT, at TIMESTAMP")
    first = frame.select("k", "id", "at")
    second = frame.select("k", F.col("id").alias("id2"), F.col("at").alias("at2"))
    got = event_time.follow_ups(first, second, "k", "at", "at2", 1800)
    wanted = first.join(second, "k").where(
        "at2 >= at AND at2 <= at + INTERVAL 1800 SECONDS"
    )
    assert quality.same_rows(got.select(*wanted.columns), wanted)
    assert wanted.count() > 80
