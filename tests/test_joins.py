import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.operators import cleaning, joins, quality, reports
from millrace.plans.reading import plan_text


@pytest.fixture(scope="module")
def good(raw):
    return cleaning.accepted(cleaning.clean_sales(raw))


@pytest.fixture(scope="module")
def lookup(products):
    return cleaning.clean_lookup(products)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, many of them copies, and a third without a key."""
    rng = random.Random(5)
    rows = []
    for i in range(900):
        key = ["hot", None, f"k{rng.randrange(40)}"][i % 3]
        rows.append((key, rng.randrange(3), rng.randrange(50)))
    return spark.createDataFrame(rows, "key STRING, part INT, x INT").repartition(4)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [("hot", "h1", 5), ("hot", "h2", 30), (None, "none", 1)]
    rows += [(f"k{i}", f"label{i}", i) for i in range(0, 60, 2)]
    return spark.createDataFrame(rows, "key STRING, label STRING, lower INT")


def test_enrich_keeps_unmatched_sales(good, lookup):
    rows = {r.sale_id: r.category for r in joins.enrich(good, lookup).collect()}
    assert rows == {"a1": "tools", "a2": "tools", "a3": "kitchen", "a4": "unmapped"}


def test_totals_through_lookup_equal_the_long_way(good, lookup):
    short = joins.totals_through_lookup(good, lookup)
    long = reports.category_totals(joins.enrich(good, lookup))
    assert quality.same_report(short, long)
    assert short.schema["total"].dataType.simpleString() == "decimal(22,2)"
    doubled = lookup.unionByName(lookup.where("category = 'tools'"))
    assert quality.same_rows(
        joins.totals_through_lookup(good, doubled),
        reports.category_totals(joins.enrich(good, doubled)),
    )
    assert quality.same_rows(
        reports.daily_totals_through_lookup(good, doubled),
        reports.daily_totals(joins.enrich(good, doubled)),
    )


def test_inner_join_loses_the_unmapped_total(good, lookup):
    joined = good.join(lookup, "product_id", "inner")
    assert reports.totals_by(joined).first()["total"] == Decimal("119.75")
    assert reports.totals_by(good).first()["total"] == Decimal("116.65")


def test_existence_joins(good, lookup):
    twice = lookup.unionByName(lookup)
    assert {r.sale_id for r in joins.unmatched(good, twice, "product_id").collect()} == {"a4"}
    assert joins.matched(good, twice, "product_id").count() == 3


def test_null_key_is_unmatched(raw, lookup):
    missing = joins.unmatched(cleaning.clean_sales(raw), lookup, "product_id")
    assert {r.sale_id for r in missing.collect()} == {"a4", "a9", "b1"}


def test_fan_out_counts_what_the_join_does(good, lookup):
    doubled = lookup.unionByName(lookup.where("category = 'tools'"))
    found = joins.fan_out(good, doubled).first()
    literal = good.join(doubled, "product_id", "left").agg(F.count("*"), F.sum("amount")).first()
    assert (found["rows_after"], found["total_after"]) == tuple(literal)
    assert (found["rows_before"], found["multiplied_keys"]) == (4, 1)


@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "left_semi", "left_anti"])
def test_salted_join_equals_plain(skewed, labels, how):
    salted = joins.salted_join(skewed, labels, "key", how, salts=7, share=0.1)
    plain = skewed.join(labels, "key", how)
    assert salted.columns == plain.columns
    assert quality.same_rows(salted, plain)
    assert not plain.isEmpty()


def test_known_hot_keys_save_the_search(skewed, labels):
    salted = joins.salted_join(skewed, labels, "key", "full", hot=[("hot",)])
    assert quality.same_rows(salted, skewed.join(labels, "key", "full"))


def test_salted_join_without_hot_keys_is_plain(skewed, labels):
    salted = joins.salted_join(skewed, labels, "key", share=0.9)
    assert "_right__salt" not in plan_text(salted).split("Join")[0]
    assert quality.same_rows(salted, skewed.join(labels, "key", "left"))


def test_salted_join_with_residual_and_two_keys(skewed, labels):
    inside = F.col("x") >= F.col("lower")
    renamed = labels.withColumnRenamed("key", "other")
    for how in ("inner", "left"):
        salted = joins.salted_join(skewed, labels, "key", how, share=0.1, residual=inside)
        plain = skewed.join(renamed, (F.col("key") == F.col("other")) & inside, how).drop("other")
        assert quality.same_rows(salted, plain)
    parts = labels.withColumn("part", F.col("lower") % 3)
    salted = joins.salted_join(skewed, parts, ["key", "part"], "full", share=0.05)
    assert quality.same_rows(salted, skewed.join(parts, ["key", "part"], "full"))


@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "left_semi", "left_anti"])
def test_hot_keys_that_do_not_occur_change_nothing(skewed, labels, how):
    plain = skewed.join(labels, "key", how)
    for hot in ([("absent",), ("hot",)], [("cold",)], [(None,)], []):
        assert quality.same_rows(joins.salted_join(skewed, labels, "key", how, hot=hot), plain)


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_many_hot_keys(spark, how):
    left = spark.range(8000).select((F.col("id") % 1000).cast("int").alias("k"), F.col("id").alias("x"))
    right = spark.range(0, 1200, 2).select(F.col("id").alias("k"), F.lit("y").alias("y"))
    salted = joins.salted_join(left, right, "k", how, share=5e-4)
    assert quality.same_rows(salted, left.join(right, "k", how).select(salted.columns))


def test_salts_follow_the_counts(spark):
    left = spark.range(9000).select(F.when(F.col("id") < 8000, 1).otherwise(F.col("id")).alias("k"))
    found, total = joins.heavy_digests(left, ["k"], 0.05)
    assert (len(found), total) == (1, 9000) and 8000 <= found[0][1] <= 8100
    assert joins._power_of_two(found[0][1] / (total * 0.05)) == 32


def test_salted_join_takes_maps_dots_and_zeros(spark):
    left = spark.sql("SELECT map('a', id) AS m, if(id % 2 = 0, 0.0D, -0.0D) AS `a.b` FROM range(40)")
    right = spark.sql("SELECT 0.0D AS `a.b`, 'zero' AS name")
    salted = joins.salted_join(left, right, "a.b", "left", share=0.1)
    assert [r["name"] for r in salted.collect()] == ["zero"] * 40
    assert joins.hot_keys(left, "a.b", 0.1).count() == 1


def test_salt_spreads_copies_of_one_row(spark, labels):
    copies = spark.range(0, 8000, 1, 8).select(F.lit("hot").alias("key"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = joins.salted_join(copies, labels, "key", "inner", salts=64)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sum(sizes) == 16000
    assert max(sizes) <= 8000


def test_salted_join_refuses_what_it_cannot_do(skewed, labels):
    with pytest.raises(ValueError, match="rename"):
        joins.salted_join(skewed, labels.withColumn("x", F.lit(1)), "key")
    with pytest.raises(ValueError, match="residual"):
        joins.salted_join(skewed, labels, "key", "full", residual=F.col("x") > 0)
    with pytest.raises(ValueError, match="unknown"):
        joins.salted_join(skewed, labels, "key", "sideways")


def test_hot_keys(spark, skewed):
    assert {r[0] for r in joins.hot_keys(skewed, "key", 0.1).collect()} == {"hot", None}
    assert joins.hot_keys(skewed, "key", 0.5).isEmpty()
    assert joins.hot_keys(skewed.where("false"), "key").isEmpty()
    for share in (0, 1, 1e-6):
        with pytest.raises(ValueError, match="share"):
            joins.hot_keys(skewed, "key", share)
    one = spark.createDataFrame([("a",)] * 3, "key STRING")
    assert [r[0] for r in joins.hot_keys(one, "key", 0.99).collect()] == ["a"]


def test_hot_keys_among_very_many(spark):
    """Far more keys than the sketch tracks; the two frequent ones are found, and no others."""
    many = spark.range(300_000).select(
        F.when(F.col("id") % 20 == 0, F.lit(-1))
        .when(F.col("id") % 25 == 1, F.lit(-2))
        .otherwise(F.col("id"))
        .alias("key")
    )
    assert {r.key for r in joins.hot_keys(many, "key", 0.03).collect()} == {-1, -2}
    assert {r.key for r in joins.hot_keys(many, "key", 0.045).collect()} == {-1}


def _by_hand(values, bands):
    pairs = []
    for number, value in values:
        hits = [b for b, low, high in bands if low <= value < high]
        pairs += [(number, b) for b in hits] or [(number, None)]
    return sorted(pairs, key=repr)


@pytest.mark.parametrize("loop_rows", [0, 1000])
def test_band_join_equals_brute_force(spark, loop_rows):
    rng = random.Random(11)
    values = [(i, rng.choice([rng.uniform(-50, 400), 77.0, 100.0])) for i in range(300)]
    bands = [(f"b{i}", float(low), float(low + rng.choice([0, 1, 5, 40, 300])))
             for i, low in enumerate(rng.randrange(-40, 300) for _ in range(60))]
    rows = spark.createDataFrame(values, "n INT, value DOUBLE")
    lookup = spark.createDataFrame(bands, "band STRING, lower DOUBLE, upper DOUBLE")
    joined = joins.band_join(rows, lookup, "value", loop_rows=loop_rows)
    assert joined.columns == ["n", "value", "band", "lower", "upper"]
    found = sorted([(r.n, r.band) for r in joined.collect()], key=repr)
    assert found == _by_hand(values, bands)
    inner = joins.band_join(rows, lookup, "value", how="inner", loop_rows=loop_rows)
    assert inner.count() == len([p for p in found if p[1] is not None])


@pytest.mark.parametrize("loop_rows", [0, 256])
@pytest.mark.parametrize("kind", ["DATE", "TIMESTAMP", "TIMESTAMP_NTZ", "DECIMAL(12,3)"])
def test_band_join_takes_days_times_and_decimals(spark, kind, loop_rows):
    rng = random.Random(3)
    start = "make_date(2000, 1, 1)" if kind != "DECIMAL(12,3)" else None
    cell = (lambda n: f"CAST(date_add({start}, {n}) AS {kind})") if start else (lambda n: f"CAST({n}.125 AS {kind})")  # noqa: E501
    values = [(i, rng.randrange(400)) for i in range(120)]
    bands = [(f"b{i}", low, low + rng.choice([0, 1, 6, 90, 100_000])) for i, low in enumerate(rng.sample(range(300), 30))]
    rows = spark.sql(" UNION ALL ".join(f"SELECT {i} AS n, {cell(v)} AS value" for i, v in values))
    lookup = spark.sql(" UNION ALL ".join(f"SELECT '{b}' AS band, {cell(x)} AS lower, {cell(y)} AS upper" for b, x, y in bands))  # noqa: E501
    joined = joins.band_join(rows, lookup, "value", loop_rows=loop_rows)
    assert sorted([(r.n, r.band) for r in joined.collect()], key=repr) == _by_hand(values, bands)


@pytest.mark.parametrize("loop_rows", [0, 256])
def test_band_join_takes_endless_bands(spark, loop_rows):
    inf = float("inf")
    values = [(i, float(v)) for i, v in enumerate([-1e300, -5.5, 0.0, 1e-9, 3.0, 49.0, 1e17, 1e300, inf])]
    bands = [("all", -inf, inf), ("up", 3.0, inf), ("far", 0.0, 1e18), ("thin", 0.0, 1e-8), ("none", 3.0, 3.0)]
    rows = spark.createDataFrame([*values, (99, None)], "n INT, value DOUBLE")
    lookup = spark.createDataFrame([*bands, ("half", None, 1.0)], "band STRING, lower DOUBLE, upper DOUBLE")
    joined = joins.band_join(rows, lookup, "value", loop_rows=loop_rows)
    found = sorted([(r.n, r.band) for r in joined.collect()], key=repr)
    assert found == sorted([*_by_hand(values, bands), (99, None)], key=repr)


def test_few_bands_use_no_shuffle(spark):
    rows = spark.range(100).withColumn("value", F.col("id").cast("double"))
    bands = spark.createDataFrame([("low", 0.0, 20.0)], "band STRING, lower DOUBLE, upper DOUBLE")
    assert "BroadcastNestedLoopJoin" in plan_text(joins.band_join(rows, bands, "value"))
    assert "NestedLoop" not in plan_text(joins.band_join(rows, bands, "value", loop_rows=0))


def test_keyed_range_and_versions(spark, good):
    versions = spark.createDataFrame(
        [
            ("T7", "old", "2030-01-01", "2031-03-04 12:00:00", False),
            ("T7", "new", "2031-03-04 12:00:00", None, True),
            ("K2", "late", "2032-01-01", None, True),
        ],
        "product_id STRING, category STRING, valid_from STRING, valid_to STRING, is_current BOOLEAN",
    ).withColumns({c: F.to_timestamp(c) for c in ("valid_from", "valid_to")})
    at = joins.version_at(good, versions, "product_id", "sold_at")
    assert {r.sale_id: r.category for r in at.collect()} == {
        "a1": "old", "a2": "new", "a3": None, "a4": None
    }
    keyed = joins.keyed_range_join(
        good, versions, "product_id", "sold_at", "valid_from", "valid_to"
    )
    assert {r.sale_id: r.category for r in keyed.collect()}["a1"] == "old"
    assert "NestedLoop" not in plan_text(keyed)
    current = joins.current_versions(versions)
    assert "is_current" not in current.columns
    assert quality.repeated_keys(current, "product_id").isEmpty()


def test_pair_with_values(spark):
    paired = joins.pair_with_values(spark.range(3), "size", ["s", "m"], "string")
    assert paired.count() == 6
    assert "Join" not in plan_text(paired)
    with pytest.raises(ValueError):
        joins.pair_with_values(spark.range(3), "n", range(2000), "int")


def test_strategies_show_in_the_plan(spark):
    left = spark.range(1000).withColumnRenamed("id", "k")
    right = spark.range(500).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    assert "SortMergeJoin" in plan_text(joins.strategy_join(left, right, "k", "left", "merge"))
    assert "ShuffledHashJoin" in plan_text(
        joins.strategy_join(left, right, "k", "left", "shuffle_hash")
    )
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan_text(joins.broadcast_join(left, right, "k"))
        too_big = joins.broadcast_join(left, right, "k", max_rows=100)
        assert "BroadcastHashJoin" not in plan_text(too_big)
        assert too_big.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    with pytest.raises(ValueError):
        joins.broadcast_join(left, right, "k", "full")
    with pytest.raises(ValueError):
        joins.strategy_join(left, right, "k", "left", "guess")


def test_fits_broadcast_counts_rows_and_bytes(spark):
    side = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("s"), F.lit(None).alias("n"))
    assert joins.fits_broadcast(side)
    assert not joins.fits_broadcast(side, max_rows=9)
    assert not joins.fits_broadcast(side, max_bytes=9000)
    assert joins.fits_broadcast(side.where("false"), max_rows=0)
