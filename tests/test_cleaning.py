from decimal import Decimal

from pyspark.sql import functions as F

from millrace.functions import expressions as ex
from millrace.operators import cleaning


def column(spark, value, build, kind="STRING"):
    frame = spark.createDataFrame([(value,)], f"v {kind}")
    return frame.select(build(F.col("v")).alias("r")).first()["r"]


def test_keys_and_labels(spark):
    assert column(spark, "  aB1 ", ex.lookup_key) == "AB1"
    assert column(spark, "  aB1 ", ex.tidy_label) == "ab1"
    assert column(spark, None, ex.lookup_key) is None
    assert column(spark, "\tx", ex.lookup_key) == "\tX", "only spaces are trimmed"


def test_amounts_parse_or_become_null(spark):
    cases = {
        "25": Decimal("25.00"),
        " 25.5 ": Decimal("25.50"),
        "-0.01": Decimal("-0.01"),
        "25.005": Decimal("25.01"),
        "oops": None,
        "": None,
        "1,5": None,
        "12345678901.00": None,
        None: None,
    }
    for text, wanted in cases.items():
        assert column(spark, text, ex.parse_amount) == wanted, text


def test_times_must_fit_the_pattern(spark):
    for text in ("2031-02-30 00:00:00", "2031-3-04 00:00:00", "2031-03-04", "2031-03-04 00:00:00.5"):
        assert column(spark, text, ex.parse_time) is None, text
    parsed = column(spark, "2031-03-04 05:06:07", lambda c: ex.parse_time(c).cast("string"))
    assert parsed == "2031-03-04 05:06:07"


def test_pieces_take_the_separator_literally(spark):
    frame = spark.createDataFrame([("a|b||c",)], "v STRING")
    assert [r[0] for r in frame.select(ex.pieces(F.col("v"), "|")).collect()] == ["a", "b", "", "c"]


def test_first_failure_keeps_the_order_of_checks(spark):
    frame = spark.range(4).select(
        ex.first_failure([(F.col("id") > 2, "large"), (F.col("id") > 0, "positive")]).alias("r")
    )
    assert [r.r for r in frame.collect()] == [None, "positive", "positive", "large"]


def test_clean_sales_explains_every_row_once(raw):
    cleaned = cleaning.clean_sales(raw)
    found = {r.sale_id: r.reject_reason for r in cleaned.collect()}
    assert found == {
        "a1": None,
        "a2": None,
        "a3": None,
        "a4": None,
        "a5": "invalid or missing amount",
        "a6": "invalid or missing amount",
        "a7": "invalid or missing timestamp",
        "a8": "invalid or missing timestamp",
        "a9": "missing product key",
        "b1": "missing product key",
        "b2": "invalid or missing amount",
    }
    assert cleaned.columns == [*raw.columns, "amount", "sold_at", "reject_reason"]


def test_raw_values_and_input_survive(raw):
    cleaned = cleaning.clean_sales(raw)
    assert cleaned.select("amount_raw", "sold_at_raw").exceptAll(
        raw.select("amount_raw", "sold_at_raw")
    ).isEmpty()
    assert raw.where("sale_id = 'a1'").first().product_id == " t7 "
    assert cleaning.rejected(cleaned).count() == 7
    assert cleaning.accepted(cleaned).count() == 4


def test_clean_lookup_keeps_the_grain(products):
    rows = {tuple(r) for r in cleaning.clean_lookup(products).collect()}
    assert rows == {("T7", "tools"), ("K2", "kitchen"), ("Q1", "garden")}


def test_other_column_names(raw):
    names = cleaning.SalesColumns(key="sku", amount="price", reason="why")
    cleaned = cleaning.clean_sales(raw.withColumnRenamed("product_id", "sku"), names)
    assert cleaned.where("why is null").agg(F.sum("price")).first()[0] == Decimal("116.65")


def test_reshape_columns(raw):
    shaped = cleaning.reshape_columns(
        raw,
        add={"key_text": ex.lookup_key(F.col("product_id"))},
        rename={"amount_raw": "as_delivered"},
        drop=["sold_at_raw"],
    )
    assert shaped.columns == ["sale_id", "product_id", "as_delivered", "key_text"]
    assert shaped.count() == raw.count()
