"""Queries that clean, split and check the messy sales."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog import data
from millrace.catalog.data import with_sales
from millrace.functions.expressions import lookup_key
from millrace.operators import quality
from millrace.operators.cleaning import accepted, rejected, reshape_columns
from millrace.operators.joins import enrich, totals_through_lookup
from millrace.operators.reports import category_totals, daily_totals_through_lookup


def clean_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data.cleaned(spark, sf_dir)


def clean_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data.lookup(spark, sf_dir)


def accepted_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accepted(data.cleaned(spark, sf_dir))


def rejected_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected(data.cleaned(spark, sf_dir))


def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.reasons(rejected(data.cleaned(spark, sf_dir)))


def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.reconcile(data.cleaned(spark, sf_dir))


def split_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The accepted side is checked as if duplicated by the careless lookup."""
    cleaned = data.cleaned(spark, sf_dir)
    doubled = data.doubled_lookup(spark, sf_dir)
    multiplied = accepted(cleaned).join(doubled, "product_id", "left")
    return quality.split_problems(data.sales(spark, sf_dir), multiplied, rejected(cleaned))


def project_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")


def project_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = data.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    return reshape_columns(
        parts,
        add={"footprint": F.col("p_size") * F.col("p_size")},
        rename={"p_brand": "maker"},
        drop=["p_name"],
    )


def filter_gt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data.table(spark, sf_dir, "orders").where(F.col("o_totalprice") > 250000).select(
        "o_orderkey", "o_totalprice"
    )


def filter_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data.table(spark, sf_dir, "part").where(F.col("p_type") == "PROMO").select(
        "p_partkey", "p_name", "p_type"
    )


def filter_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = data.table(spark, sf_dir, "part").withColumn("is_large", F.col("p_size") > 25)
    return parts.where(F.col("is_large")).select("p_partkey", "p_size")


def input_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.input_summary(data.sales(spark, sf_dir), data.RAW_SALES_DDL)


def lookup_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The doubled lookup, with the keys of one category emptied, must be found faulty."""
    faulty = data.doubled_lookup(spark, sf_dir).withColumn(
        "product_id",
        F.when(F.col("category") == "machinery", F.lit("")).otherwise(F.col("product_id")),
    )
    return quality.lookup_problems(faulty)


def blank_lookup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw sales whose key is null or empty once trimmed."""
    trimmed = data.sales(spark, sf_dir).withColumn("product_id", lookup_key(F.col("product_id")))
    return quality.blank_keys(trimmed).select("sale_id", "product_id")


def repeated_lookup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.repeated_keys(data.doubled_lookup(spark, sf_dir), "product_id")


def population_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An inner join loses sales without a category and the doubled lookup repeats others."""
    good = data.good_sales(spark, sf_dir)
    joined = good.join(data.doubled_lookup(spark, sf_dir), "product_id")
    return quality.population(good, joined)


def totals_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, lookup = data.good_sales(spark, sf_dir), data.lookup(spark, sf_dir)
    return quality.totals_kept(good, daily_totals_through_lookup(good, lookup))


def totals_kept_fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts of four digits against the same rounded to two: what the rounding lost, exactly."""
    good = data.good_sales(spark, sf_dir)
    fine = good.select((F.col("amount") + F.lit("0.0007").cast("decimal(12,4)")).alias("amount"))
    return quality.totals_kept(fine, good.select(F.col("amount").alias("total")))


def report_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The right report against the one a doubled lookup gives: one category differs."""
    good = data.good_sales(spark, sf_dir)
    right = totals_through_lookup(good, data.lookup(spark, sf_dir))
    wrong = totals_through_lookup(good, data.doubled_lookup(spark, sf_dir))
    return quality.report_differences(right, wrong)


def row_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.row_differences(
        data.doubled_lookup(spark, sf_dir), data.lookup(spark, sf_dir)
    )


def enriched_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(data.good_sales(spark, sf_dir), data.lookup(spark, sf_dir))


def category_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals_through_lookup(data.good_sales(spark, sf_dir), data.lookup(spark, sf_dir))


def category_report_by_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report the long way: label every sale, then sum."""
    return category_totals(enriched_sales(spark, sf_dir))


QUERIES = {
    "clean_sales": clean_sales,
    "clean_lookup": clean_lookup,
    "accepted": accepted_sales,
    "rejected": rejected_sales,
    "reject_reasons": reject_reasons,
    "reconcile": reconcile,
    "split_problems": split_problems,
    "project_names": project_names,
    "project_derived": project_derived,
    "filter_gt": filter_gt,
    "filter_eq": filter_eq,
    "filter_flag": filter_flag,
    "input_contract": input_contract,
    "lookup_check": lookup_check,
    "blank_lookup_keys": blank_lookup_keys,
    "repeated_lookup_keys": repeated_lookup_keys,
    "population_check": population_check,
    "totals_kept": totals_kept,
    "totals_kept_fine": totals_kept_fine,
    "report_differences": report_differences,
    "row_differences": row_differences,
    "enriched_sales": enriched_sales,
    "category_report": category_report,
    "category_report_by_row": category_report_by_row,
}

CLEANED_COLUMNS = """sale_id, product_id, amount_raw, sold_at_raw,
  CAST(amount AS DOUBLE) AS amount, sold_at, reject_reason"""
CATEGORY_REPORT_SQL = with_sales(
    """SELECT category, count(*) AS sales, CAST(sum(amount) AS DOUBLE) AS total
FROM enriched GROUP BY category"""
)

SQL = {
    "clean_sales": with_sales(f"SELECT {CLEANED_COLUMNS} FROM cleaned"),
    "clean_lookup": with_sales("SELECT product_id, category FROM lookup"),
    "accepted": with_sales(f"SELECT {CLEANED_COLUMNS} FROM cleaned WHERE reject_reason IS NULL"),
    "rejected": with_sales(
        f"SELECT {CLEANED_COLUMNS} FROM cleaned WHERE reject_reason IS NOT NULL"
    ),
    "reject_reasons": with_sales(
        """SELECT reject_reason, count(*) AS rejected_rows FROM cleaned
WHERE reject_reason IS NOT NULL GROUP BY reject_reason"""
    ),
    "reconcile": with_sales(
        """SELECT count(*) AS input_rows, count(*) FILTER (WHERE reject_reason IS NULL) AS accepted_rows,
  count(*) FILTER (WHERE reject_reason IS NOT NULL) AS rejected_rows FROM cleaned"""
    ),
    "split_problems": with_sales(
        """SELECT sale_id, CAST(1 AS BIGINT) AS input_rows, CAST(2 AS BIGINT) AS accepted_rows,
  CAST(0 AS BIGINT) AS rejected_rows FROM enriched WHERE category = 'building'"""
    ),
    "project_names": "SELECT o_orderkey, o_totalprice FROM orders",
    "project_derived": """SELECT p_partkey, p_brand AS maker, p_size, p_size * p_size AS footprint
FROM part""",
    "filter_gt": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 250000",
    "filter_eq": "SELECT p_partkey, p_name, p_type FROM part WHERE p_type = 'PROMO'",
    "filter_flag": "SELECT p_partkey, p_size FROM part WHERE p_size > 25",
    "input_contract": with_sales(
        "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS schema_problems FROM sales"
    ),
    "lookup_check": with_sales(
        """SELECT (SELECT count(*) FROM doubled WHERE category = 'machinery') AS blank_key_rows,
  (SELECT count(*) FROM (
     SELECT CASE WHEN category = 'machinery' THEN '' ELSE product_id END AS k
     FROM doubled GROUP BY k HAVING count(*) > 1)) AS repeated_keys"""
    ),
    "blank_lookup_keys": with_sales(
        """SELECT sale_id, product_id FROM parsed WHERE product_id IS NULL OR product_id = ''"""
    ),
    "repeated_lookup_keys": with_sales(
        """SELECT product_id, count(*) AS copies FROM doubled GROUP BY product_id
HAVING count(*) > 1"""
    ),
    "population_check": with_sales(
        """SELECT count(*) FILTER (WHERE category = 'unmapped') AS lost_keys,
  CAST(0 AS BIGINT) AS invented_keys,
  count(*) FILTER (WHERE category = 'building') AS recounted_keys FROM enriched"""
    ),
    "totals_kept": with_sales(
        """SELECT CAST(sum(amount) AS DOUBLE) AS total_before, CAST(sum(amount) AS DOUBLE) AS total_after,
  CAST(0 AS DOUBLE) AS difference FROM good"""
    ),
    "totals_kept_fine": with_sales(
        """SELECT CAST(sum(fine) AS DOUBLE) AS total_before, CAST(sum(rounded) AS DOUBLE) AS total_after,
  CAST(sum(fine) - sum(rounded) AS DOUBLE) AS difference
FROM (SELECT amount + CAST(0.0007 AS DECIMAL(12,4)) AS fine, amount AS rounded FROM good)"""
    ),
    "report_differences": with_sales(
        "SELECT DISTINCT category, 'differs' AS problem FROM enriched WHERE category = 'building'"
    ),
    "row_differences": with_sales(
        """SELECT product_id, category, CAST(1 AS BIGINT) AS surplus FROM lookup
WHERE category = 'building'"""
    ),
    "enriched_sales": with_sales(
        """SELECT sale_id, product_id, CAST(amount AS DOUBLE) AS amount, sold_at, category
FROM enriched"""
    ),
    "category_report": CATEGORY_REPORT_SQL,
    "category_report_by_row": CATEGORY_REPORT_SQL,
}
