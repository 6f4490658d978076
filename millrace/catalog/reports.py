"""Grouped, sorted, set and text queries, and the batch round trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog import data
from millrace.catalog.cleaning import CATEGORY_REPORT_SQL, enriched_sales
from millrace.catalog.data import with_sales
from millrace.operators import quality, reports
from millrace.operators.cleaning import accepted, rejected
from millrace.operators.joins import totals_through_lookup
from millrace.scratch import fresh_folder
from millrace.sinks import files
from millrace.sources import tables


def daily_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = reports.daily_totals_through_lookup(
        data.good_sales(spark, sf_dir), data.lookup(spark, sf_dir)
    )
    return report.orderBy("sale_date", "category")


def daily_report_by_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.daily_totals(enriched_sales(spark, sf_dir))


def group_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = data.table(spark, sf_dir, "orders")
    priced = orders.withColumn("amount", F.col("o_totalprice").cast("decimal(12,2)"))
    return reports.totals_by(priced, "o_orderpriority").select("o_orderpriority", "total")


def group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data.table(spark, sf_dir, "events").groupBy("event_type").count()


def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data.table(spark, sf_dir, "lineitem").agg(F.count("*").alias("rows"))


def agg_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.totals_by(data.good_sales(spark, sf_dir))


def agg_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sales, labelled where possible: unlabelled ones form the null group."""
    cleaned = data.cleaned(spark, sf_dir).select("product_id", "amount")
    labelled = cleaned.join(data.lookup(spark, sf_dir), "product_id", "left")
    return reports.profile_by(labelled, "category", "amount", "product_id")


def count_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data.cleaned(spark, sf_dir).agg(
        F.count("*").alias("rows"),
        F.count("amount").alias("amounts"),
        F.count("sold_at").alias("times"),
    )


def null_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data.cleaned(spark, sf_dir).groupBy("sold_at").agg(F.count(F.lit(1)).alias("sales"))


def partial_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = data.table(spark, sf_dir, "lineitem")
    priced = items.withColumn("amount", F.col("l_extendedprice").cast("decimal(12,2)"))
    return reports.totals_by(priced, "l_returnflag", "l_linestatus")


def join_then_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = data.table(spark, sf_dir, "lineitem").select(
        "l_partkey", F.col("l_extendedprice").cast("decimal(12,2)").alias("amount")
    )
    parts = data.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_type"
    )
    return totals_through_lookup(items, parts, on="l_partkey", label="p_type")


def sorted_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = data.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return reports.sorted_rows(orders, "o_orderdate")


def sorted_by_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = data.table(spark, sf_dir, "lineitem").select("l_shipdate", "l_returnflag", "l_quantity")
    return reports.sorted_rows(items, "l_shipdate", "l_returnflag")


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = data.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return reports.preview(orders, ["o_totalprice", "o_orderkey"], 5)


def calendar_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.calendar_totals(data.good_sales(spark, sf_dir))


def calendar_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar over all cleaned sales: those without a readable time are a row of their own."""
    return reports.calendar_totals(data.cleaned(spark, sf_dir))


def _in_cents(frame: DataFrame, *totals: str) -> DataFrame:
    """Totals as whole cents, which compare without rounding."""
    return frame.withColumns({t: (F.col(t) * 100).cast("bigint") for t in totals})


def category_cents(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = totals_through_lookup(data.good_sales(spark, sf_dir), data.lookup(spark, sf_dir))
    return _in_cents(report, "total")


def daily_cents(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, lookup = data.good_sales(spark, sf_dir), data.lookup(spark, sf_dir)
    return _in_cents(reports.daily_totals_through_lookup(good, lookup), "total", "largest_sale")


def partial_final_cents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _in_cents(partial_final(spark, sf_dir), "total")


def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted and rejected rows, the latter in another column order, are all rows again."""
    cleaned = data.cleaned(spark, sf_dir).select("sale_id", "product_id", "reject_reason")
    turned = rejected(cleaned).select("reject_reason", "sale_id", "product_id")
    return accepted(cleaned).unionByName(turned)


def diff_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales by key and segment, minus one sale per lookup key: multiplicities count."""
    sold = data.good_sales(spark, sf_dir).select("product_id")
    return quality.surplus_rows(sold, data.lookup(spark, sf_dir).select("product_id"))


def _part_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data.table(spark, sf_dir, "part").select(
        "p_partkey", F.concat_ws("|", "p_type", "p_brand").alias("tags_raw")
    )


def tags_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.tag_rows(_part_tags(spark, sf_dir), "p_partkey", "tags_raw")


def distinct_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tags_long(spark, sf_dir).select("tag").distinct()


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.word_count(data.table(spark, sf_dir, "documents"), "text")


def text_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as text files and counted line by line."""
    folder = fresh_folder(spark, "text")
    data.table(spark, sf_dir, "documents").select("text").write.text(folder)
    return reports.word_count(tables.read_text(spark, folder))


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = files.write_csv(data.sales(spark, sf_dir), fresh_folder(spark, "csv"))
    return tables.read_csv(spark, folder, data.RAW_SALES_DDL)


def parquet_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = totals_through_lookup(data.good_sales(spark, sf_dir), data.lookup(spark, sf_dir))
    return files.write_verified(report, fresh_folder(spark, "report"))


def report_with_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report and rejects saved side by side; the stored rejects are returned."""
    cleaned = data.cleaned(spark, sf_dir)
    report = totals_through_lookup(accepted(cleaned), data.lookup(spark, sf_dir))
    _, audit = files.write_with_audit(report, rejected(cleaned), fresh_folder(spark, "audited"))
    return tables.read_parquet(spark, audit)


def few_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily report stored in two files, which is checked on what was stored."""
    report = daily_report(spark, sf_dir)
    folder = files.write_in_files(report, fresh_folder(spark, "few"), 2)
    stored = tables.read_parquet(spark, folder)
    return stored.select(F.input_file_name().alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), (F.count_distinct("file") == 2).alias("few_files")
    )


def cached_two_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed sales kept while two results are drawn from them, then released."""
    parsed = data.cleaned(spark, sf_dir).select("amount", "reject_reason").persist()
    try:
        total = parsed.agg(F.lit("accepted").alias("part"), F.count("amount").alias("rows"))
        bad = rejected(parsed).groupBy(F.col("reject_reason").alias("part"))
        folder = fresh_folder(spark, "two-results")
        files.write_once(total, f"{folder}/result=total")
        files.write_once(bad.agg(F.count(F.lit(1)).alias("rows")), f"{folder}/result=reasons")
    finally:
        parsed.unpersist()
    return tables.read_parquet(spark, folder).select("result", "part", "rows")


QUERIES = {
    "daily_report": daily_report,
    "daily_report_by_row": daily_report_by_row,
    "group_sum": group_sum,
    "group_count": group_count,
    "row_count": row_count,
    "agg_global": agg_global,
    "agg_profile": agg_profile,
    "count_null": count_null,
    "null_group": null_group,
    "partial_final": partial_final,
    "join_then_group": join_then_group,
    "sorted": sorted_orders,
    "sorted_by_two": sorted_by_two,
    "preview": preview,
    "calendar_report": calendar_report,
    "calendar_all": calendar_all,
    "category_cents": category_cents,
    "daily_cents": daily_cents,
    "partial_final_cents": partial_final_cents,
    "union_by_name": union_by_name,
    "diff_all": diff_all,
    "tags_long": tags_long,
    "distinct_tags": distinct_tags,
    "word_count": word_count,
    "text_scan": text_scan,
    "csv_round_trip": csv_round_trip,
    "parquet_round_trip": parquet_round_trip,
    "report_with_audit": report_with_audit,
    "few_files": few_files,
    "cached_two_results": cached_two_results,
}

DAILY_SQL = with_sales(
    """SELECT CAST(CAST(sold_at AS DATE) AS TIMESTAMP) AS sale_date, category,
  CAST(sum(amount) AS DOUBLE) AS total, CAST(max(amount) AS DOUBLE) AS largest_sale
FROM enriched GROUP BY ALL"""
)
TAGS_SQL = """SELECT p_partkey, unnest(string_split(p_type || '|' || p_brand, '|')) AS tag FROM part"""

SQL = {
    "daily_report": DAILY_SQL,
    "daily_report_by_row": DAILY_SQL,
    "group_sum": """SELECT o_orderpriority,
  CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total
FROM orders GROUP BY o_orderpriority""",
    "group_count": "SELECT event_type, count(*) AS count FROM events GROUP BY event_type",
    "row_count": "SELECT count(*) AS rows FROM lineitem",
    "agg_global": with_sales(
        "SELECT count(*) AS sales, CAST(sum(amount) AS DOUBLE) AS total FROM good"
    ),
    "agg_profile": with_sales(
        """SELECT category, count(*) AS rows, count(amount) AS known,
  CAST(min(amount) AS DOUBLE) AS smallest, round(avg(amount), 6) AS mean,
  CAST(max(amount) AS DOUBLE) AS largest, count(DISTINCT c.product_id) AS distinct_values
FROM cleaned c LEFT JOIN lookup l ON c.product_id = l.product_id GROUP BY category"""
    ),
    "count_null": with_sales(
        "SELECT count(*) AS rows, count(amount) AS amounts, count(sold_at) AS times FROM cleaned"
    ),
    "null_group": with_sales("SELECT sold_at, count(*) AS sales FROM cleaned GROUP BY sold_at"),
    "partial_final": """SELECT l_returnflag, l_linestatus, count(*) AS sales,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS total
FROM lineitem GROUP BY l_returnflag, l_linestatus""",
    "join_then_group": """SELECT coalesce(p_type, 'unmapped') AS p_type, count(*) AS sales,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS total
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1""",
    "sorted": "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate",
    "sorted_by_two": """SELECT l_shipdate, l_returnflag, l_quantity FROM lineitem
ORDER BY l_shipdate, l_returnflag""",
    "preview": """SELECT o_orderkey, o_totalprice FROM orders
ORDER BY o_totalprice, o_orderkey LIMIT 5""",
    "calendar_report": with_sales(
        """SELECT CAST(d AS TIMESTAMP) AS sale_date, count(sale_id) AS sales,
  CAST(sum(amount) AS DOUBLE) AS total
FROM (SELECT unnest(generate_series(
        (SELECT min(sold_at) FROM good), (SELECT max(sold_at) FROM good), INTERVAL 1 DAY)) AS d)
LEFT JOIN good ON CAST(sold_at AS DATE) = CAST(d AS DATE) GROUP BY d"""
    ),
    "calendar_all": with_sales(
        """SELECT CAST(d AS TIMESTAMP) AS sale_date, count(sale_id) AS sales,
  CAST(sum(amount) AS DOUBLE) AS total
FROM (SELECT unnest(generate_series(date_trunc('day', (SELECT min(sold_at) FROM cleaned)),
        (SELECT max(sold_at) FROM cleaned), INTERVAL 1 DAY)) AS d)
LEFT JOIN cleaned ON CAST(sold_at AS DATE) = CAST(d AS DATE) GROUP BY d
UNION ALL
SELECT NULL, count(*), CAST(sum(amount) AS DOUBLE) FROM cleaned WHERE sold_at IS NULL
HAVING count(*) > 0"""
    ),
    "category_cents": with_sales(
        """SELECT category, count(*) AS sales, CAST(sum(amount) * 100 AS BIGINT) AS total
FROM enriched GROUP BY category"""
    ),
    "daily_cents": with_sales(
        """SELECT CAST(CAST(sold_at AS DATE) AS TIMESTAMP) AS sale_date, category,
  CAST(sum(amount) * 100 AS BIGINT) AS total, CAST(max(amount) * 100 AS BIGINT) AS largest_sale
FROM enriched GROUP BY ALL"""
    ),
    "partial_final_cents": """SELECT l_returnflag, l_linestatus, count(*) AS sales,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) * 100 AS BIGINT) AS total
FROM lineitem GROUP BY l_returnflag, l_linestatus""",
    "union_by_name": with_sales("SELECT sale_id, product_id, reject_reason FROM cleaned"),
    "diff_all": with_sales(
        "SELECT product_id FROM good EXCEPT ALL SELECT product_id FROM lookup"
    ),
    "tags_long": TAGS_SQL,
    "distinct_tags": f"SELECT DISTINCT tag FROM ({TAGS_SQL})",
    "word_count": """SELECT word, count(*) AS count
FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word""",
    "text_scan": """SELECT word, count(*) AS count
FROM (SELECT unnest(string_split_regex(text, '[ \n]')) AS word FROM documents) GROUP BY word""",
    "csv_round_trip": with_sales("SELECT sale_id, product_id, amount_raw, sold_at_raw FROM sales"),
    "parquet_round_trip": CATEGORY_REPORT_SQL,
    "report_with_audit": with_sales(
        """SELECT sale_id, product_id, amount_raw, sold_at_raw, CAST(amount AS DOUBLE) AS amount,
  sold_at, reject_reason FROM cleaned WHERE reject_reason IS NOT NULL"""
    ),
    "few_files": f"SELECT count(*) AS rows, true AS few_files FROM ({DAILY_SQL})",
    "cached_two_results": with_sales(
        """SELECT 'total' AS result, 'accepted' AS part, count(amount) AS rows FROM cleaned
UNION ALL
SELECT 'reasons', reject_reason, count(*) FROM cleaned WHERE reject_reason IS NOT NULL
GROUP BY reject_reason"""
    ),
}
