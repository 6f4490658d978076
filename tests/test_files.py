import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace import scratch
from millrace.operators.quality import same_rows
from millrace.sinks import files
from millrace.sources import tables


def test_write_once_refuses_to_replace(raw, tmp_path):
    path = str(tmp_path / "out")
    files.write_once(raw, path)
    with pytest.raises(AnalysisException):
        files.write_once(raw, path)
    assert same_rows(raw, tables.read_parquet(raw.sparkSession, path))


def test_csv_keeps_spaces_and_nulls(raw, tmp_path):
    path = files.write_csv(raw, str(tmp_path / "csv"))
    back = tables.read_csv(raw.sparkSession, path, raw.schema)
    assert same_rows(raw, back)


def test_empty_csv_field_is_null(spark, tmp_path):
    (tmp_path / "in.csv").write_text("a,b\n1,\n,x\n")
    rows = tables.read_csv(spark, str(tmp_path / "in.csv"), "a STRING, b STRING").collect()
    assert {tuple(r) for r in rows} == {("1", None), (None, "x")}


def test_text_ranges_literals_and_tables(spark, tmp_path):
    (tmp_path / "in.txt").write_text("one\n\ntwo words\n")
    assert [r.value for r in tables.read_text(spark, str(tmp_path / "in.txt")).collect()] == [
        "one",
        "",
        "two words",
    ]
    assert [r.id for r in tables.numbered(spark, 3).collect()] == [0, 1, 2]
    tables.literal_rows(spark, [(1, "x")], "a INT, b STRING").createOrReplaceTempView("pairs")
    assert tables.read_table(spark, "pairs").first().b == "x"


def test_verified_write_and_audit(raw, tmp_path):
    stored = files.write_verified(raw, str(tmp_path / "verified"))
    assert stored.count() == 11
    report, audit = files.write_with_audit(raw.limit(1), raw, str(tmp_path / "both"))
    spark = raw.sparkSession
    assert spark.read.parquet(report).count() == 1
    assert same_rows(raw, spark.read.parquet(audit))


def test_few_files(spark, tmp_path):
    path = files.write_in_files(spark.range(0, 100, 1, 8), str(tmp_path / "few"), 2)
    stored = spark.read.parquet(path).select(F.input_file_name().alias("f"))
    assert stored.distinct().count() == 2


def test_an_arrival_is_published_once(raw, tmp_path):
    landing = str(tmp_path / "landing")
    files.publish_arrival(raw, landing, "01")
    with pytest.raises(FileExistsError):
        files.publish_arrival(raw, landing, "01")
    assert raw.sparkSession.read.parquet(f"{landing}/*").count() == 11


def test_a_failed_delivery_can_be_repeated_and_is_never_seen(raw, tmp_path):
    landing = str(tmp_path / "landing")
    files.publish_arrival(raw, landing, "01")
    broken = raw.withColumn("sale_id", F.raise_error(F.lit("lost on the way")))
    with pytest.raises(Exception, match="lost on the way"):
        files.publish_arrival(broken, landing, "02")
    assert raw.sparkSession.read.parquet(f"{landing}/*").count() == 11
    files.publish_arrival(raw, landing, "02")
    assert raw.sparkSession.read.parquet(f"{landing}/*").count() == 22


def test_other_rows_read_back_are_noticed(spark, tmp_path):
    from millrace.operators.quality import row_marks

    marks = [f.agg(*row_marks(f)).first() for f in (spark.range(9), spark.range(9).orderBy(F.desc("id")), spark.range(1, 10))]  # noqa: E501
    assert marks[0] == marks[1] != marks[2]
    mapped = spark.sql("SELECT map('a', id, 'b', 2) AS m FROM range(5)")
    assert files.write_verified(mapped, str(tmp_path / "maps")).count() == 5


def test_scratch_uses_the_folder_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert scratch.shared_folder(spark) == named
    first, second = scratch.fresh_folder(spark, "x"), scratch.fresh_folder(spark, "x")
    assert first != second and first.startswith(named)
    cut = scratch.cut_lineage(spark.range(5).withColumn("y", F.col("id") * 2))
    assert cut.agg(F.sum("y")).first()[0] == 20


def test_only_intermediate_results_are_discarded(spark, tmp_path):
    cut = scratch.cut_lineage(spark.range(5))
    scratch.discard(cut)
    with pytest.raises(Exception, match="(?i)exist"):
        spark.read.parquet(*cut.inputFiles()).count()
    kept = spark.read.parquet(files.write_once(spark.range(5), str(tmp_path / "kept")))
    with pytest.raises(ValueError, match="intermediate"):
        scratch.discard(kept)
    assert kept.count() == 5


class _Session:
    """Just enough of a session to ask for its folder."""

    def __init__(self, master, named=None):
        self.conf = self
        self.named = named
        self.sparkContext = self
        self.master = master
        self.applicationId = f"app-{master}"

    def get(self, _name, default):
        return self.named or default


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_folder(_Session("yarn"))
    assert scratch.shared_folder(_Session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    local = scratch.shared_folder(_Session("local[2]"))
    assert scratch.shared_folder(_Session("local[2]")) == local
