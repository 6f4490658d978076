"""From raw documents to packed token sequences: five stages, each stored and read by the next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import language, neardup, packing, secrets, substrings
from millrace.scratch import cut_lineage
from millrace.session import prepare


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, with a null text, or of an ambiguous language go."""
    told = language.predict(_bundled(docs, "doc_id", "text", "lang"), carry=("text", "row"))
    known = (F.col("lang_pred") != language.UNKNOWN) & ~F.col("ambiguous")
    return _documents(told.where(known), docs, F.col("text"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document with the smallest id stays.

    A document with a null id stays. Rows that share an id stay or go together.
    """
    gone = neardup.classes(docs).where("not kept").select("doc_id").distinct()
    return neardup.among(docs, cut_lineage(gone, "copies"), "left_anti").select(*docs.columns)


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut out; a document with nothing left goes."""
    told = substrings.remove_repeats(
        _bundled(docs, "doc_id", "text"), results=("n_words", "n_removed", "kept_text"), carry=("row",)
    )
    told = told.where("n_removed = 0 or n_removed < n_words")
    return _documents(told, docs, F.col("kept_text"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; all documents stay."""
    told = secrets.scan(_bundled(docs, "text"), carry=("row",), mask=True)
    return _documents(told, docs, F.col("masked"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of full sequences, in the mixture of sources that the documents have."""
    return packing.pack(docs)


def _bundled(docs: DataFrame, *used: str) -> DataFrame:
    """The columns an operator reads, and all but the text as one, safe from its results' names."""
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row")
    return docs.select(*used, rest)


def _documents(told: DataFrame, docs: DataFrame, text: Column) -> DataFrame:
    """The columns of documents again, with this text and its length."""
    new = {"text": text, "n_chars": F.char_length(text).cast("long")}
    return told.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


STAGES = [
    ("language", identify),
    ("near_dedup", drop_copies),
    ("substring_dedup", drop_passages),
    ("secrets", mask_secrets),
    ("packing", pack),
]

#: Learnt models, sampled hashes and token ids have no SQL; the tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
