"""Corpus clean-up in stages; each works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moorline.llm.decontamination import decontaminate
from moorline.llm.line_dedup import passage_dedup, spread_dedup
from moorline.llm.near_duplicates import near_duplicates
from moorline.llm.pieces import encode
from moorline.llm.toxicity import fit, without_toxic
from moorline.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _counted_again(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the texts as they are now."""
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def _kept(cut: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of documents after a cut of lines, but for those that lost all they had."""
    emptied = (F.col("n_removed") > 0) & (F.btrim("text", F.lit(" \t\r\n")) == "")
    return _counted_again(cut.where(~F.coalesce(emptied, F.lit(False))).select(columns))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the trained model rejects go; unlabelled, empty and null texts are scored too."""
    return without_toxic(docs, fit(docs, _table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on many sites stay in one document; a document that loses all it had goes."""
    return _kept(spread_dedup(docs), docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the least id.

    Lines of over 50 words that the others still share, on however few sites, stay in one of them.
    """
    found = near_duplicates(docs).where("NOT kept").select("doc_id").distinct()
    path = scratch_path(spark, "apart")
    docs.join(found, "doc_id", "left_anti").select(docs.columns).write.parquet(path)
    return _kept(passage_dedup(spark.read.schema(docs.schema).parquet(path)), docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out of the texts; every document stays."""
    return _counted_again(decontaminate(docs, _table(spark, sf_dir, "benchmark")))


def sentence_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token numbers instead of texts, and whether decoding gives each text again."""
    return encode(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("sentence pieces", sentence_pieces),
]

# A trained score and similarity components are not SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
