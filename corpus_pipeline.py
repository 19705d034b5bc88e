"""The corpus pipeline: each stage applies one operator to all that the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodemark.llm import jaccard, langid, packing, quality, spans
from lodemark.llm.common import WORD
from lodemark.sources.scans import Scratch

# Compression bands, the mixture's random-like rejects and the packing order have no SQL form; tests use a brute-force version.
ORACLE_SQL = None
CAPACITY = 2048


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go, null, empty and blank texts among them. Each row is judged by itself, so ties and repeated rows need no
    rule; an empty table stays empty. Measures replace input columns of their name inside the operator only."""
    return quality.compression_bands(docs, "text").where("kept").select(*docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, null texts among them. Texts in several languages stay, whatever their shares.

    Where no document has both a text and a language, nothing can be learned and every document stays. Each row is judged by
    itself, so ties and repeated rows need no rule; an empty table stays empty. The operator's own columns do not reach the result.
    """
    languages = langid.learn(docs.where(langid.fold("doc_id") != 1), "text", "lang")
    if not languages.names:
        return docs
    judged = langid.infer(docs, "text", languages, carry=docs.columns)
    return judged.where(F.col("lang_pred") != langid.UNDETERMINED).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest id stays. Rows with one id stay or go together."""
    groups = jaccard.similar_groups(docs, "doc_id", "text")
    extra = groups.where("component_id <> id").select(F.col("id").alias("doc_id")).distinct()
    return docs.join(extra, "doc_id", "left_anti").select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sentences that occurred before go; a document that has none of its own goes with them. n_chars follows the text.

    A null text stays. The first occurrence has the smallest id, a null id before all; fully repeated rows are one occurrence
    and stay equal. An empty table stays empty. The operator's counts do not reach the result.
    """
    cleaned = spans.drop_repeated_spans(docs, "doc_id", "text", both_ends=True)
    kept = cleaned.where((F.col("n_removed") == 0) | F.col("text").rlike(WORD))
    return kept.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long")).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in bins of CAPACITY words. A null or empty text has no words and a piece of length 0;
    repeated rows are pieces of their own; ties follow the operator's order. An empty table gives no bins."""
    rows = docs.select("doc_id", "source", F.regexp_count("text", F.lit(WORD)).alias("n_words"), F.md5("text").alias("cluster"))
    return packing.pack(rows, "doc_id", F.col("n_words"), "source", F.col("cluster"), CAPACITY)


STAGES = [("quality_rules", quality_rules), ("language_id", language_id), ("near_duplicates", near_duplicates),
          ("repeated_passages", repeated_passages), ("best_fit_packing", best_fit_packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each one's rows are written before the next reads them."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir))
    return docs
