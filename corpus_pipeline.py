"""The corpus pipeline: language ID, line dedup, near-dedup, packing, each over all that the stage before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from spendwatch.llm import langid, linedup, neardup, packing
from spendwatch.llm.common import free_name, shared_path
from spendwatch.llm.queries import TOKENIZER


def _of_documents(docs: DataFrame, kept: DataFrame) -> DataFrame:
    return kept.select(*(F.col(f"`{c}`") for c in docs.columns))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known and codes them well; a missing lang is filled in, a given one stays."""
    judged = langid.predict(docs, langid.train(docs)).where(langid.accepted())
    return _of_documents(docs, judged.withColumn("lang", F.coalesce("lang", "lang_pred")))


def delete_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of line runs, n_chars anew; a document that held nothing else goes."""
    cut = linedup.delete_repeats(docs).where("n_deleted = 0 or n_deleted < n_lines")
    changed = F.when(F.col("n_deleted") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return _of_documents(docs, cut.withColumn("n_chars", changed))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (similarity 0.8 or more), the one with the smallest id.

    Rows that are equal in id and text are one document, of which any row stays; rows that share an id only are documents
    of their own, as are those without an id.
    """
    key = free_name(docs, "key")
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    groups = neardup.near_duplicates(keyed.select(key, "text"), id_column=key, percent=80).select(key, "component_id")
    first = (keyed.select(key, F.col("doc_id").alias("id")).join(groups.distinct(), key)
             .groupBy("component_id").agg(F.min(F.struct("id", key)).alias("first")))
    return keyed.join(first.select(F.col(f"first.{key}").alias(key)), key, "left_semi").dropDuplicates([key]).drop(key)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 ids."""
    pieces = packing.pack(docs, TOKENIZER)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


STAGES = [("language ID", identify_language), ("line dedup", delete_repeated_lines),
          ("MinHash near-dedup", drop_near_duplicates), ("packing", pack_documents)]

# Neither trained models nor subword ids can be written in SQL: the tests compare with plain versions of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents; each stage's rows are written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_path(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
