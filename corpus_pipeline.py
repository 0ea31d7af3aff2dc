"""The corpus pipeline: documents to token ids in five stages, each an operator of `shelfwise.llm`.

A stage takes (spark, docs, sf_dir) and returns the documents that go on, with the columns of `documents`; the last one
adds token ids. Stages are written as Parquet and read again in between. No stage fails on nulls, empty or repeated
rows or an empty table: what each makes of them is said where its operator is defined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import bpe, decontaminate, langid, line_dedup, ngram_join
from shelfwise.llm.common import Scratch, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts get the language they are in; those without letter, or far from every language, go."""
    found = langid.identify(docs.select(COLUMNS), langid.fit(docs))
    return found.where(~F.col("rejected")).withColumn("lang", F.col("lang_pred")).select(COLUMNS)


def site_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that too many documents of a source share go; n_chars follows."""
    return line_dedup.drop_site_lines(docs.select(COLUMNS)).withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by n-gram similarity the one with the smallest id stays, once."""
    scratch = Scratch(spark, "copies")
    groups = scratch.put(ngram_join.join(docs))
    gone = groups.where("doc <> component_id").select(F.col("doc").alias("doc_id")).distinct()
    kept = docs.select(COLUMNS).join(gone, "doc_id", "left_anti")
    again = groups.where("doc IS NOT NULL").groupBy("doc").count().where("count > 1").select(F.col("doc").alias("doc_id"))
    if again.isEmpty():
        return kept
    once = kept.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.join(again, "doc_id", "left_anti").unionByName(once).select(COLUMNS)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.with_hits(docs.select(COLUMNS), table(spark, sf_dir, "benchmark")).where(~F.col("contaminated")).select(COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, as 32-bit little-endian integers."""
    return bpe.encode(docs.select(COLUMNS)).drop("decoded")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", site_lines),
    ("ngram_jaccard_join", near_copies),
    ("benchmark_decontamination", without_benchmark),
    ("bpe_encoding", tokens),
]

#: Language identification and n-gram components are beyond SQL; tests/llm compares the rows with a plain program's.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = scratch.put(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
