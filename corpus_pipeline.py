"""Corpus pipeline: documents -> quality classifier -> line dedup -> SimHash near-dedup ->
mixing to target weights -> BPE encoding and decoding.

Each stage works on all rows its predecessor kept; its result is written as Parquet and read
again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow.llm import common, line_dedup, mixing, quality, queries, simhash
from winnow.session import read_table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier rejects go; it learns from the labelled
    documents that are not held out."""
    common.prepare(spark)
    labels = read_table(spark, sf_dir, "labels").filter(~quality.held_out(F.col("doc_id")))
    scored = quality.classify(docs, quality.fit(docs, labels))
    return scored.filter("__predicted = 1").select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines and lines similar to earlier ones go from the texts; ``n_chars`` follows the text; every row stays."""
    common.prepare(spark)
    out = line_dedup.dedup_lines(docs, any_bits=True)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    common.prepare(spark)
    return simhash.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that the sources come near their targets."""
    common.prepare(spark)
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per document of the mix: token count and digests of its ids and of the decoded text."""
    common.prepare(spark)
    return queries.encoded_digests(spark, docs)


STAGES = [("quality_classifier", keep_quality), ("line_dedup", dedup_lines), ("simhash_near_dedup", near_dedup),
          ("mix_sources", mix), ("bpe_encode_decode", encode)]

#: XXH64, zstandard, edit distance and BPE are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    common.prepare(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
