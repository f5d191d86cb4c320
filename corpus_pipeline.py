"""From raw documents to packed training sequences, in four stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerostrata.llm import line_winnow, near_simhash, packing, quality_lines
from aerostrata.llm.common import stored, table


def _measured(new: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of documents, n_chars counted again where a text may have lost lines."""
    if "n_chars" in docs.columns:
        new = new.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return new.select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality rules reject and the lines they remove."""
    return _measured(quality_lines.apply_rules(docs), docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without later repeats of runs of lines; a document that loses all keeps an empty text."""
    return _measured(line_winnow.dedup_lines(docs), docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest doc_id."""
    return near_simhash.keep_one(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their tokens and their place in the packed sequences."""
    return packing.pack(docs, packing.tokenizer_path(), with_ids=True)


STAGES = [("quality rules", quality), ("line dedup", lines), ("simhash near-dedup", near), ("best-fit packing", sequences)]

# Hash functions, tokens and packing have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
