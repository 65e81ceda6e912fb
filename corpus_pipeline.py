"""A corpus pipeline of five stages: each takes (spark, docs, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kinweave.llm import decontaminate, language_id, mixing, near_copies, token_store
from kinweave.llm.common import read, scratch


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents whose language is not recognised; all columns stay as they are.

    Texts without a letter, null ones included, go.  Long texts are read whole,
    repeated rows are each judged alike.  With no labelled row to learn from
    nothing is recognised and all go; an empty table stays empty.
    """
    return language_id.keep_identified(docs, language_id.train(docs))


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: the smallest doc_id, then the smallest text hash.

    A null doc_id comes last; rows that share a doc_id but not a text are
    documents of their own; null and empty texts are one group; an empty table
    stays empty.
    """
    return near_copies.keep_one(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item.

    Null and empty texts stay, repeated rows go or stay together, null items
    match nothing; an empty table or benchmark drops nothing.
    """
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixes the sources to their weights: documents go, stay, or repeat up to three times.

    A null source is a source of its own, the last; texts without a word go, as
    the mix takes no word of them; equal rows are documents of their own; an
    empty table stays empty.
    """
    return mixing.mixed_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token ids of the mix and returns their digest, one row for each row of ``docs``.

    A null text has the end id only, null doc_ids come first, and repeated
    doc_ids follow each other; an empty table gives no row.
    """
    return token_store.token_output(docs, token_store.tokenizer_path(), checksum=True)


STAGES = [("language_id", language_stage), ("simhash_near_copies", near_copy_stage), ("benchmark_decontamination", benchmark_stage), ("source_mixing", mixing_stage), ("token_output", token_stage)]

#: Fitted models, fingerprints and a tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and reread as the next one's input.

    Nulls, repeats and empty tables are as each stage says; other columns pass
    through to the last stage, which returns its own.
    """
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = scratch(spark, f"stage-{name}")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
