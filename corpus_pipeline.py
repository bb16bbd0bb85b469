"""From raw documents to packed training sequences, stage by stage.

Each stage takes what its predecessor kept, as a table read back from Parquet. All but the last
return the columns of ``documents``; the last returns one row per packed piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnloom.llm import decontaminate, exact, language_id, near_dup, packing
from turnloom.llm.common import materialize
from turnloom.sources.shared import free_since, scratch_mark

#: Near copies are linked from this similarity on, in hundredths; the 85 of op8 is that query's own.
NEAR_SIMILARITY = 80


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that are like no language of the labelled rows, among them null and empty ones
    and all without letters; rows that stay without a language get the predicted one.

    Repeated rows are judged alike and all stay. Where no row is labelled nothing can be identified,
    so an empty table stays empty and no document is kept. Extra columns pass through."""
    model = language_id.train_language_model(language_id.training_rows(docs, F.lit(False)))
    return language_id.drop_unidentified(docs, model, lang_col="lang")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays; null counts as empty. Of rows with equal
    ids and texts one stays. Extra columns pass through."""
    return exact.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked texts the one with the smallest id stays. Texts without words and rows without an
    id stay; so do rows that share a kept id. Extra columns pass through."""
    return near_dup.drop_near_duplicates(docs, similarity=NEAR_SIMILARITY)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item; null texts hold none. Repeated rows
    are judged alike. Extra columns pass through."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of all documents in sequences of at most 2048, a row for each piece. Null texts count
    as empty; repeated ids are packed like others; extra columns are not read."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", identify_languages),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack_sequences),
]

#: The stages of language ID and packing have no SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; the tables of a stage are deleted once its result is stored."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    mark = scratch_mark()
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
        free_since(mark, docs)
    return STAGES[-1][1](spark, docs, sf_dir)
