"""Training-data pipeline: toxicity, exact dedup, SimHash near-dedup, benchmark decontamination, best-fit packing.

Nulls, empty and repeated rows, empty tables and extra columns are treated as the stages' operators say; all stages but
the last return the columns of their input as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewell.llm import decontaminate, exact_dedup, packing, simhash, toxicity
from tidewell.llm.common import saved, table
from tidewell.llm.queries import held_out


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5; the model is fitted as in the toxicity query, on the table ``documents`` of ``sf_dir``."""
    model = toxicity.fit(table(spark, sf_dir, "documents").where(~held_out(5, 0)), table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def remove_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text, the one with the largest doc_id."""
    return exact_dedup.drop_copies(docs)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints, the one with the smallest doc_id."""
    return simhash.keep_one(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no item of ``benchmark``."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its bin; every document kept so far is packed whole."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", remove_toxic),
    ("exact_dedup", remove_copies),
    ("simhash", remove_near_copies),
    ("decontamination", remove_benchmark),
    ("packing", pack_sequences),
]

#: SQL cannot train dictionaries or pack bins; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
