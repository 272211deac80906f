"""From raw documents to packed sequences in five stages, each on all rows the last one kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is written as
Parquet to the shared folder and read again as the next one's documents. All but the last return
the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsieve.llm import exact_dedup, language_id, mixing, packing, simhash
from flowsieve.llm.common import held_out, read_table, stored
from flowsieve.llm.registry import vocabulary_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a letter, or beyond what texts of their language reach, go.
    A missing language becomes the predicted one."""
    labelled = docs.filter(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang")
    found = language_id.identify(docs.select(*COLUMNS), language_id.fit(labelled))
    kept = found.filter(~F.col("rejected")).withColumn("lang", F.coalesce("lang", "lang_pred"))
    return kept.select(*COLUMNS)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of equal texts the row with the smallest doc_id stays."""
    return exact_dedup.drop_duplicates(docs.select(*COLUMNS))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash: of each component the document with the smallest doc_id stays."""
    return simhash.drop_near_duplicates(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: documents as often, and as much of them, as their source's target takes."""
    return mixing.mixed_documents(docs.select(*COLUMNS))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: every piece of every taken document with its sequence and its place there."""
    return packing.pack_documents(docs, vocabulary_path())


STAGES = [
    ("language_id", keep_identified),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Fingerprints, language models and token ids are beyond SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; the last one's rows."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
