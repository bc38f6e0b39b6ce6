"""Corpus pipeline: toxicity, exact and near copies, decontamination and packing.

Each stage takes the rows its predecessor kept and returns the rows it keeps with the columns
of ``documents``; the last one returns the packed pieces. Between stages the rows are written
as Parquet and read again, so a lost executor costs a file read. The pipeline has no SQL: the
field, the fingerprints and the tokenizer can't be written in it.

Every stage takes rows with nulls in any column, repeated rows and ids, texts of any length, and
further columns of any name, which all but the last return unchanged; an empty table stays
empty. What a stage makes of null, empty and tied texts is said with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matrixmill.llm import decontaminate, exact_dedup, packing, simhash, toxicity
from matrixmill.llm.common import read_rows
from matrixmill.sources.tables import staged


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a toxic span; the field learns from the training labels.

    Null and empty texts score 0 and stay, and so does every repeated row of a clean text.
    """
    labels = read_rows(spark, sf_dir, "labels")
    model = toxicity.fit_model(read_rows(spark, sf_dir, "documents"), labels, toxicity.TRAINING)
    return toxicity.drop_toxic(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of equal texts the one with the largest id; null counts as the empty text.

    A null id is smaller than any other. Of rows equal in text and id one stays.
    """
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each component of near copies the one with the least id; null ids come last.

    Texts without words have the same fingerprint, zero, so one row of them stays.
    """
    return simhash.drop_near_duplicates(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark.

    Null and empty texts hold none. Repeated rows are each judged. Without a benchmark all stay.
    """
    return decontaminate.drop_contaminated(docs, read_rows(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces whose lengths are powers of two, with the checksum of their ids.

    A null text counts as empty, and an empty text is one piece with the end id alone. Repeated
    rows are packed like any other.
    """
    pieces = packing.pack(docs)
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("packing", pack_sequences),
]

#: No stage but exact deduplication can be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``, each to the stored result of the one before."""
    docs = read_rows(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = staged(docs, name)
    return docs
