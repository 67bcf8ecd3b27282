"""The corpus pipeline: quality rules, near-duplicates, personal data, mix, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next one's docs; a folder goes when the stage after
it is written. All but the last return the columns of documents; other columns,
whatever their names, are left out.

Defined results: a null or empty text has too few words for the quality rules, and
goes there. Taken by themselves, the other stages treat it so: near-duplicates finds
texts without words alike, personal data leaves a null text null, the mix takes it
not at all, packing gives it a sequence's end id. Rows that repeat an id with other
texts are documents of their own in every stage; of equal ones near-duplicates keeps
one. Null ids are ids like any other, except that rows which share them are told
apart by their texts. Very long texts are taken whole. An empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runloom.llm import mixing, packing, pii, quality, simhash
from runloom.llm.common import remove_folder, shared_folder, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule rejects go."""
    return quality.keep_good(docs).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five words, a similarity of 0.8 or more."""
    return simhash.drop_near_duplicates(docs).select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are replaced by their kind; n_chars follows the text."""
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it: not at all, once or twice."""
    mixed = mixing.mix(docs, keep=("text", "lang", "n_chars"))
    return mixed.filter("copies > 0").select(*COLUMNS, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy")).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces' places in sequences of 2048 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("personal data", personal_data),
    ("mix", mix_sources),
    ("packing", pack_sequences),
]

#: Fingerprints, trees and tokens can't be expressed in SQL; tests compare the
#: stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES[:-1]):
        path = shared_folder(docs, f"stage{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if before is not None:
            remove_folder(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
