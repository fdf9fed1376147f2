"""From raw documents to packed training sequences: quality rules, line dedup, near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. Between stages
the rows are written as parquet and read again, so a lost executor costs a stage at most.
"""

from __future__ import annotations

import uuid
from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecart.llm import line_templates, mixing, near_copies, packing, repetition, simhash
from tidecart.session import pin, pinned_tables, release_shuffles, shared_folder, small_batches

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the length and repetition rules."""
    small_batches(spark)
    return repetition.without_repetitive(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines whose template recurs; a document of such lines only has nothing left and goes."""
    left = line_templates.without_boilerplate(docs)
    left = left.where((F.col("n_dropped") == 0) | (F.length(F.trim(F.translate("text", "\n\t", "  "))) > 0))
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: fingerprints within two bits, or shingles of five words alike to 0.8 or more."""
    small_batches(spark)
    return simhash.one_of_each(docs, similar=near_copies.similar_links(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to their source's target weight and shuffled."""
    return mixing.mix(docs, mixing.shares(docs)).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    small_batches(spark)
    return packing.packed_documents(docs, ["doc_id"])


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("SimHash near-dedup", near_dedup),
          ("mixing sources to target weights", mix_sources), ("best-fit packing", pack)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    written = shared_folder(spark) is not None
    for _, stage in STAGES[:-1]:
        with pinned_tables() if written else nullcontext():  # without a folder the rows are still to be worked out
            docs = between(spark, stage(spark, docs, sf_dir))
        release_shuffles(spark)
    return STAGES[-1][1](spark, docs, sf_dir)


def between(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Write a stage's rows to the shared folder and read them again; without such a folder, as in tests, keep them."""
    folder = shared_folder(spark)
    if folder is None:
        return pin(docs)
    path = f"{folder.rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs.write.parquet(path)
    return spark.read.parquet(path)
