"""The corpus pipeline: toxic documents go, one of each group of near duplicates stays, secrets are masked, and what is left is packed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import read_table
from tallyloom.llm.packing import pack_documents
from tallyloom.llm.secret_scan import redact_secrets
from tallyloom.llm.simhash import one_of_each_group
from tallyloom.llm.toxicity import fit_toxicity, is_held_out, keep_below
from tallyloom.session import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOXIC_FROM = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the bound. The score is that of the document's own row, so nothing is joined."""
    model = fit_toxicity(docs, read_table(spark, sf_dir, "labels"), ~is_held_out())
    return keep_below(docs.select(*COLUMNS), model, TOXIC_FROM)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, by fingerprints of four-word shingles within four bits, the row with the smallest key."""
    return one_of_each_group(docs.select(*COLUMNS), words=4, distance=4)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in their texts and lengths counted anew where that changed them."""
    masked = redact_secrets(docs.select(*COLUMNS, F.col("text").alias("before")))
    changed = ~F.col("text").eqNullSafe(F.col("before"))
    return masked.select("doc_id", "text", "lang", "source", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 tokens."""
    pieces = pack_documents(docs)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("toxicity", drop_toxic), ("simhash", drop_near_duplicates), ("secrets", mask_secrets), ("packing", pack)]

#: Trained scores, XXH64 and tokenizers are not in SQL; tests hold the stages against plain forms.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
