"""Corpus pipeline: five stages, applied one after the other to the table of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from secflow.llm import common
from secflow.llm.decontamination import find_contamination
from secflow.llm.jaccard_join import keep_one_of_each
from secflow.llm.language_id import id_remainder
from secflow.llm.line_dedup import NOT_BLANK, remove_repeated_lines
from secflow.llm.packing import pack_documents
from secflow.llm.toxicity import drop_toxic, fit_toxicity

#: Near duplicates: words of a shingle, and percent of the union that must be shared.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def drop_toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, fitted on the labelled ones of two id folds out of three, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit_toxicity(docs, labels.where(id_remainder("doc_id", 3) != 1))
    return drop_toxic(docs, model)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of later occurrences of three-line windows; one that loses all its words that way goes."""
    changed = remove_repeated_lines(docs, carry=True)
    changed = changed.where((F.col("n_removed") == 0) | F.col("text").rlike(NOT_BLANK))
    return changed.select(*["text" if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def keep_one_near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return keep_one_of_each(docs, words=NEAR_WORDS, percent=NEAR_PERCENT)


def drop_contaminated_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    found = find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where(F.size("hits") > 0)
    hit = found.select(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash"))
    return docs.join(hit, docs.doc_id.eqNullSafe(hit.hit_id) & (F.xxhash64(docs.text) == hit.hit_hash), "left_anti")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents, with their ids, and their places in training sequences."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic_documents),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", keep_one_near_duplicate),
    ("decontamination", drop_contaminated_documents),
    ("packing", pack),
]

#: The stages train a classifier and tokenise, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), name)
    return docs
