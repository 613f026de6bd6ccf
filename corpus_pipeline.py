"""Cleaning pipeline over the documents: language, repeated lines, near copies, benchmark passages, sampled pieces.

Each stage is a function of (spark, documents, folder of the sample tables) and works on all that the stage before it kept;
all but the last return the columns of `documents`. `run` writes each stage's rows to the shared folder and reads them back as
the next one's input. Null and empty texts are rejected by the first stage, as they have no language; an empty table gives
an empty result. Rows that repeat an id share their stages' decisions on it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innledger.llm.decontaminate import SEED, leaks
from innledger.llm.langid import UNKNOWN, predict, train
from innledger.llm.line_dedup import WORD, dedup_lines
from innledger.llm.near_dup import near_duplicates
from innledger.llm.piece_sampling import encode_pieces
from innledger.session import new_folder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Below this score no language is taken for sure.
LEAST_SCORE = 0.4


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose id (null included) is not among `ids` (bad_id)."""
    return docs.join(ids.hint("merge"), F.col("doc_id").eqNullSafe(F.col("bad_id")), "left_anti")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; text without letters or with an unsure language goes."""
    docs = docs.select(*COLUMNS)
    bad = predict(docs, train(docs)).where((F.col("lang_pred") == UNKNOWN) | (F.col("score") < LEAST_SCORE))
    return _without(docs, bad.select(F.col("doc_id").alias("bad_id")).distinct())


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are cut out; a document that loses all its words by that goes."""
    cut = dedup_lines(docs.select(*COLUMNS))
    emptied = (F.size("removed") > 0) & ~F.col("text").rlike(WORD)
    return cut.where(~emptied).select(
        "doc_id", "text", "lang", "source",
        F.when(F.size("removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that with the smallest id; rows without an id are documents of their own."""
    docs = docs.select(*COLUMNS)
    top = max(docs.agg(F.max("doc_id")).first()[0] or 0, 0)
    folder = f"{new_folder(spark, 'without-id')}"
    docs.where("doc_id is null").withColumn("row", F.monotonically_increasing_id()).write.parquet(folder)
    lost = spark.read.parquet(folder).withColumn("doc_id", F.col("row") + F.lit(top + 1)).select(*COLUMNS)
    named = docs.where("doc_id is not null").unionByName(lost)
    bad = near_duplicates(named).where("not kept").select(F.col("doc_id").alias("bad_id")).distinct()
    return _without(named, bad).withColumn("doc_id", F.when(F.col("doc_id") <= top, F.col("doc_id")))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; an item of fewer words than a seed says too little to drop a document."""
    docs = docs.select(*COLUMNS)
    found = leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where(F.col("n_words") >= SEED)
    return _without(docs, found.select(F.col("doc_id").alias("bad_id")).distinct())


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and the ids of the sampled pieces of the whole text."""
    return encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("pieces", pieces),
]
#: No stage but the decisions on benchmark passages could be put in SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = new_folder(spark, "pipeline")
    for name, stage in STAGES:
        rows = stage(spark, docs, sf_dir)
        rows.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(rows.schema).parquet(f"{folder}/{name}")
    return docs
