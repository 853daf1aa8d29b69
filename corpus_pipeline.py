"""A training-data pipeline over ``documents``.

Each stage applies one operator to every row that its predecessor kept. The first four return
the columns of ``documents``; the last returns one row of digests per document that is left.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, pii, piece_bpe, simhash, toxicity
from tidemark.llm.queries import model_path, table, toxicity_index
from tidemark.scratch import remove_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go; the labels outside the held-out quarter are learned from.

    Every row is judged by itself: repeated rows and ids stay or go alike, null and empty texts get the
    rate of examples without a term, other columns pass unchanged, an empty table stays empty.
    """
    return toxicity.drop_toxic(docs, toxicity_index(spark, docs, sf_dir))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates the document with the smallest id stays.

    Null and empty texts are near duplicates of each other. Rows that repeat an id are one document
    and stay together, as do rows without an id. Columns are unchanged.
    """
    return simhash.keep_first(docs)


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item of ``benchmark``, or an edited copy, go.

    Null and empty texts hold none and stay; rows are judged one by one, columns are unchanged, and
    without test items everything stays.
    """
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, with pseudonyms for personal data in its text.

    Null stays null; equal values get equal pseudonyms in every row; other columns are unchanged.
    """
    return pii.pseudonymise(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the token ids of every document and of the text they decode to.

    One row per row; a null or empty text has the begin and end ids alone. Other columns are left out.
    """
    return piece_bpe.digests(piece_bpe.encode_decode(docs, model_path()))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_leaked),
    ("pii", replace_personal_data),
    ("sentencepiece", encode),
]

# Scores, alignments and token ids cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``.

    Each stage's rows are written as Parquet to the shared folder of ``spark.checkpoint.dir`` and
    read again, so no stage runs twice and a lost executor costs part of one stage. The files of a
    stage go when the next one is written; those of the last stay for the result.
    """
    docs = table(spark, sf_dir, "documents")
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid4()}"
    before = None
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        if before is not None:
            remove_folder(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
