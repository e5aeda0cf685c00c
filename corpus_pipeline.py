"""The training-data pipeline: documents in, decisions stage by stage, a table of coded token ids out.

Every stage reads all that the one before kept; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm.common import Workspace, read
from folioflow.llm.decontaminate import decontaminate
from folioflow.llm.mixing import sample
from folioflow.llm.near_dedup import near_duplicates
from folioflow.llm.token_files import token_output
from folioflow.llm.toxicity import drop_toxic

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; the model learns from the labelled rows held in.

    Each row is judged by its own text: null and empty texts, rows without an id and repeated rows stay unless they are toxic.
    """
    return drop_toxic(docs, read(spark, sf_dir, "labels")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest doc_id.

    Texts without words are no duplicates of anything; rows without an id stay; rows that share an id stay or go together.
    """
    gone = near_duplicates(docs).where("NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by the benchmark go, each judged by its own text; those without words are clean."""
    return decontaminate(docs, read(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled to the raked mixture of sources, languages and topics, half of the tokens.

    Documents without words have no tokens and go; rows without an id are drawn by their text.
    """
    return sample(docs).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids written as coded files and read back: doc_id, start, n_tokens, ids_crc32; every row of the stage before, null ids first."""
    return token_output(docs)


STAGES = [("toxicity", toxicity), ("minhash_near_dedup", near_dedup), ("decontamination", decontamination), ("mixing", mixing), ("token_output", tokens)]

#: A learned classifier, raking and a byte format are beyond SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again; a stage's table goes when the next one is there."""
    ws = Workspace(spark, "pipeline")
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = ws.table(stage(spark, docs, sf_dir), name)
        if before:
            ws.drop(before)
        before = name
    return docs
