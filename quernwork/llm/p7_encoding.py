"""Problem 7: the whole corpus as token ids of a public tokenizer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .pieces import decode, with_ids


def encode_documents(documents: DataFrame) -> DataFrame:
    """(doc_id, ids): the ids of each row's text, the empty list for null and empty texts.

    Repeated rows give repeated results, extra columns are ignored, an empty table gives an empty result.
    """
    return with_ids(documents.select("doc_id", "text")).select("doc_id", "ids")


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"))


def p7_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(n_docs, n_tokens, n_equal): how many texts come back from their ids byte for byte; null counts as empty."""
    docs = with_ids(table(spark, sf_dir, "documents").select("text"))
    return docs.agg(
        F.count("*").alias("n_docs"),
        F.sum(F.size("ids").cast("bigint")).alias("n_tokens"),
        F.count_if(decode(F.col("ids")) == F.coalesce("text", F.lit(""))).alias("n_equal"),
    )


QUERIES = {"p7_ids": p7_ids, "p7_round_trip": p7_round_trip}
ORACLES: dict[str, str] = {}
