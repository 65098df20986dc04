"""Problem 4: tokens per document and exact totals by source, language and domain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import language_code, table, vocabulary_path
from .pieces import HOT_PIECES, RANK_FILE, pieces, token_count, with_token_counts

UNKNOWN_LANGUAGE = "und"
#: Parts over which rows without a book are spread.
SALTS = 1 << 12


def book_languages(manifest: DataFrame) -> DataFrame:
    """(ebook_id, book_language): one row per book that has a language; repeated rows count once."""
    code = language_code(F.col("language"))
    return (
        manifest.filter(F.col("ebook_id").isNotNull() & code.isNotNull())
        .groupBy("ebook_id")
        .agg(F.min(code).alias("book_language"))
    )


def _keyed(documents: DataFrame) -> DataFrame:
    """Documents with the book they come from (``_book``, only for books) and their own language (``_own``)."""
    return documents.withColumns(
        {
            "_book": F.when(F.col("source") == "gutenberg", F.col("ebook_id")),
            "_own": language_code(F.col("lang")),
        }
    )


def _named(keyed: DataFrame, manifest: DataFrame, spread: list[str]) -> DataFrame:
    """Adds ``language``: that of the book's manifest row, else the row's own, else ``und``. Rows without a book meet
    nothing; they are spread by the columns ``spread``, so that they do not gather in one task."""
    salt = F.when(F.col("_book").isNull(), 1 + F.pmod(F.xxhash64(*spread), F.lit(SALTS))).otherwise(0).cast("int")
    books = book_languages(manifest).select(F.col("ebook_id").alias("_at"), F.lit(0).alias("_salted"), "book_language")
    rows = keyed.withColumns({"_key": F.coalesce("_book", F.lit(0)), "_salt": salt})
    met = rows.join(books, (rows["_key"] == books["_at"]) & (rows["_salt"] == books["_salted"]), "left")
    language = F.coalesce("book_language", "_own", F.lit(UNKNOWN_LANGUAGE))
    return met.withColumn("language", language).drop("_key", "_salt", "_at", "_salted", "book_language")


def document_tokens(documents: DataFrame, manifest: DataFrame, hot_pieces: int = HOT_PIECES) -> DataFrame:
    """(doc_id, source, language, domain, n_tokens) of each row; null and empty texts have 0 tokens.

    Repeated rows stay repeated; null sources and domains stay null; a language that is not given is ``und``.
    """
    rows = documents.select("doc_id", "source", "lang", "domain", "ebook_id", "text")
    counted = with_token_counts(rows, hot_pieces=hot_pieces).drop("text")
    named = _named(_keyed(counted), manifest, ["doc_id", "source", "domain"])
    return named.select("doc_id", "source", "language", "domain", "n_tokens")


def token_budget(documents: DataFrame, manifest: DataFrame) -> DataFrame:
    """Totals by (source, language, domain), by each of them alone, and over all; ``level`` tells which.

    Columns: level, source, language, domain, n_docs, n_with_text, n_tokens. One scan counts how often each distinct
    piece stands under each key (map-side combined); the piece's surviving symbols are counted and weighted by that
    frequency. A null piece stands for each document and an empty one for each that has a text.
    """
    path = vocabulary_path(RANK_FILE)
    filled = F.when(F.length("text") > 0, F.concat(F.array(F.lit("")), pieces(F.col("text"))))
    marked = F.concat(F.array(F.lit(None).cast("string")), F.coalesce(filled, F.array().cast("array<string>")))
    keys = ["source", "domain", "_book", "_own"]
    counted = (
        _keyed(documents.select("source", "lang", "domain", "ebook_id", "text"))
        .select(*keys, F.explode(marked).alias("piece"))
        .groupBy(*keys, "piece").agg(F.count("*").alias("n"))
    )
    symbols = token_count(path)(F.coalesce("piece", F.lit("")))
    summed = (
        counted.withColumn("symbols", symbols).groupBy(*keys)
        .agg(
            F.sum(F.when(F.col("piece").isNull(), F.col("n")).otherwise(0)).alias("docs"),
            F.sum(F.when(F.col("piece") == "", F.col("n")).otherwise(0)).alias("filled"),
            F.sum(F.when(F.length("piece") > 0, F.col("n") * F.col("symbols")).otherwise(0)).alias("tokens"),
        )
    )
    named = _named(summed, manifest, keys)
    sets = [
        ("source, language, domain", ["source", "language", "domain"]),
        ("source", ["source"]), ("language", ["language"]), ("domain", ["domain"]), ("all", []),
    ]
    total = (
        named.groupingSets([[F.col(c) for c in keys] for _, keys in sets], "source", "language", "domain")
        .agg(
            F.grouping_id().alias("_set"),
            F.sum("docs").alias("n_docs"),
            F.sum("filled").alias("n_with_text"),
            F.sum("tokens").alias("n_tokens"),
        )
    )
    bit = {"source": 4, "language": 2, "domain": 1}
    level = F.lit("all")
    for name, keys in sets[:-1]:
        level = F.when(F.col("_set") == 7 - sum(bit[k] for k in keys), F.lit(name)).otherwise(level)
    return total.select(level.alias("level"), "source", "language", "domain", "n_docs", "n_with_text", "n_tokens")


def p4_doc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_tokens(table(spark, sf_dir, "documents"), table(spark, sf_dir, "manifest"))


def p4_token_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_budget(table(spark, sf_dir, "documents"), table(spark, sf_dir, "manifest"))


QUERIES = {"p4_doc_tokens": p4_doc_tokens, "p4_token_budget": p4_token_budget}
ORACLES: dict[str, str] = {}
