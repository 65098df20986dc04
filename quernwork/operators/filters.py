"""Predicates and scans for terms over texts, paths and file lists."""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

#: Terms that a text of the period does not hold (fixed values, in this order).
ANACHRONISMS = (
    "world war", "first world war", "second world war", "wwi", "wwii",
    "treaty of versailles", "league of nations", "united nations",
    "nazi", "fascist", "fascism", "gestapo", "holocaust",
    "soviet union", "soviet russia", "bolshevik revolution",
    "cold war", "iron curtain", "berlin wall",
    "korean war", "vietnam war",
    "television", "radio broadcast", "broadcasting",
    "computer", "software", "internet", "website", "email",
    "transistor", "semiconductor", "microchip",
    "nuclear power", "nuclear weapon", "atomic bomb", "hydrogen bomb",
    "nuclear reactor", "nuclear fission", "nuclear fusion",
    "jet engine", "jet aircraft", "supersonic",
    "satellite", "space station", "moon landing",
    "laser", "radar",
    "antibiotic", "penicillin", "insulin therapy",
    "quantum mechanics", "quantum theory", "heisenberg",
    "general relativity", "black hole", "big bang",
    "dna molecule", "double helix", "genetic code",
    "hitler", "mussolini", "stalin", "lenin",
    "fdr", "franklin roosevelt",
    "world war i", "world war ii", "interwar",
    "great depression",
    "decolonization", "decolonisation",
)


def anachronisms(text: Column, terms: tuple[str, ...] = ANACHRONISMS) -> Column:
    """The terms that stand in the text as words, in the order of the list. One pattern of all terms is tried first,
    so that most texts are read once."""
    any_term = text.rlike(r"(?iU)\b(?:" + "|".join(sorted(terms, key=len, reverse=True)) + r")\b")
    each = F.array_compact(F.array(*[F.when(text.rlike(rf"(?iU)\b{t}\b"), F.lit(t)) for t in terms]))
    return F.when(text.isNull(), None).when(any_term, each).otherwise(F.array().cast("array<string>"))


def has_suffix(name: Column, *suffixes: str) -> Column:
    """Whether a name ends with one of the suffixes."""
    found = name.endswith(suffixes[0])
    for suffix in suffixes[1:]:
        found = found | name.endswith(suffix)
    return found


def path_year(path: Column) -> Column:
    """The first part of a path that is a number of four digits; null where there is none."""
    return F.nullif(F.regexp_extract(path, r"/(\d{4})/", 1), F.lit("")).cast("int")


def page_outcome(path: Column, text: Column, quality: Column, last_year: int = 1913, least: int = 200, share: float = 0.8) -> Column:
    """What becomes of a page, by the first rule that applies."""
    year = path_year(path)
    return (
        F.when(year.isNull(), "no_year")
        .when(year > last_year, "late")
        .when(F.coalesce(F.length(T.strip(text)), F.lit(0)) < least, "short")
        .when(quality < share, "low_quality")
        .otherwise("saved")
    )


#: Words of a lexicon that travel with the tasks; a larger one is refused.
MOST_WORDS = 1 << 18
BUCKETS = 1 << 13


def word_set(words: set[str]) -> Callable[[Column], Column]:
    """Whether a word is one of ``words``: a literal array of small arrays, by a hash of the word."""
    buckets: list[list[str]] = [[] for _ in range(BUCKETS)]
    for word in sorted(words):
        buckets[zlib.crc32(word.encode()) & (BUCKETS - 1)].append(word)
    literal = F.from_json(F.lit(json.dumps(buckets)), "array<array<string>>")
    at = lambda w: F.crc32(w.cast("binary")).bitwiseAND(F.lit(BUCKETS - 1)).cast("int")
    return lambda w: F.array_contains(F.get(literal, at(w)), w)


def lexicon_words(lexicon: DataFrame, least: int = 1) -> DataFrame:
    """(word): the different words in lower case, stripped, of ``least`` signs or more."""
    word = T.strip(F.lower("word"))
    return lexicon.select(word.alias("word")).filter(F.length("word") >= least).distinct()


def known_word_share(pages: DataFrame, lexicon: DataFrame, text: str = "text", out: str = "quality") -> DataFrame:
    """Share of a text's words (ASCII letters) that are in the lexicon; 0 for a text without words or null.

    The lexicon is a bounded table and travels with the tasks, so that nothing is joined or moved. An empty one is
    refused, as every text would score 0.
    """
    words = {r.word for r in lexicon_words(lexicon).limit(MOST_WORDS + 1).collect()}
    if not words or len(words) > MOST_WORDS:
        raise ValueError(f"the lexicon must hold 1 to {MOST_WORDS} words")
    known = word_set(words)
    found = F.filter(F.split(F.lower(F.col(text)), "[^a-z]+"), lambda w: w != "")
    rows = pages.withColumn("_words", found)
    share = F.size(F.filter("_words", known)) / F.nullif(F.size("_words"), F.lit(0))
    return rows.withColumn(out, F.coalesce(F.when(F.col("_words").isNotNull(), share), F.lit(0.0))).drop("_words")
