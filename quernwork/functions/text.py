"""Column functions for text. Each gives null for null."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's str.strip takes it, as a character class of Java and of RE2 (fixed values).
WHITE = (
    r"\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
#: Broken encodings of signs and what they stand for, and the byte order mark (fixed values).
MOJIBAKE = (
    ("â\u0080\u0099", "’"),
    ("â\u0080\u009c", "“"),
    ("â\u0080\u009d", "”"),
    ("â\u0080\u0094", "—"),
    ("â\u0080\u0093", "–"),
    ("﻿", ""),
)
#: Markers around the text of a book, and tags of pictures (fixed values).
START_MARKER = r"\*\*\*[\x{09}-\x{0D}\x{20}]*START OF (?:THE |THIS )?PROJECT GUTENBERG[^\n]*?\*\*\*"
END_MARKER = r"\*\*\*[\x{09}-\x{0D}\x{20}]*END OF (?:THE |THIS )?PROJECT GUTENBERG[^\n]*?\*\*\*"
ILLUSTRATION = r"\[Illustration[^\]]*\]"


def strip(text: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.regexp_replace(text, rf"\A[{WHITE}]+|[{WHITE}]+\z", "")


def _nfc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


def normalize_unicode(text: Column) -> Column:
    """NFC and repaired signs. Only texts beyond ASCII go through Python, as Spark has no normaliser."""
    nfc = F.pandas_udf(_nfc, "string")
    out = F.when(text.rlike(r"[^\x00-\x7F]"), nfc(F.when(text.rlike(r"[^\x00-\x7F]"), text))).otherwise(text)
    for wrong, right in MOJIBAKE:
        out = F.replace(out, F.lit(wrong), F.lit(right))
    return out


def collapse_whitespace(text: Column) -> Column:
    """Line ends as LF, no blanks at line ends, at most one empty line, stripped."""
    out = F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    out = F.regexp_replace(out, r"[ \t]+(?=\n|\z)", "")
    return strip(F.regexp_replace(out, r"\n{3,}", "\n\n"))


def strip_markers(text: Column) -> Column:
    """What stands after the first start marker and before the first end marker; either may be missing."""
    head = F.split(text, f"(?i){START_MARKER}", 2)
    body = F.when(F.size(head) == 2, head[1]).otherwise(text)
    return strip(F.split(body, f"(?i){END_MARKER}", 2)[0])


def strip_illustrations(text: Column) -> Column:
    return F.regexp_replace(text, f"(?i){ILLUSTRATION}", "")


def _starts_licence(low: Column) -> Column:
    names = low.contains("license") | low.contains("ebook") | low.contains("e-book") | low.contains("electronic")
    return (low.contains("project gutenberg") & names) | low.contains("full project gutenberg")


def _drops_line(low: Column) -> Column:
    archive = low.contains("internet archive")
    return (
        (low.contains("digitized by") & archive)
        | (archive & (low.contains("produced from") | low.contains("generated from")))
        | low.contains("gutenberg.org")
        | low.contains("archive.org")
    )


def drop_boilerplate(text: Column) -> Column:
    """Without licences (to the end of the text), notices of digitisation and addresses; line by line."""
    lines = F.split(text, "\n")
    at = F.array_min(F.transform(lines, lambda x, i: F.when(_starts_licence(F.lower(x)), i)))
    kept = F.filter(F.slice(lines, F.lit(1), F.coalesce(at, F.size(lines))), lambda x: ~_drops_line(F.lower(x)))
    bare = F.transform(
        kept,
        lambda x: F.regexp_replace(F.regexp_replace(x, rf"https?://[^{WHITE}]+", ""), rf"www\.[^{WHITE}]+", ""),
    )
    return strip(F.array_join(bare, "\n"))


def squeeze_spaces(text: Column) -> Column:
    """Three or more blanks become two."""
    return F.regexp_replace(text, r"[ \t]{3,}", "  ")


def clean_book(text: Column) -> Column:
    return collapse_whitespace(normalize_unicode(strip_illustrations(strip_markers(text))))


def clean_newspaper(text: Column) -> Column:
    return collapse_whitespace(squeeze_spaces(normalize_unicode(text)))


def clean_plain(text: Column) -> Column:
    """Archive items and articles."""
    return collapse_whitespace(normalize_unicode(text))


def non_ascii_ratio(text: Column) -> Column:
    """Share of code points above 127; 0 for an empty text."""
    size = F.length(text)
    return F.when(size == 0, 0.0).otherwise(F.length(F.regexp_replace(text, r"[\x00-\x7F]", "")) / size)


def is_quality(text: Column, least: int = 1000, most_non_ascii: float = 0.05) -> Column:
    return (F.length(text) >= least) & (non_ascii_ratio(text) <= most_non_ascii)


def estimated_tokens(text: Column) -> Column:
    return F.floor(F.length(text) / F.lit(3.5))


def first_year(text: Column) -> Column:
    """The first number of four digits, if it is a year from 1000 to 2100; a later one is not looked at."""
    year = F.nullif(F.regexp_extract(text, r"(?U)\b(\d{4})\b", 1), F.lit("")).try_cast("int")
    return F.when(year.between(1000, 2100), year)


def article_title(text: Column, fallback: Column) -> Column:
    """Leading words in capitals: up to and with the first that ends with a comma or is not all capitals, as long as
    each begins with a capital."""
    words = F.filter(F.split(text, rf"[{WHITE}]+"), lambda w: w != "")
    start = F.struct(F.array().cast("array<string>").alias("took"), F.lit(False).alias("done"))

    def step(acc: Column, word: Column) -> Column:
        first = F.left(word, F.lit(1))
        capital = (first == F.upper(first)) & (first != F.lower(first))
        capitals = (word == F.upper(word)) & (word != F.lower(word))
        stop = ~capitals | word.endswith(",")
        go = ~acc["done"] & capital
        return F.struct(
            F.when(go, F.array_append(acc["took"], word)).otherwise(acc["took"]).alias("took"),
            F.when(acc["done"], True).otherwise(~capital | stop).alias("done"),
        )

    took = F.aggregate(words, start, step)["took"]
    title = F.regexp_replace(F.array_join(took, " "), ",+$", "")
    return F.when(F.length(title) > 0, title).otherwise(fallback)


def safe_name(name: Column) -> Column:
    return F.left(F.regexp_replace(name, r'[<>:"/\\|?*]', "_"), F.lit(100))


def safe_path(path: Column) -> Column:
    bare = F.regexp_replace(path, r"\A/+|/+\z", "")
    return F.regexp_replace(F.replace(bare, F.lit("/"), F.lit("_")), r"[^a-zA-Z0-9_.-]", "_")


def book_addresses(number: Column) -> Column:
    """Where a book's text may lie, in the order in which the places are tried."""
    forms = ("files/%1$d/%1$d-0.txt", "files/%1$d/%1$d.txt", "cache/epub/%1$d/pg%1$d.txt")
    return F.when(number.isNotNull(), F.array(*[F.format_string(f, number) for f in forms]))


def slug(name: Column) -> Column:
    return F.replace(F.lower(name), F.lit(" "), F.lit("-"))
