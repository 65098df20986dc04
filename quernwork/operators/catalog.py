"""Selection of catalog entries: works that are old enough, and what becomes of each entry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import first_year

#: Parts of subjects that name an early time, and those that tell so of a work without an author (fixed values).
EARLY_TIMES = ("17th century", "18th century", "19th century", "to 1500", "to 1800", "to 1900")
OLD_MATTERS = ("ancient", "classical", "medieval", "bible", "mythology", "folklore")
FIRST_LATE_YEAR, EARLY_BIRTH = 1914, 1850


def _first_naming(subjects: Column, parts: tuple[str, ...]) -> Column:
    """The first subject that holds one of the parts, whatever its case."""
    holds = lambda s: F.lower(s).rlike("|".join(parts))
    return F.get(F.filter(F.coalesce(subjects, F.array().cast("array<string>")), holds), F.lit(0))


def pre_1914(entry: Column) -> Column:
    """struct(ok, reason) of an entry (author, author_birth, author_death, subjects, description), by the first rule
    that applies. Null and empty authors and descriptions are none; null subjects are no subjects."""
    birth, death = entry["author_birth"], entry["author_death"]
    early, old = _first_naming(entry["subjects"], EARLY_TIMES), _first_naming(entry["subjects"], OLD_MATTERS)
    year = first_year(entry["description"])
    nobody = F.coalesce(entry["author"], F.lit("")) == ""
    told = lambda ok, *parts: F.struct(F.lit(ok).alias("ok"), F.concat(*parts).alias("reason"))
    as_text = lambda c: c.cast("string")
    return (
        F.when(death < FIRST_LATE_YEAR, told(True, F.lit("author died "), as_text(death)))
        .when(early.isNotNull(), told(True, F.lit("subject indicates pre-1914: "), early))
        .when(year < FIRST_LATE_YEAR, told(True, F.lit("description mentions year "), as_text(year)))
        .when((birth < EARLY_BIRTH) & death.isNull(), told(True, F.lit("author born "), as_text(birth), F.lit(", likely pre-1914")))
        .when(nobody & old.isNotNull(), told(True, F.lit("anonymous but subject indicates historical: "), old))
        .when(nobody, told(False, F.lit("anonymous, no date signal")))
        .when(death.isNotNull(), told(False, F.lit("author died "), as_text(death), F.lit(", no pre-1914 evidence")))
        .otherwise(told(False, F.lit("no date information available")))
    )


def outcome(entry: Column, language: str | None = "en") -> Column:
    """What becomes of a parsed entry, null where it could not be parsed: parse_error, excluded, no_text, included."""
    other = ~entry["language"].eqNullSafe(F.lit(language)) if language else F.lit(False)
    return (
        F.when(entry.isNull() | entry["ebook_id"].isNull(), "parse_error")
        .when(other, "excluded")
        .when(~entry["has_text"], "no_text")
        .when(~pre_1914(entry)["ok"], "excluded")
        .otherwise("included")
    )
