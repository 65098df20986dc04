"""Queries on catalog records: parsing, selection and the manifest, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rdf
from ..operators import catalog as C
from .sql import read

#: Subjects and descriptions that entries are given by their number, so that every rule applies to some.
SUBJECTS = (
    [], ["English fiction -- 19th Century", "Sea stories"], ["Mythology, Greek"], ["Cooking"], ["Travel", "Great Britain -- History -- To 1500"],
    ["Folklore & legends"], ["Bible. Psalms"],
)
DESCRIPTIONS = ("", "First printed in 1871 & again in 1890", "Printed in 1920", "No. 12345, then 1802", "1913")


def _entries(spark: SparkSession, d: str) -> DataFrame:
    """Books of the manifest as catalog entries."""
    n = F.col("ebook_id")
    pick = lambda values, by, kind: F.get(F.from_json(F.lit(values), kind), F.pmod(n, F.lit(by)))
    rows = read(spark, d, "manifest").filter("ebook_id is not null").select("ebook_id", "title", "author", "author_death", "language").distinct()
    death = F.when(n % 4 == 1, F.col("author_death") + 60).when(n % 4 != 2, F.col("author_death"))
    return rows.select(
        "ebook_id", "title", "language",
        F.when(n % 6 != 5, F.col("author")).alias("author"),
        death.alias("author_death"), F.when(n % 3 != 0, F.col("author_death") - 55).alias("author_birth"),
        pick(_json(SUBJECTS), len(SUBJECTS), "array<array<string>>").alias("subjects"),
        pick(_json(DESCRIPTIONS), len(DESCRIPTIONS), "array<string>").alias("description"),
        (n % 9 != 0).alias("has_text"), (n % 31 == 0).alias("broken"),
    )


def _json(values) -> str:
    import json

    return json.dumps(values)


def _safe(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(sign), F.lit(name))
    return out


def _tag(name: str, inner: Column) -> Column:
    return F.concat(F.lit(f"<{name}>"), inner, F.lit(f"</{name}>"))


def _value(inner: Column) -> Column:
    return _tag("rdf:Description", _tag("rdf:value", inner))


def _xml(rows: DataFrame) -> DataFrame:
    """(ebook_id, xml): entries written as catalog records; broken ones end before their time."""
    spaces = " ".join(f'xmlns:{k}="{v}"' for k, v in rdf.SPACES.items())
    year = lambda name, c: F.coalesce(_tag(name, F.concat(F.col(c), F.lit("-02-03"))), F.lit(""))
    person = F.concat(_tag("pgterms:name", _safe(F.col("author"))), year("pgterms:birthdate", "author_birth"), year("pgterms:deathdate", "author_death"))
    subjects = F.array_join(F.transform("subjects", lambda s: _tag("dcterms:subject", _value(_safe(s)))), "")
    file = F.when(F.col("has_text"), "files/1.txt").otherwise("files/1.epub")
    whole = F.concat(
        F.lit(f"<rdf:RDF {spaces}><pgterms:ebook rdf:about=\"ebooks/"), F.col("ebook_id"), F.lit('">'),
        _tag("dcterms:title", _safe(F.col("title"))), _tag("dcterms:language", _value(_safe(F.col("language")))),
        _tag("dcterms:creator", _tag("pgterms:agent", person)), subjects, _tag("dcterms:description", _safe(F.col("description"))),
        F.lit('<dcterms:hasFormat><pgterms:file rdf:about="'), file, F.lit('"/></dcterms:hasFormat></pgterms:ebook></rdf:RDF>'),
    )
    return rows.select("ebook_id", F.when(F.col("broken"), F.left(whole, F.length(whole) - 9)).otherwise(whole).alias("xml"))


def _parsed(spark: SparkSession, d: str) -> DataFrame:
    return _xml(_entries(spark, d)).select("ebook_id", rdf.parse_rdf(F.col("xml")).alias("e"))


def _selected(spark: SparkSession, d: str) -> DataFrame:
    rows = _parsed(spark, d).filter("e.ebook_id is not null").select("ebook_id", C.pre_1914(F.col("e")).alias("p"))
    return rows.select("ebook_id", "p.ok", "p.reason")


def _manifest(spark: SparkSession, d: str) -> DataFrame:
    rows = _parsed(spark, d).filter(C.outcome(F.col("e")) == "included")
    return rows.select("ebook_id", "e.title", "e.author", "e.author_death", C.pre_1914(F.col("e"))["reason"].alias("year_reason"), "e.language")


def _counters(spark: SparkSession, d: str) -> DataFrame:
    return _parsed(spark, d).groupBy(C.outcome(F.col("e")).alias("outcome")).agg(F.count("*").alias("n"))


_LIST = "[" + ", ".join("[" + ", ".join(f"'{s}'" for s in x) + "]::VARCHAR[]" for x in SUBJECTS) + "]"
_NOTES = "[" + ", ".join(f"'{s}'" for s in DESCRIPTIONS) + "]"
#: The decision list again: each rule gives a row with its rank, and the lowest rank counts.
_SQL = f"""
WITH m AS (SELECT DISTINCT ebook_id AS id, title, author, author_death, language FROM manifest WHERE ebook_id IS NOT NULL),
x AS (SELECT id, trim(coalesce(title, '')) AS title, trim(coalesce(language, '')) AS language,
  CASE WHEN id % 6 = 5 THEN '' ELSE trim(coalesce(author, '')) END AS author,
  CASE id % 4 WHEN 1 THEN author_death + 60 WHEN 2 THEN NULL ELSE author_death END AS died,
  CASE WHEN id % 3 = 0 THEN NULL ELSE author_death - 55 END AS born,
  ({_LIST})[1 + id % {len(SUBJECTS)}] AS subjects, ({_NOTES})[1 + id % {len(DESCRIPTIONS)}] AS note FROM m WHERE id % 31 <> 0),
e AS (SELECT *, TRY_CAST(nullif(regexp_extract(note, '\\b([0-9]{{4}})\\b', 1), '') AS INT) AS printed,
  list_filter(subjects, lambda s: regexp_matches(lower(s), '{"|".join(C.EARLY_TIMES)}'))[1] AS early,
  list_filter(subjects, lambda s: regexp_matches(lower(s), '{"|".join(C.OLD_MATTERS)}'))[1] AS old FROM x),
r AS (SELECT id, 1 AS rank, true AS ok, 'author died ' || died AS reason FROM e WHERE died < 1914
  UNION ALL SELECT id, 2, true, 'subject indicates pre-1914: ' || early FROM e WHERE early IS NOT NULL
  UNION ALL SELECT id, 3, true, 'description mentions year ' || printed FROM e WHERE printed BETWEEN 1000 AND 1913
  UNION ALL SELECT id, 4, true, 'author born ' || born || ', likely pre-1914' FROM e WHERE born < 1850 AND died IS NULL
  UNION ALL SELECT id, 5, true, 'anonymous but subject indicates historical: ' || old FROM e WHERE author = '' AND old IS NOT NULL
  UNION ALL SELECT id, 6, false, 'anonymous, no date signal' FROM e WHERE author = ''
  UNION ALL SELECT id, 7, false, 'author died ' || died || ', no pre-1914 evidence' FROM e WHERE died IS NOT NULL
  UNION ALL SELECT id, 8, false, 'no date information available' FROM e),
p AS (SELECT r.id, arg_min(ok, rank) AS ok, arg_min(reason, rank) AS reason, min(rank) AS rank FROM r GROUP BY r.id),
o AS (SELECT m.id, e.title, e.author, e.died, e.language, p.reason, CASE WHEN e.id IS NULL THEN 'parse_error' WHEN e.language <> 'en' THEN 'excluded'
  WHEN m.id % 9 = 0 THEN 'no_text' WHEN p.ok THEN 'included' ELSE 'excluded' END AS outcome FROM m LEFT JOIN e USING (id, title, author, language) LEFT JOIN p USING (id))"""
# entries are joined by their number, as titles and authors are written anew on the way
_SQL = _SQL.replace("LEFT JOIN e USING (id, title, author, language)", "LEFT JOIN e ON e.id = m.id").replace("LEFT JOIN p USING (id)", "LEFT JOIN p ON p.id = m.id")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "pre1914_filter": _selected, "manifest_build": _manifest, "manifest_counters": _counters,
    "rdf_parse": lambda s, d: _parsed(s, d).select(
        F.col("ebook_id").alias("asked_id"), "e.ebook_id", "e.title", "e.author", "e.author_birth", "e.author_death", "e.language",
        F.array_join("e.subjects", "|").alias("subjects"), "e.description", "e.has_text",
    ),
}

ORACLES: dict[str, str] = {
    "pre1914_filter": f"{_SQL} SELECT id AS ebook_id, ok, reason FROM p",
    "manifest_build": f"{_SQL} SELECT id AS ebook_id, title, author, died AS author_death, reason AS year_reason, language FROM o WHERE outcome = 'included'",
    "manifest_counters": f"{_SQL} SELECT outcome, count(*) AS n FROM o GROUP BY outcome",
    "rdf_parse": f"""{_SQL} SELECT m.id AS asked_id, e.id AS ebook_id, e.title, e.author, e.born AS author_birth, e.died AS author_death, e.language,
        array_to_string(e.subjects, '|') AS subjects, e.note AS description, CASE WHEN e.id IS NOT NULL THEN m.id % 9 <> 0 END AS has_text FROM m LEFT JOIN e ON e.id = m.id""",
}
