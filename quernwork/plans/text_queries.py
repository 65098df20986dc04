"""Queries on text cleaning and filters, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import filters as P
from .sql import read

_WS = T.WHITE


def _sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{_WS}]+|[{_WS}]+$', '', 'g')"


def _sql_normalize(x: str) -> str:
    out = f"nfc_normalize({x})"
    for wrong, right in T.MOJIBAKE:
        codes = " || ".join(f"chr({ord(c)})" for c in wrong)
        out = f"replace({out}, {codes}, '{right}')"
    return out


def _sql_collapse(x: str) -> str:
    ends = f"replace(replace({x}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"
    ends = rf"regexp_replace({ends}, '[ \t]+(\n|$)', '\1', 'g')"
    return _sql_strip(rf"regexp_replace({ends}, '\n{{3,}}', chr(10) || chr(10), 'g')")


def _sql_markers(x: str) -> str:
    start, end = f"(?i){T.START_MARKER}", f"(?i){T.END_MARKER}"
    body = f"CASE WHEN regexp_matches({x}, '{start}') THEN substr({x}, instr({x}, regexp_extract({x}, '{start}')) + length(regexp_extract({x}, '{start}'))) ELSE {x} END"
    cut = f"CASE WHEN regexp_matches(b, '{end}') THEN left(b, instr(b, regexp_extract(b, '{end}')) - 1) ELSE b END"
    return f"(SELECT {_sql_strip(cut)} FROM (SELECT {body} AS b))"


def _sql_illustrations(x: str) -> str:
    return f"regexp_replace({x}, '(?i){T.ILLUSTRATION}', '', 'g')"


def _sql_squeeze(x: str) -> str:
    return rf"regexp_replace({x}, '[ \t]{{3,}}', '  ', 'g')"


_SQL_BOILERPLATE = rf"""
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS xs FROM documents),
t AS (SELECT doc_id, text, xs, list_min(list_transform(generate_series(1, len(xs)), lambda i:
  CASE WHEN (contains(lower(xs[i]), 'project gutenberg') AND (contains(lower(xs[i]), 'license') OR contains(lower(xs[i]), 'ebook')
    OR contains(lower(xs[i]), 'e-book') OR contains(lower(xs[i]), 'electronic'))) OR contains(lower(xs[i]), 'full project gutenberg') THEN i END)) AS cut FROM l)
SELECT doc_id, {_sql_strip(rf'''array_to_string(list_transform(list_filter(xs[1:coalesce(cut - 1, len(xs))], lambda x: NOT (
    (contains(lower(x), 'digitized by') AND contains(lower(x), 'internet archive'))
    OR (contains(lower(x), 'internet archive') AND (contains(lower(x), 'produced from') OR contains(lower(x), 'generated from')))
    OR contains(lower(x), 'gutenberg.org') OR contains(lower(x), 'archive.org'))),
    lambda x: regexp_replace(regexp_replace(x, 'https?://[^{_WS}]+', '', 'g'), 'www\.[^{_WS}]+', '', 'g')), chr(10))''')} AS cleaned
FROM t"""


def _column(table: str, key: str, column: Callable[[Column], Column], out: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: read(spark, d, table).select(key, column(F.col("text")).alias(out))


def _oracle(table: str, key: str, expression: str, out: str) -> str:
    return f"SELECT {key}, {expression} AS {out} FROM {table}"


def _article_title(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "documents").filter(F.col("source") == "britannica")
    fallback = F.concat(F.lit("article_"), F.col("doc_id").cast("string"))
    return rows.select("doc_id", T.article_title(F.col("text"), fallback).alias("title"))


def _article_split(spark: SparkSession, d: str) -> DataFrame:
    """Lines of britannica texts as articles: stripped, of 50 characters or more, cleaned, numbered in their text."""
    rows = read(spark, d, "documents").filter(F.col("source") == "britannica")
    lines = rows.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    line = T.strip(F.col("line"))
    return lines.filter(F.length(line) >= 50).select("doc_id", "line_no", T.clean_plain(line).alias("article"))


def _safe_names(spark: SparkSession, d: str) -> DataFrame:
    """File names of manifest titles, later ones of the same name with their place."""
    rows = read(spark, d, "manifest").select("ebook_id", T.safe_name(F.col("title")).alias("name")).distinct()
    from pyspark.sql import Window as W

    place = F.row_number().over(W.partitionBy("name").orderBy("ebook_id"))
    return rows.withColumn("i", place).select(
        "ebook_id", F.when(F.col("i") > 1, F.concat("name", F.lit("_"), "i")).otherwise(F.col("name")).alias("file_name")
    )


def _quality(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "documents").filter(T.is_quality(F.col("text")))
    return rows.select("doc_id", F.length("text").cast("bigint").alias("n"), T.non_ascii_ratio(F.col("text")).alias("ratio"))


def _ocr(spark: SparkSession, d: str) -> DataFrame:
    pages = P.known_word_share(read(spark, d, "newspapers").select("page_id", "text"), read(spark, d, "lexicon"))
    return pages.select("page_id", F.round("quality", 9).alias("quality"))


_SQL_OCR = """
SELECT n.page_id, round(coalesce((SELECT avg(CASE WHEN l.word IS NOT NULL THEN 1.0 ELSE 0.0 END)
  FROM (SELECT unnest(list_filter(regexp_split_to_array(lower(n.text), '[^a-z]+'), lambda w: w <> '')) AS w) x
  LEFT JOIN (SELECT DISTINCT lower(word) AS word FROM lexicon) l ON l.word = x.w), 0.0), 9) AS quality FROM newspapers n"""


def _outcomes(spark: SparkSession, d: str) -> DataFrame:
    pages = read(spark, d, "newspapers").select("page_id", "member_path", "text")
    scored = P.known_word_share(pages, read(spark, d, "lexicon"))
    outcome = P.page_outcome(F.col("member_path"), F.col("text"), F.col("quality"))
    return (
        scored.groupBy(outcome.alias("outcome"))
        .agg(F.count("*").alias("n_pages"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n_chars"))
    )


_SQL_OUTCOMES = f"""
WITH q AS ({_SQL_OCR.replace('n.page_id,', 'n.member_path, n.text,')}),
o AS (SELECT *, TRY_CAST(nullif(regexp_extract(member_path, '/([0-9]{{4}})/', 1), '') AS INT) AS y FROM q)
SELECT CASE WHEN y IS NULL THEN 'no_year' WHEN y > 1913 THEN 'late'
  WHEN coalesce(length({_sql_strip('text')}), 0) < 200 THEN 'short' WHEN quality < 0.8 THEN 'low_quality' ELSE 'saved' END AS outcome,
  count(*) AS n_pages, coalesce(sum(length(text)), 0)::BIGINT AS n_chars FROM o GROUP BY 1"""


def _scan(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "documents").select("doc_id", P.anachronisms(F.col("text")).alias("terms"))
    return rows.select("doc_id", F.array_join("terms", "|").alias("terms"), F.coalesce(F.size("terms"), F.lit(0)).alias("n"))


_TERMS = "[" + ", ".join(f"'{t}'" for t in P.ANACHRONISMS) + "]"
_SQL_SCAN = rf"""
SELECT doc_id, array_to_string(t, '|') AS terms, coalesce(len(t), 0)::INT AS n FROM (
  SELECT doc_id, CASE WHEN text IS NOT NULL THEN list_filter({_TERMS}, lambda x: regexp_matches(text, '(?i)\b' || x || '\b')) END AS t FROM documents)"""


def _contamination(spark: SparkSession, d: str) -> DataFrame:
    hit = F.size(P.anachronisms(F.col("text"))) > 0
    return read(spark, d, "documents").filter("text is not null").groupBy("source").agg(
        F.count("*").alias("n_docs"), F.count_if(hit).alias("n_hit"), F.avg(hit.cast("double")).alias("rate")
    )


_SQL_CONTAMINATION = f"""
SELECT source, count(*) AS n_docs, count(*) FILTER (n > 0) AS n_hit, avg(CASE WHEN n > 0 THEN 1.0 ELSE 0.0 END)::DOUBLE AS rate
FROM (SELECT s.n, d.source FROM ({_SQL_SCAN}) s JOIN documents d USING (doc_id) WHERE d.text IS NOT NULL) GROUP BY source"""

_NAMES = ("norstead", "vnstcsc")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "normalize_unicode": _column("documents", "doc_id", T.normalize_unicode, "cleaned"),
    "collapse_whitespace": _column("documents", "doc_id", T.collapse_whitespace, "cleaned"),
    "py_strip": _column("documents", "doc_id", T.strip, "cleaned"),
    "strip_headers": _column("documents", "doc_id", T.strip_markers, "cleaned"),
    "strip_illustrations": _column("documents", "doc_id", T.strip_illustrations, "cleaned"),
    "drop_boilerplate": _column("documents", "doc_id", T.drop_boilerplate, "cleaned"),
    "squeeze_spaces": _column("newspapers", "page_id", T.squeeze_spaces, "cleaned"),
    "clean_book": _column("documents", "doc_id", T.clean_book, "cleaned"),
    "clean_newspaper": _column("newspapers", "page_id", T.clean_newspaper, "cleaned"),
    "clean_archive": _column("internetarchive", "identifier", T.clean_plain, "cleaned"),
    "article_title": _article_title,
    "article_split": _article_split,
    "safe_name": _safe_names,
    "safe_path": lambda s, d: read(s, d, "newspapers").select("page_id", T.safe_path(F.col("member_path")).alias("file_name")),
    "extract_year": lambda s, d: read(s, d, "documents").select("doc_id", T.first_year(F.col("text")).alias("year")),
    "non_ascii_ratio": _column("documents", "doc_id", T.non_ascii_ratio, "ratio"),
    "quality_gate": _quality,
    "path_year_filter": lambda s, d: read(s, d, "newspapers")
    .select("page_id", P.path_year(F.col("member_path")).alias("year")).filter("year <= 1913"),
    "min_length_filter": lambda s, d: read(s, d, "newspapers")
    .filter(F.length(T.strip(F.col("text"))) >= 200).select("page_id"),
    "blank_filter": lambda s, d: read(s, d, "documents")
    .filter((T.strip(F.col("text")) != "") & (T.drop_boilerplate(F.col("text")) != "")).select("doc_id"),
    "ocr_quality": _ocr,
    "batch_counters": _outcomes,
    "anachronism_scan": _scan,
    "contamination_rate": _contamination,
    "estimate_tokens": lambda s, d: read(s, d, "documents").select("doc_id", T.estimated_tokens(F.col("text")).alias("n_est")),
    "doc_cap": lambda s, d: read(s, d, "documents").select("doc_id", F.left("text", F.lit(10_000)).alias("head"), (F.length("text") > 10_000).alias("was_cut")),
    "slugify": lambda s, d: read(s, d, "manifest").select("ebook_id", T.slug(F.col("title")).alias("slug")).distinct(),
    "url_format": lambda s, d: read(s, d, "manifest").select("ebook_id", F.posexplode(T.book_addresses(F.col("ebook_id"))).alias("try", "path")).distinct(),
    "name_exclusion": lambda s, d: read(s, d, "newspapers").filter(~F.col("batch_name").rlike("|".join(_NAMES))).select("page_id", "batch_name"),
    "suffix_filter": lambda s, d: read(s, d, "newspapers").filter(P.has_suffix(F.col("member_path"), "ocr.txt")).select("page_id"),
    "lexicon_build": lambda s, d: P.lexicon_words(read(s, d, "lexicon"), least=2),
}

ORACLES: dict[str, str] = {
    "normalize_unicode": _oracle("documents", "doc_id", _sql_normalize("text"), "cleaned"),
    "collapse_whitespace": _oracle("documents", "doc_id", _sql_collapse("text"), "cleaned"),
    "py_strip": _oracle("documents", "doc_id", _sql_strip("text"), "cleaned"),
    "strip_headers": _oracle("documents", "doc_id", _sql_markers("text"), "cleaned"),
    "strip_illustrations": _oracle("documents", "doc_id", _sql_illustrations("text"), "cleaned"),
    "drop_boilerplate": _SQL_BOILERPLATE,
    "squeeze_spaces": _oracle("newspapers", "page_id", _sql_squeeze("text"), "cleaned"),
    "clean_book": f"SELECT doc_id, {_sql_collapse(_sql_normalize(_sql_illustrations('b')))} AS cleaned FROM (SELECT doc_id, {_sql_markers('text')} AS b FROM documents)",
    "clean_newspaper": _oracle("newspapers", "page_id", _sql_collapse(_sql_squeeze(_sql_normalize("text"))), "cleaned"),
    "clean_archive": _oracle("internetarchive", "identifier", _sql_collapse(_sql_normalize("text")), "cleaned"),
    "article_title": f"""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '[{_WS}]+'), lambda x: x <> '') AS ws FROM documents WHERE source = 'britannica'),
        s AS (SELECT doc_id, ws, list_transform(ws, lambda x: left(x, 1) = upper(left(x, 1)) AND left(x, 1) <> lower(left(x, 1))) AS cap,
          list_transform(ws, lambda x: x <> upper(x) OR x = lower(x) OR suffix(x, ',')) AS stops FROM w),
        n AS (SELECT doc_id, ws, coalesce(list_position(cap, false) - 1, len(ws)) AS a, coalesce(list_position(stops, true), len(ws)) AS b FROM s),
        t AS (SELECT doc_id, regexp_replace(array_to_string(ws[1:least(a, b)], ' '), ',+$', '') AS title FROM n)
        SELECT doc_id, CASE WHEN length(title) > 0 THEN title ELSE 'article_' || doc_id END AS title FROM t""",
    "article_split": f"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no
        FROM documents WHERE source = 'britannica') SELECT doc_id, line_no::INT AS line_no, {_sql_collapse(_sql_normalize(_sql_strip('line')))} AS article FROM l WHERE length({_sql_strip('line')}) >= 50""",
    "safe_name": r"""WITH m AS (SELECT DISTINCT ebook_id, left(regexp_replace(title, '[<>:"/\\|?*]', '_', 'g'), 100) AS name FROM manifest),
        r AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY ebook_id) AS i FROM m)
        SELECT ebook_id, CASE WHEN i > 1 THEN concat(name, '_', i) ELSE name END AS file_name FROM r""",
    "safe_path": "SELECT page_id, regexp_replace(replace(trim(member_path, '/'), '/', '_'), '[^a-zA-Z0-9_.-]', '_', 'g') AS file_name FROM newspapers",
    "extract_year": r"""SELECT doc_id, CASE WHEN y BETWEEN 1000 AND 2100 THEN y END AS year FROM (
        SELECT doc_id, TRY_CAST(nullif(regexp_extract(text, '\b([0-9]{4})\b', 1), '') AS INT) AS y FROM documents)""",
    "non_ascii_ratio": r"SELECT doc_id, CASE WHEN length(text) = 0 THEN 0.0 ELSE length(regexp_replace(text, '[\x00-\x7F]', '', 'g')) / length(text) END AS ratio FROM documents",
    "quality_gate": r"""SELECT * FROM (SELECT doc_id, length(text) AS n, CASE WHEN length(text) = 0 THEN 0.0 ELSE length(regexp_replace(text, '[\x00-\x7F]', '', 'g')) / length(text) END AS ratio
        FROM documents) WHERE n >= 1000 AND ratio <= 0.05""",
    "path_year_filter": "SELECT * FROM (SELECT page_id, TRY_CAST(nullif(regexp_extract(member_path, '/([0-9]{4})/', 1), '') AS INT) AS year FROM newspapers) WHERE year <= 1913",
    "min_length_filter": f"SELECT page_id FROM newspapers WHERE length({_sql_strip('text')}) >= 200",
    "blank_filter": f"SELECT doc_id FROM ({_SQL_BOILERPLATE}) WHERE cleaned <> '' AND doc_id IN (SELECT doc_id FROM documents WHERE {_sql_strip('text')} <> '')",
    "ocr_quality": _SQL_OCR,
    "batch_counters": _SQL_OUTCOMES,
    "anachronism_scan": _SQL_SCAN,
    "contamination_rate": _SQL_CONTAMINATION,
    "estimate_tokens": "SELECT doc_id, trunc(length(text) / 3.5)::BIGINT AS n_est FROM documents",
    "doc_cap": "SELECT doc_id, substr(text, 1, 10000) AS head, length(text) > 10000 AS was_cut FROM documents",
    "slugify": "SELECT DISTINCT ebook_id, array_to_string(string_split(lower(title), ' '), '-') AS slug FROM manifest",
    "url_format": """SELECT DISTINCT ebook_id, t.try::INT AS try, replace(t.p, '#', ebook_id::VARCHAR) AS path FROM manifest,
        (VALUES (0, 'files/#/#-0.txt'), (1, 'files/#/#.txt'), (2, 'cache/epub/#/pg#.txt')) t(try, p) WHERE ebook_id IS NOT NULL""",
    "name_exclusion": "SELECT page_id, batch_name FROM newspapers WHERE NOT contains(batch_name, 'norstead') AND NOT contains(batch_name, 'vnstcsc')",
    "suffix_filter": "SELECT page_id FROM newspapers WHERE suffix(member_path, 'ocr.txt')",
    "lexicon_build": f"SELECT DISTINCT {_sql_strip('lower(word)')} AS word FROM lexicon WHERE length({_sql_strip('word')}) >= 2",
}
