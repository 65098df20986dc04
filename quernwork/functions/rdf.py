"""Catalog records from RDF/XML."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Name spaces of the catalog's format (fixed values).
SPACES = {
    "rdf": "http://www.w3.org/1999/02/22-rdf-syntax-ns#",
    "dcterms": "http://purl.org/dc/terms/",
    "pgterms": "http://www.gutenberg.org/2009/pgterms/",
}
SCHEMA = (
    "ebook_id int, title string, author string, author_birth int, author_death int, language string,"
    " subjects array<string>, description string, has_text boolean"
)
_YEAR = re.compile(r"\b(\d{4})\b")


def _year(text: str) -> int | None:
    found = _YEAR.search(text)
    return int(found[1]) if found and 1000 <= int(found[1]) <= 2100 else None


def parse(xml: str | bytes | None) -> dict | None:
    """One record, or None where the text is no XML or names no numbered book."""
    if xml is None:
        return None
    try:
        root = ET.fromstring(xml)
    except (ET.ParseError, ValueError):
        return None
    book = root.find("pgterms:ebook", SPACES)
    about = "{%s}about" % SPACES["rdf"]
    number = re.search(r"/(\d+)$", book.get(about, "")) if book is not None else None
    if not number:
        return None

    def told(parent: ET.Element | None, path: str) -> str:
        at = parent.find(path, SPACES) if parent is not None else None
        return (at.text or "").strip() if at is not None else ""

    agent = book.find("dcterms:creator/pgterms:agent", SPACES)
    value = "rdf:Description/rdf:value"
    files = book.findall("dcterms:hasFormat/pgterms:file", SPACES)
    plain = any(
        f.get(about, "").endswith(".txt")
        or "text/plain" in f.get(about, "")
        or any("text/plain" in (v.text or "") for v in f.findall(f"dcterms:format/{value}", SPACES))
        for f in files
    )
    return {
        "ebook_id": int(number[1]), "title": told(book, "dcterms:title"), "author": told(agent, "pgterms:name"),
        "author_birth": _year(told(agent, "pgterms:birthdate")), "author_death": _year(told(agent, "pgterms:deathdate")),
        "language": told(book, f"dcterms:language/{value}"),
        "subjects": [s for x in book.findall("dcterms:subject", SPACES) if (s := told(x, value))],
        "description": told(book, "dcterms:description"), "has_text": plain,
    }


def parse_rdf(xml: Column) -> Column:
    """struct of the record; all fields null where there is none."""
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    names = [n.strip() for n in names]

    def run(texts: pd.Series) -> pd.DataFrame:
        found = [parse(t) or {} for t in texts]
        return pd.DataFrame({n: pd.Series([f.get(n) for f in found], dtype=object) for n in names})

    return F.pandas_udf(run, SCHEMA)(xml)
