"""Problem 3: statistics of each record's text, and whether it is natural prose, a list, a table or junk.

Each line is judged by its tokens (words, common words, figures, signs, no language), and runs of like lines by their
layout: delimiters that stand below each other, entries of like form, the period of indents and of line lengths
(autocorrelation). ``row_score`` and ``entry_score`` weigh the layout with the ratios of figures, signs, common words
and end punctuation, and settle whether a run is a table, a list or prose. A record is what most of its characters are.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Rows of the word table that are taken to the executors; it is a small fixed table and more are refused.
MOST_WORDS = 1 << 18
#: Tokens whose judgement a worker keeps; then it starts afresh.
MOST_KEPT = 1 << 18
#: Words that hold sentences together in further languages (fixed values).
FUNCTION_WORDS = set(
    "le la les un une des du de et à au aux en dans que qui ne pas ce cette est était fut sont pour par sur sans avec "
    "il elle on nous vous ont aucun aussi plus si après mais où ces "
    "der die das den dem des ein eine einen einem einer und in im ist war wurde nicht zu von mit auf für daß sich als "
    "es auch hat haben kein keine bei nach vor so doch wie sehr gab sind ohne zwischen welche diese diesen dagegen "
    "el los las un una unos de del y en que se no es era fue eran muy por con para había hay pero sin otro este desde "
    "hasta más después según nos "
    "il lo i gli un una di del della dei e in nel nella che non è era fu erano per con da vi sono si ma fosse molto "
    "al alla nessun assai più dopo senza presso così le questo the of and to a is it was".split()
)

WORD, COMMON, FIGURE, JUNK, SIGN = range(5)
KINDS = ("prose", "list", "table", "junk")
#: What most of a record is where its prose has more characters: least share of characters and of lines.
MIXED_SHARE, MIXED_LINES = 0.3, 0.6
#: Least scores of a run that is a table or a list, and the run's least share of delimiters below each other (over
#: rows beside each other) from which lines that are no rows by their tokens are rows.
LEAST_ROWS, LEAST_ENTRIES, PLACED = 0.6, 0.5, 0.6
#: Lines that stand below each other at least before their delimiters make them rows.
LEAST_LINES = 3
_MARK = re.compile(r"\s*(?:[-*•–—·]\s+|\(?\d{1,4}[.)\]]?\s+|[A-Za-z]{1,9}\.?\s\d{1,4}[.:)]\s+|[ivxlcIVXLC]{1,6}[.)]\s+)(?=\S)")
_FIGURE = re.compile(r"[^\w]*(?:[£$]?\d[\d,.:/'°%½¼¾-]*|\d+(?:s|d|st|nd|rd|th|c|m|a|p|lb|oz)\.?)[^\w]*")
_BROKEN = re.compile(r"[ÃÂ�¿½€™�§¤¶]|[a-z][A-Z]|\d[A-Za-z]{2,}\d|[A-Za-z]\d[A-Za-z]")
#: Signs that do not stand beside words.
_RARE_SIGN = re.compile(r"""[^\w.,;:!?'"’‘“”„«»()\[\]—–$£&%-]""")
_CORE = re.compile(r"[^\W\d_]+")
_COLUMNS = re.compile(r"\t+| {2,}|\s*\|\s*|\s?\.{3,}\s?")
_ENDS = tuple(".!?:;,”\"'’)")


class Letters:
    """Letter pairs of known words: how far a word looks like language at all."""

    def __init__(self, words: list[str]) -> None:
        counts = np.full((28, 28), 0.5)
        for word in words:
            ids = [0, *(self._id(c) for c in word), 0]
            for a, b in zip(ids, ids[1:]):
                counts[a, b] += 1
        self.log = np.log(counts / counts.sum(axis=1, keepdims=True)).tolist()
        own = sorted(self.score(w) for w in words if len(w) >= 4)
        # below nearly all known words, with room for other languages and misread letters
        self.least = own[len(own) // 200] - 0.4 if own else -math.inf

    @staticmethod
    def _id(c: str) -> int:
        at = ord(c) - 96
        return at if 1 <= at <= 26 else 27

    def score(self, word: str) -> float:
        ids = [0, *(self._id(c) for c in word), 0]
        return sum(self.log[a][b] for a, b in zip(ids, ids[1:])) / (len(ids) - 1)


class Judge:
    """Judges tokens, lines and records; tokens once, as most come again."""

    def __init__(self, words: dict[str, bool]) -> None:
        self.common = {w for w, c in words.items() if c}
        self.known = set(words)
        self.letters = Letters(sorted(words))
        self.kept: dict[str, tuple[int, int, int, int, bool]] = {}

    def token(self, token: str) -> tuple[int, int, int, int, bool]:
        """(kind, letters, digits, signs, one of the common words)."""
        if (found := self.kept.get(token)) is not None:
            return found
        if len(self.kept) >= MOST_KEPT:
            self.kept.clear()
        letters = sum(c.isalpha() for c in token)
        digits = sum(c.isdigit() for c in token)
        cores = _CORE.findall(token.lower())
        common = len(cores) == 1 and cores[0] in self.common
        found = (self._kind(token, cores, letters, digits), letters, digits, len(token) - letters - digits, common)
        self.kept[token] = found
        return found

    def _kind(self, token: str, cores: list[str], letters: int, digits: int) -> int:
        if not letters and not digits:
            return SIGN if not _BROKEN.search(token) and len(set(token)) <= 2 or len(token) == 1 else JUNK
        if len(token) - letters - digits >= letters + digits and len(_RARE_SIGN.findall(token)) >= 2:
            return JUNK
        if digits and _FIGURE.fullmatch(token):
            plain = re.sub(r"\D", "", token)
            return JUNK if len(plain) >= 4 and len(set(plain)) == 1 else FIGURE
        if len(cores) == 1 and (cores[0] in self.common or cores[0] in FUNCTION_WORDS):
            return COMMON
        if cores and all(c in self.known for c in cores):
            return WORD
        longest = max(cores, key=len, default="")
        if len(longest) >= 2 and len(set(longest)) == 1 or (letters + digits >= 3 and len(set(token)) == 1):
            return JUNK
        odd = len(_BROKEN.findall(token))
        if odd >= 2 or odd and len(token) > 30:
            return JUNK
        if letters <= 2:
            return WORD if not odd else JUNK
        if all(ord(c) < 0x250 for c in longest) and len(longest) >= 3 and self.letters.score(longest) < self.letters.least:
            return JUNK
        return WORD

    def line(self, line: str) -> tuple[int, list[tuple]]:
        """What the line is by itself: prose, a possible list entry, a possible table row, or no language."""
        tokens = [self.token(t) for t in line.split()]
        n = [0] * 5
        size = [0] * 5
        for kind, letters, digits, signs, _ in tokens:
            n[kind] += 1
            size[kind] += letters + digits + signs
        told = n[WORD] + n[COMMON] + n[FIGURE] + n[JUNK]
        solid = sum(size) - size[SIGN]
        if size[JUNK] > 0.5 * max(1, solid) or not told and n[SIGN] >= 3:
            return 3, tokens
        if n[FIGURE] >= 2 and n[FIGURE] >= 0.4 * told or n[FIGURE] and n[FIGURE] == told and len(line) > len(line.lstrip()):
            return 2, tokens
        if len(_COLUMNS.split(line.strip())) >= 3 and n[COMMON] <= 0.15 * told:
            return 2, tokens
        if told <= 14:
            marked = _MARK.match(line) is not None
            if n[COMMON] <= (0.34 if marked else 0.12) * told and n[FIGURE] <= 0.5 * told:
                return 1, tokens
            # most words are names or titles, with small words between them
            if told <= 10 and n[COMMON] <= 0.4 * told and not n[FIGURE]:
                cased = [w[0].isupper() for w in line.split() if w[0].isalpha()]
                if sum(cased) >= 0.6 * len(cased) > 1:
                    return 1, tokens
            # a few names with at most one small word between them
            if told <= 5 and n[COMMON] == 1 and not n[FIGURE] and sum(w[:1].isupper() for w in line.split()) == told - 1:
                return 1, tokens
        return 0, tokens

    @staticmethod
    def form(line: str) -> tuple:
        """The form of an entry: its mark, its commas, how it begins and how it ends."""
        mark = _MARK.match(line)
        body = line[mark.end() :] if mark else line.strip()
        kind = re.sub(r"[\w]+", "1", mark[0].strip()) if mark else ""
        return kind, min(3, body.count(",")), body[:1].isupper(), line.rstrip()[-1:] in _ENDS

    def record(self, text: str) -> dict:
        lines = [line for line in text.splitlines() if line.strip()]
        judged = [self.line(line) for line in lines]
        kinds = [k for k, _ in judged]
        sizes = [len(line.strip()) for line in lines]
        columns = [len(_COLUMNS.split(line.strip())) if k == 2 else 0 for k, line in zip(kinds, lines)]
        aligned = _alignment(lines, columns)
        gaps = [_gaps(line) for line in lines]
        length_auto, indent_auto = _autocorrelation(sizes), _autocorrelation([len(x) - len(x.lstrip()) for x in lines])
        # lines whose delimiters stand below each other may be rows, whatever their tokens are
        kinds = _rows_by_place(kinds, gaps)
        # a lone line of figures or a lone entry is no table and no list
        forms = [self.form(line) if k == 1 else () for k, line in zip(kinds, lines)]
        kinds = _runs(kinds, forms, lines, gaps, [tokens for _, tokens in judged])
        share = [0.0] * 4
        for kind, size in zip(kinds, sizes):
            share[kind] += size
        total = sum(share) or 1.0
        share = [s / total for s in share]
        best = max(range(4), key=lambda k: share[k])
        if best == 0 and lines:
            # a few long lines above many short ones: most of the lines and a good part of the characters
            other = max(range(1, 4), key=lambda k: share[k])
            if share[other] >= MIXED_SHARE and kinds.count(other) >= MIXED_LINES * len(kinds):
                best = other
        flat = [t for _, tokens in judged for t in tokens]
        letters, digits, signs = (sum(t[i] for t in flat) for i in (1, 2, 3))
        words = sum(1 for t in flat if t[1])
        solid = letters + digits + signs
        return {
            "n_chars": len(text), "n_lines": len(lines), "n_words": words,
            "mean_word_length": letters / words if words else 0.0,
            "symbol_ratio": signs / solid if solid else 0.0,
            "digit_ratio": digits / solid if solid else 0.0,
            "end_punctuation_share": sum(x.rstrip().endswith(_ENDS) for x in lines) / len(lines) if lines else 0.0,
            "common_word_share": sum(t[4] for t in flat) / words if words else 0.0,
            "alignment": aligned, "line_length_autocorrelation": length_auto, "indent_autocorrelation": indent_auto,
            "list_share": share[1], "table_share": share[2], "junk_share": share[3],
            "kind": KINDS[best] if lines else None,
        }


def _gaps(line: str) -> list[tuple[int, int, bool]]:
    """(start, end, tab) of each delimiter within the line."""
    if "  " not in line and "\t" not in line and "|" not in line and "..." not in line:
        return []
    first, last = len(line) - len(line.lstrip()), len(line.rstrip())
    return [(m.start(), m.end(), "\t" in m[0]) for m in _COLUMNS.finditer(line, first, last) if first < m.start() and m.end() < last]


def _placed(a: list[tuple[int, int, bool]], b: list[tuple[int, int, bool]]) -> float:
    """Share of the delimiters of two lines that begin or end at the same place; tabs are met by their order."""
    if not a or not b:
        return 0.0
    met = 0
    for i, (start, end, tab) in enumerate(a):
        if tab:
            met += i < len(b) and b[i][2]
        else:
            met += any(not t and (abs(s - start) <= 1 or abs(e - end) <= 1) for s, e, t in b)
    return met / max(len(a), len(b))


def _rows_by_place(kinds: list[int], gaps: list[list[tuple[int, int, bool]]]) -> list[int]:
    """Lines of prose and entries become possible rows where ``LEAST_LINES`` or more have their delimiters in the same
    places."""
    out = list(kinds)
    i = 0
    while i < len(kinds):
        j = i + 1
        while j < len(kinds) and gaps[j] and _placed(gaps[j - 1], gaps[j]) >= PLACED:
            j += 1
        if j - i >= LEAST_LINES:
            out[i:j] = [2 if k < 2 else k for k in kinds[i:j]]
        i = j
    return out


def _ratios(tokens: list[list[tuple]]) -> tuple[float, float, float]:
    """(digits, signs) by characters and common words by words."""
    flat = [t for row in tokens for t in row]
    letters, digits, signs = (sum(t[i] for t in flat) for i in (1, 2, 3))
    solid, words = max(1, letters + digits + signs), max(1, sum(1 for t in flat if t[1]))
    return digits / solid, signs / solid, sum(t[4] for t in flat) / words


def row_score(placed: float, even: float, digits: float, signs: float, common: float) -> float:
    """How far a run is a table: delimiters in the same places, equal numbers of columns, figures and signs."""
    return 1.5 * placed + 0.5 * even + min(1.0, 3 * digits) + min(0.5, 2 * signs) - 1.5 * common


def entry_score(alike: float, marked: float, indents: float, lengths: float, ends: float, common: float) -> float:
    """How far a run is a list: entries of one form, marks, periods of indents and line lengths, and as many that end
    with punctuation as is the rule of the run (all or none)."""
    period = max(0.0, indents) + max(0.0, lengths)
    return max(alike, marked) + 0.6 * min(1.0, period) + 0.2 * abs(2 * ends - 1) - 0.6 * common


def _runs(kinds: list[int], forms: list[tuple], lines: list[str], gaps: list, tokens: list) -> list[int]:
    """Possible rows and entries become prose where no neighbour is of the same kind, and runs of them where neither
    layout nor ratios bear them out; rows that do not score as a table may still be a list."""
    out = list(kinds)
    i = 0
    while i < len(kinds):
        j = i
        while j < len(kinds) and kinds[j] == kinds[i]:
            j += 1
        n = j - i
        if kinds[i] in (1, 2) and n < 2 and not (j < len(kinds) and kinds[j] in (1, 2) or i and kinds[i - 1] in (1, 2)):
            out[i:j] = [0] * n
        elif kinds[i] in (1, 2) and n >= 2:
            digits, signs, common = _ratios(tokens[i:j])
            pairs = list(zip(gaps[i:j], gaps[i + 1 : j]))
            placed = sum(_placed(a, b) for a, b in pairs) / len(pairs)
            even = sum(len(a) == len(b) > 0 for a, b in pairs) / len(pairs)
            shapes = forms[i:j] if kinds[i] == 1 else [Judge.form(line) for line in lines[i:j]]
            seen: dict[tuple, int] = {}
            for shape in shapes:
                seen[shape] = seen.get(shape, 0) + 1
            indents = [len(x) - len(x.lstrip()) for x in lines[i:j]]
            # an even margin tells nothing of a list
            by_indent = _autocorrelation(indents) if len(set(indents)) > 1 else 0.0
            entries = entry_score(
                max(seen.values()) / n, sum(1 for shape in shapes if shape[0]) / n, by_indent,
                _autocorrelation([len(x.strip()) for x in lines[i:j]]), sum(shape[3] for shape in shapes) / n, common,
            )
            rows = row_score(placed, even, digits, signs, common)
            if kinds[i] == 2:
                out[i:j] = [2 if rows >= LEAST_ROWS else 1 if entries >= LEAST_ENTRIES else 0] * n
            else:
                out[i:j] = [1 if entries >= LEAST_ENTRIES else 0] * n
        i = j
    return out


def _alignment(lines: list[str], columns: list[int]) -> float:
    """Share of neighbouring rows with as many columns."""
    pairs = [(a, b) for a, b in zip(columns, columns[1:]) if a > 1 or b > 1]
    return sum(a == b for a, b in pairs) / len(pairs) if pairs else 0.0


def _autocorrelation(values: list[int]) -> float:
    """The largest autocorrelation of the sequence at lags 1 to 4; 1 for an even one, 0 for fewer than 6 values."""
    n = len(values)
    if n < 6:
        return 0.0
    mean = sum(values) / n
    off = [v - mean for v in values]
    whole = sum(x * x for x in off)
    if whole == 0:
        return 1.0
    return max(sum(a * b for a, b in zip(off, off[lag:])) / whole for lag in range(1, 5))


_STATS = (
    ("n_chars", pa.int64(), "bigint"), ("n_lines", pa.int64(), "bigint"), ("n_words", pa.int64(), "bigint"),
    *((name, pa.float64(), "double") for name in (
        "mean_word_length", "symbol_ratio", "digit_ratio", "end_punctuation_share", "common_word_share", "alignment",
        "line_length_autocorrelation", "indent_autocorrelation", "list_share", "table_share", "junk_share",
    )),
    ("kind", pa.string(), "string"),
)


def _judged(words: dict[str, bool]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(words)
        none = dict.fromkeys(name for name, _, _ in _STATS)
        for batch in batches:
            found = [none if t is None else judge.record(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1)]
                + [pa.array([f[name] for f in found], kind) for name, kind, _ in _STATS],
                names=["table_name", "record_id", *(name for name, _, _ in _STATS)],
            )

    return run


def text_statistics(records: DataFrame, lexicon: DataFrame) -> DataFrame:
    """The statistics and the kind of each row of (table_name, record_id, text).

    Null texts have null statistics; blank ones have zeros and a null kind. Repeated rows stay repeated.
    """
    rows = lexicon.dropna().select(F.lower("word").alias("word"), "is_common").limit(MOST_WORDS + 1).collect()
    if len(rows) > MOST_WORDS:
        raise ValueError(f"more than {MOST_WORDS} words")
    words: dict[str, bool] = {}
    for r in rows:
        words[r.word] = words.get(r.word, False) or r.is_common
    kinds = ", ".join(f"{name} {kind}" for name, _, kind in _STATS)
    return records.select("table_name", "record_id", "text").mapInArrow(
        _judged(words), f"table_name string, record_id string, {kinds}"
    )


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    papers = table(spark, sf_dir, "newspapers").select(
        F.lit("newspapers").alias("table_name"), F.col("page_id").cast("string").alias("record_id"), "text"
    )
    items = table(spark, sf_dir, "internetarchive").select(
        F.lit("internetarchive").alias("table_name"), F.col("identifier").alias("record_id"), "text"
    )
    return papers.unionByName(items)


def not_prose(records: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(table_name, record_id, kind), each once, of the records that are a list, a table or junk."""
    judged = text_statistics(records, lexicon)
    return judged.filter(F.col("kind") != "prose").select("table_name", "record_id", "kind").distinct()


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return not_prose(_records(spark, sf_dir), table(spark, sf_dir, "lexicon"))


def p3_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_statistics(_records(spark, sf_dir), table(spark, sf_dir, "lexicon"))


QUERIES = {"p3_found": p3_found, "p3_statistics": p3_statistics}
ORACLES: dict[str, str] = {}
