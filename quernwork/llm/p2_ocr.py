"""Problem 2: text from scanned pages into continuous paragraphs.

1. Every newspaper title has a running name: the line, without date, numbers and blanks, that its records repeat most.
2. Lines are judged with their neighbours: boosted trees tell running headers and page numbers from the body, and
   whether a word is divided between a line and the next line of the body. They are fitted on the lines of all records,
   labelled by repetition and by spelling and counted by what is told of them, and on copies of the headers with
   characters misread on purpose. One scan of the texts counts the lines and keeps of each record what judging it takes (``Page``);
   the texts themselves are not looked at again, unless they are repaired.
3. Words that are not in the lexicon, but whose folded spelling comes near a word of it, are looked up once each: an
   inverted index of character 3-grams, sent with the tasks, finds candidates, boosted trees rank them, and the best is taken if its
   probability passes ``LEAST_PROBABILITY``.
"""

from __future__ import annotations

import pickle
import random
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from difflib import SequenceMatcher
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .boost import BINS, Boosted, cuts_of
from .common import cut, table
from .ocr_words import (
    SPECKS, TOKEN, Plausible, Retrieval, bare, corrupt, features, made_rows, made_tokens, name_rows,
)

#: Records that are added to those of each word of the lexicon, so that a token of few records is no name yet.
MORE_RECORDS = 15
#: Different header lines are misread on purpose so many times at most; the copies weigh as two for each line.
MOST_COPIES = 16
#: Different rows that a model is fitted on; where there are more, values fall into fewer bins, and all still count.
MOST_ROWS = 1 << 20
MOST_WORDS = 1 << 18
#: A last word of running names is a kind of newspaper if so many titles in all and so large a part of them have it,
#: which bounds the number of kinds at any size.
TYPE_TITLES, TYPE_PART = 2, 1e-3
#: Letters of the names, and misread words, that are sent to all executors; more are joined by a shuffle.
MOST_LETTERS, MOST_FIXES = 1 << 24, 1 << 17
#: Probability from which a word is taken for misread where at least half of ``FULL_KNOWN`` of the record's words are
#: known; the fewer they are, the surer the ranking must be.
LEAST_PROBABILITY, FULL_KNOWN = 0.5, 0.5

#: Different signs beside a number's digits from which a line is labelled as none, for fitting.
MOST_SIGNS = 3

HYPHENS = "-‐‑­¬="
_ENDS = tuple(HYPHENS)
_BREAK = re.compile(r"\r\n|\r|\n")
_DATE = re.compile(r"(?:[^\W\d_][\w!|]{4,10}[,.]?\s+)?(?:[^\W\d_]|0)[\w!|]{2,9}\.?\s+[\dlOo]{1,2},\s+[\dlOo]{4}")
_SMALL_WORD = re.compile(r"(?:^|\s)[^\W\dA-Z_l]")
_SMALL = re.compile(r"[a-z]{2}")
#: A word that neither lines that may be headers nor those that are numbers have; most lines are passed over by it. In a
#: line, and in a token.
_BODY = re.compile(r"(?:^|\s)(?=[a-km-z][a-z])[a-z]*[bdfhjkmqrstuwyz]")
_BODY_TOKEN = re.compile(r"(?=[a-km-z][a-z])[a-z]*[bdfhjkmqrstuwyz]")
_EDGE = re.compile(r"^\W*(?:page\s+)?\d{1,3}\W+(?=\D)|(?<=\D)\s+\W*(?:page\s+)?\d{1,3}\W*$", re.I)
_LOOKS = str.maketrans({"0": "O", "1": "I", "5": "S", "!": "I", "|": "I", "9": "G", "É": "E", "Ä": "A"})
_NUMBER = re.compile(r"\W*(?:page|p\.|no\.)?\W*(\d{1,4}|[ivxlc]{1,7})\W*", re.I)
_DIVIDED = re.compile(rf"(?:^|[\s“”\"(\[—])([^\W\d_][\w'’{re.escape(SPECKS)}!-]*?)\s?([{HYPHENS}])\s*$")
_YEAR = re.compile(r"\d{4}[.,;]?")
_LAST = re.compile(r"([^\W\d_]\w*)\W*$")
_DIGIT = re.compile(r"\d")
_FIGURE = re.compile(r"\d\S*")
_NO_CAPITAL = re.compile(r"[^A-Z]+")
_CAPITALS = re.compile(r"[A-Z]{2,}")
_AT_OF = re.compile(r"\bAT\b|\bOF\b")
_BEGINS = re.compile(rf"\s*([^\W\d_][\w'’{re.escape(SPECKS)}!]*(?:-[^\W\d_]\w*)?)")


def _dates(line: str) -> list[re.Match]:
    return list(_DATE.finditer(line)) if "," in line else []


def _redated(line: str, dates: list[re.Match], by: Callable[[re.Match], str]) -> str:
    for m in reversed(dates):
        line = f"{line[: m.start()]}{by(m)}{line[m.end() :]}"
    return line


def core_of(line: str, dates: list[re.Match]) -> tuple[str, str]:
    """The letters of a possible header without date, numbers and blanks, and its last word."""
    rest = _redated(line, dates, lambda m: " ")
    rest = (_EDGE.sub(" ", rest) if _DIGIT.search(rest) else rest).strip().upper().translate(_LOOKS)
    letters = _NO_CAPITAL.sub("", rest)
    words = _CAPITALS.findall(rest)
    return letters[3:] if letters.startswith("THE") and len(letters) > 7 else letters, words[-1] if words else ""


def may_be_header(line: str) -> bool:
    """Either in capitals or with a date and no word that begins small."""
    if len(line) < 3:
        return False
    return not _SMALL.search(line) or (_SMALL_WORD.search(line) is None and _DATE.search(line) is not None)


def likeness(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if not a or not b or abs(len(a) - len(b)) > 4:
        return 0.0
    return SequenceMatcher(None, a, b, autojunk=False).ratio()


@lru_cache(maxsize=1 << 16)
def _core_features(core: str, name: str | None, types: tuple[str, ...]) -> tuple[float, float]:
    """Likeness to the running name, and whether the core ends as names of newspapers do; most cores come again."""
    kind = 0.0
    for t in types:
        if core.endswith(t):
            kind = 1.0
            break
        if len(core) > len(t) and sum(x == y for x, y in zip(core[-len(t) :], t)) >= len(t) - 1 >= 4:
            kind = max(kind, 0.8)
    return likeness(core, name) if name else -1.0, kind


def header_marks(line: str, dates: list[re.Match], core: str) -> tuple[float, ...]:
    """What is told of a possible header besides its core."""
    upper = line.upper()
    return (
        float(bool(dates)), float(len(core)), float(not _SMALL.search(line)),
        float(_AT_OF.search(upper) is not None), float(upper.lstrip(" \t0123456789").startswith(("THE", "T H E"))),
    )


def header_features(line: str, name: str | None, types: tuple[str, ...]) -> list[float]:
    return _header_features(line, (name,), types)[0]


def _header_features(line: str, names: tuple[str | None, ...], types: tuple[str, ...]) -> list[list[float]]:
    """Those with each of the names."""
    dates = _dates(line)
    core, _ = core_of(line, dates)
    marks = header_marks(line, dates, core)
    return [[*_core_features(core, name, types), *marks] for name in names]


def _unfinished(line: str | None) -> bool:
    return bool(line) and line.rstrip()[-1:] not in ".!?”\":"


def _figures(line: str | None) -> int:
    if not line:
        return 0
    return len(_FIGURE.findall(line)) if line.isascii() else sum(any(map(str.isdigit, t)) for t in line.split())


@lru_cache(maxsize=1 << 16)
def _own_number_features(line: str) -> tuple[float, ...]:
    """What the line itself tells of a number; most come again."""
    found = _NUMBER.fullmatch(line.strip())
    digits = found[1] if found else ""
    roman = digits.isalpha()
    digits = "1" * min(2, len(digits)) if roman else digits
    signs = set(re.sub(r"[\w\s.]", "", line))
    return (
        float(len(digits)), float(int(digits or 0)), float(len(signs)), float("." in line),
        float(len(line) - len(line.lstrip()) > 2), float(len(digits) == 4 and 1000 < int(digits) < 2100),
        float(roman and not line.strip().isupper()),
    )


def _around(before: str | None, after: str | None) -> tuple[float, float, float]:
    """What the lines around tell of a number."""
    return (
        float(_unfinished(before)), float((after or "").lstrip()[:1].islower()),
        float(min(4, max(_figures(before), _figures(after)))),
    )


def number_features(line: str, around: tuple[float, float, float]) -> tuple[float, ...]:
    own = (_own_number_features if len(line) <= 64 else _own_number_features.__wrapped__)(line)
    return (*own[:5], *around, *own[5:])


def join_features(first: str, sign: str, second: str, gap: int, known: set[str]) -> list[float]:
    a, b = first.lower(), second.lower()
    return [
        float(bool(sign)), float(a + b in known), float(a in known), float(b in known), float(f"{a}-{b}" in known),
        float(second[:1].islower()), float(len(a)), float(len(b)), float(gap), float(a.isalpha()),
        float(b.isalpha()),
    ]


@dataclass
class Lines:
    """Models and tables that lines are judged by."""

    words: dict[str, bool]
    types: tuple[str, ...]
    header: Boosted
    number: Boosted
    join: Boosted
    known: set[str] = field(default_factory=set)
    kept: dict = field(default_factory=dict)
    tokens: Tokens | None = None
    shares: dict[str, float] = field(default_factory=dict)

    def ready(self) -> Lines:
        if self.tokens is None:
            self.known = set(self.words)
            self.tokens = tokens_of(frozenset(self.known))
        return self

    def _sure(self, model: str, row: Iterable[float]) -> bool:
        key = (model, *row)
        if (found := self.kept.get(key)) is None:
            if len(self.kept) > 1 << 17:
                self.kept.clear()
            found = self.kept[key] = getattr(self, model).one(row) > 0.5
        return found

    def furniture(self, lines: list[str], name: str | None) -> list[str | None]:
        """``header``, ``page_number`` or None of each line."""
        out: list[str | None] = [None] * len(lines)
        for i, line in enumerate(lines):
            if _BODY.search(line):
                continue
            bare_line = line.strip()
            if not bare_line:
                continue
            if _NUMBER.fullmatch(bare_line):
                before, after = (lines[i - 1] if i else None), (lines[i + 1] if i + 1 < len(lines) else None)
                if self._sure("number", number_features(line, _around(before, after))):
                    out[i] = "page_number"
            elif may_be_header(bare_line) and self._sure("header", header_features(bare_line, name, self.types)):
                out[i] = "header"
        return out

    def divided(self, lines: list[str], kinds: list[str | None]) -> dict[int, tuple[int, str, str, bool]]:
        """Line -> (line that goes on, the two parts, whether the hyphen is the word's own)."""
        out = {}
        for i, line in enumerate(lines):
            if kinds[i] is not None or not line.rstrip().endswith(_ENDS):
                continue
            found = _DIVIDED.search(line)
            if not found:
                continue
            j, between = i + 1, False
            while j < len(lines) and (kinds[j] is not None or not lines[j].strip()):
                between |= kinds[j] is not None
                j += 1
            if j >= len(lines) or (j > i + 1 and not between):
                continue
            goes_on = _BEGINS.match(lines[j])
            if not goes_on:
                continue
            first, second = found[1], goes_on[1].rstrip("'’!")
            own = self._own_hyphen(first, found[2], second, j - i - 1)
            if own is not None:
                out[i] = (j, first, second, own)
        return out

    def _own_hyphen(self, first: str, sign: str, second: str, gap: int) -> bool | None:
        """Whether the hyphen is the word's own; None where no word is divided."""
        if not self._sure("join", join_features(first, sign, second, gap, self.known)):
            return None
        if (first + second).lower() in self.known:
            return False
        plausible = self.tokens.plausible
        if f"{first}-{second}".lower() in self.known:
            return True
        return not plausible(first + second) and ("-" in first or plausible(f"{first}-{second}"))

    def odd_words(self, bodies: list[str]) -> tuple[set[str], float]:
        """Words of the lines that may be misread, and the share of known words."""
        words = sure = 0
        odd: set[str] = set()
        self.tokens.bound()
        told = self.tokens.told
        for token, n in Counter(" ".join(bodies).split()).items():
            is_word, is_known, parts = told(token)
            if is_word:
                words += n
                sure += n * is_known
            if parts:
                odd.update(parts)
        return odd, sure / words if words else 0.0

    def items(self, page: Page, name: str | None) -> tuple[set[tuple[str, str]], float]:
        """(kind, item) of a record, and its share of known words; kinds ``divided`` and ``odd`` still await the word
        that was meant."""
        words, sure, odd, marks = *page[:3], pickle.loads(page[3])
        out: set[tuple[str, str]] = set()
        less: list[str] = []
        more: list[str] = []
        furniture: set[int] = set()
        for i, mark, *_ in marks:
            if mark is None:
                continue
            kind, flat, row = mark
            if kind == "header":
                row = (*_core_features(row[0], name, self.types), *row[1])
            if self._sure("header" if kind == "header" else "number", row):
                out.add((kind, flat))
                furniture.add(i)
                less.append(flat)
        left = [m for m in marks if m[0] not in furniture] if furniture else marks
        ended, begun = set(), set()
        for (i, _, ends, *_), (j, _, _, begins, _) in zip(left, left[1:]):
            if ends is None or begins is None or (j > i + 1 and furniture.isdisjoint(range(i + 1, j))):
                continue
            first, sign = ends[:2]
            second = begins[0].rstrip("'’!")
            own = self._own_hyphen(first, sign, second, j - i - 1)
            if own is None:
                continue
            whole = bare(f"{first}-{second}" if own else first + second)
            out.add(("divided", whole))
            more.append(whole)
            ended.add(i)
            begun.add(j)
        if ended:
            # the parts alone are no words of the text
            for i, _, ends, begins, short in left:
                if short is not None and i in ended and i in begun:
                    less.append(short)
                    more.append(_DIVIDED.sub(" ", _BEGINS.sub(" ", short, count=1)))
                    continue
                for part in ends[2:] if i in ended else (), begins[1:] if i in begun else ():
                    if part:
                        less.append(part[0])
                        more.append(part[1])
        told, gone = self.tokens.told, []
        for token in " ".join(less).split():
            is_word, is_known, parts = told(token)
            words -= is_word
            sure -= is_known
            gone += parts
        found = list(odd)
        for token in " ".join(more).split():
            is_word, is_known, parts = told(token)
            words += is_word
            sure += is_known
            found += parts
        out.update(("odd", word) for word in (Counter(found) - Counter(gone) if gone else found))
        return out, sure / words if words else 0.0

    def repaired(self, text: str, name: str | None, meant: dict[str, tuple[str, float]], plain: set[str] | None = None) -> str:
        """The text without furniture, with divided and misread words put right and lines of a paragraph joined.
        ``meant`` gives words and their probabilities; ``plain`` keeps tokens without such a word, for one ``meant``."""
        plain = set() if plain is None else plain
        lines = _BREAK.split(text)
        kinds = self.furniture(lines, name)
        joined = self.divided(lines, kinds)

        least = 1 - min(LEAST_PROBABILITY, self.odd_words(lines)[1] / FULL_KNOWN)

        def right(match: re.Match) -> str:
            token = match[0]
            word = bare(token)
            for part in [word, *word.split("-")] if word else ():
                to, sure = meant.get(part, (None, 0.0))
                if to is not None and sure > least:
                    cased = to.upper() if part.isupper() and len(part) > 1 else to.capitalize() if part[:1].isupper() else to
                    token = token.replace(part, cased)
            return token

        def put_right(body: str) -> str:
            """Most tokens come again and hold no misread word, so that most lines are passed over."""
            tokens = TOKEN.findall(body)
            if plain.issuperset(tokens):
                return body
            if len(plain) > 1 << 18:
                plain.clear()
            for token in tokens:
                word = bare(token)
                if not any(part in meant for part in [word, *word.split("-")]):
                    plain.add(token)
            return body if plain.issuperset(tokens) else TOKEN.sub(right, body)

        paragraphs: list[str] = []
        here, cut_first, last_end = "", 0, None
        gap = False
        for i, line in enumerate(lines):
            if kinds[i] is not None:
                continue
            if not line.strip():
                gap = True
                continue
            if gap and here and last_end is None:
                paragraphs.append(here)
                here = ""
            gap = False
            start = max(cut_first, len(line) - len(line.lstrip()))
            body, cut_first = line[start:].strip(), 0
            if i in joined:
                j, first, second, own = joined[i]
                found = _DIVIDED.search(line)
                whole = f"{first}-{second}" if own else first + second
                body = line[start : found.start(1)].lstrip() if start < found.start(1) else ""
                body = body + whole
                cut_first = _BEGINS.match(lines[j]).end()
            body = re.sub(r"(?<=\w)—(?=\s|$)", "", body)
            body = re.sub(r"[ \t]+", " ", put_right(body))
            if not here:
                here = body
            elif last_end is not None:
                here += body if body[:1] in ".,;:!?’”)" else f" {body}"
            elif _figures(line) < 3:
                here += f" {body}"
            else:
                here += f"\n{body}"
            last_end = i if i in joined else None
        if here:
            paragraphs.append(here)
        return "\n\n".join(p.strip() for p in paragraphs)


#: What one scan of the texts counts. ``name``: records of a title that have the line's core, with its last word;
#: ``header``: lines of a title by form; ``number`` and ``join``: rows of these models; ``word``: records that have a word;
#: ``record``: all records.
COUNTED = "kind string, lccn string, item string, last string, row array<double>, label double, n bigint"
ROWS = "model string, row array<double>, label double, n double"


def header_form(line: str, dates: list[re.Match]) -> str:
    """The line with another date and other figures at its ends, which the model of headers does not look at."""
    line = _redated(line, dates, lambda m: "Tuesday, April 3, 1908" if _SMALL.search(m[0]) else "TUESDAY, APRIL 3, 1908")
    return _EDGE.sub(lambda m: _DIGIT.sub("1", m[0]), line) if _DIGIT.search(line) else line


class _Kept(dict):
    """What ``make`` gives for a key, made once."""

    def __init__(self, make: Callable) -> None:
        self.make = make

    def __missing__(self, key: str) -> object:
        found = self[key] = self.make(key)
        return found


class Tokens:
    """What is told of tokens, which are numbered as they come; most come again."""

    def __init__(self, known: frozenset[str]) -> None:
        self.known, self.spelled = known, sorted(known)
        self.places = {w: i for i, w in enumerate(self.spelled)}
        self.plausible = Plausible(self.spelled)
        self._clear()

    def _clear(self) -> None:
        self.numbers = _Kept(self._number)
        #: (1 if a word, 1 if a known one, parts that are no words of the lexicon and come near one), by number.
        self.rows: list[tuple[int, int, tuple[str, ...]]] = []
        #: Places of words of the lexicon in the token: -1 if there is none, the first otherwise; the others by number.
        self.first: list[int] = []
        self.others: dict[int, tuple[int, ...]] = {}
        self.lasts, self.seconds = _Kept(self._last), _Kept(self._second)
        #: Those that ``_BODY`` finds a line of the body by, and years.
        self.body: set[str] = set()
        self.years: set[str] = set()

    def bound(self) -> None:
        """Forgets the tokens if there are many; numbers do not hold beyond it."""
        if max(len(self.numbers), len(self.lasts), len(self.seconds)) > 1 << 18:
            self._clear()

    def told(self, token: str) -> tuple[int, int, tuple[str, ...]]:
        return self.rows[self.numbers[token]]

    def _number(self, token: str) -> int:
        words, sure, odd, on = 0, 0, [], set()
        if _BODY_TOKEN.match(token):
            self.body.add(token)
        elif _YEAR.fullmatch(token):
            self.years.add(token)
        for piece in (token,) if (whole := token.isalpha()) else TOKEN.findall(token):
            word = piece if whole else bare(piece)
            low = word.lower()
            if low in self.known:
                on.add(self.places[low])
            if len(word) < 2:
                continue
            if low in self.known:
                words, sure = 1, 1
                continue
            words = max(words, int(word.isalpha()))
            parts = [word]
            if "-" in word and not self.plausible(word):
                parts = [bare(p) for p in word.split("-")]
            for part in parts:
                letters = sum(map(str.isalpha, part))
                if letters and letters >= len(part) / 2 and part.lower() not in self.known and len(part) > 1:
                    if self.plausible(part):
                        odd.append(part)
        number = len(self.rows)
        self.rows.append((words, sure, tuple(odd)))
        first, *others = sorted(on) or [-1]
        self.first.append(first)
        if others:
            self.others[number] = tuple(others)
        return number

    def _last(self, token: str) -> str:
        """The last word of a line that ends with the token; "" if the whole line must be looked at."""
        if token.endswith(_ENDS):
            return ""
        last = token.rstrip(".,;:!?”")
        if last.isalpha():
            return last
        found = _LAST.search(token)
        return found[1] if found else ""

    def _second(self, token: str) -> tuple[str, str, float, float, float, float] | None:
        """The word that a line which begins with the token goes on with, and what ``join_features`` has of it."""
        found = None if token.isalpha() else _BEGINS.match(token)
        if found is None and not token.isalpha():
            return None
        second = found[1] if found else token
        b = second.lower()
        return second, b, float(b in self.known), float(second[:1].islower()), float(len(b)), float(b.isalpha())


@lru_cache(maxsize=1)
def tokens_of(known: frozenset[str]) -> Tokens:
    """One for all tasks of a Python worker."""
    return Tokens(known)


#: What is needed of a record to judge its lines without its text: words, known words, parts of its tokens that may be
#: misread (as often as they stand there), and the lines that may be furniture, divide a word or go on with one, in order:
#: (number, furniture, end, begin, line). Furniture: kind, line and what the model is told, for headers core and marks.
#: End: first part of a word, sign, what goes if the word is divided, and what stays of it. Begin: second part, and the
#: same. The line is given where end and begin may meet.
#: These lines are pickled, as many are kept for long.
Page = tuple[int, int, tuple[str, ...], bytes]


class LineCounts:
    """What ``COUNTED`` says of some records, and their ``Page``s."""

    def __init__(self, known: set[str], tokens: Tokens | None = None) -> None:
        self.known, self.tokens = known, tokens or Tokens(frozenset(known))
        self.tokens.bound()
        self.names, self.headers, self.numbers, self.broken, self.joins, self.pairs = (Counter() for _ in range(6))
        self.codes: list[np.ndarray] = []
        self.marks: list[bytes] = []

    def add(self, title: str | None, text: str) -> None:
        lines = _BREAK.split(text) if "\r" in text else text.split("\n")
        split = list(map(str.split, lines))
        self.codes.append(np.fromiter(map(self.tokens.numbers.__getitem__, chain.from_iterable(split)), np.int64))
        body, years, lasts = self.tokens.body, self.tokens.years, self.tokens.lasts
        pairs, cores, marks = [], set(), []
        wanted = False
        for i, parts in enumerate(split):
            if not parts:
                continue
            line = lines[i]
            mark = ends = found = None
            if body.isdisjoint(parts):
                flat = line.strip()
                if found := _NUMBER.fullmatch(flat):
                    row = number_features(line, self._around(lines, i))
                    label = row[2] <= MOST_SIGNS and (len(found[1]) <= 3 or (found[1].isalpha() and found[1].islower()))
                    self.numbers[row, float(label)] += 1
                    mark = ("page_number", flat, row)
                if may_be_header(flat):
                    dates = _dates(flat)
                    core = core_of(flat, dates)
                    if title is not None:
                        cores.add(core)
                    if not found:
                        mark = ("header", flat, (core[0], header_marks(flat, dates, core[0])))
                        if title is not None:
                            self.headers[title, header_form(flat, dates)] += 1
            if not found and not years.isdisjoint(parts):
                # years as they would stand if a line of the body broke around them
                around = self._around(lines, i)
                for t in parts:
                    if t in years:
                        self.broken[t, around] += 1
            after = split[i + 1] if i + 1 < len(split) else None
            if last := lasts[parts[-1]]:
                if after:
                    pairs.append((last, after[0]))
            elif parts[-1].endswith(_ENDS) and (divided := _DIVIDED.search(line)):
                at = divided.start()
                stays = "" if not at or line[at].isspace() or line[at - 1].isspace() else line[:at].split()[-1]
                ends = (divided[1], divided[2], stays + line[at:], stays)
                if after and (second := self.tokens.seconds[after[0]]):
                    self.joins[divided[1], divided[2], second[0]] += 1
            elif after and (last := _LAST.search(parts[-1]) or _LAST.search(line.strip())):
                pairs.append((last[1], after[0]))
            if wanted or mark or ends:
                begins = short = None
                if wanted and (goes_on := _BEGINS.match(line)):
                    rest = line[goes_on.end() :]
                    stays = "" if not rest or rest[0].isspace() else rest.split(None, 1)[0]
                    begins = (goes_on[1], goes_on[0] + stays, stays)
                    short = line if ends and len(parts) <= 3 else None
                marks.append((i, mark, ends, begins, short))
                # lines that may be furniture are passed over, if they are, up to the line that goes on
                wanted = ends is not None or (wanted and mark is not None)
        self.pairs.update(pairs)
        self.names.update((title, core, last) for core, last in cores if len(core) >= 3)
        self.marks.append(pickle.dumps(marks, 5))

    @staticmethod
    def _around(lines: list[str], i: int) -> tuple[float, float, float]:
        return _around(lines[i - 1] if i else None, lines[i + 1] if i + 1 < len(lines) else None)

    def _join_label(self, first: str, second: str) -> float:
        name_like = first[:1].isupper() and second.isalpha()
        good = (first + second).lower() in self.known or f"{first}-{second}".lower() in self.known or name_like or second.islower()
        return float(good and first.isalpha() and len(second) > 1 and second[:1].islower())

    def _join_rows(self) -> Counter:
        joins: Counter = Counter()
        for (first, sign, second), n in self.joins.items():
            joins[tuple(join_features(first, sign, second, 0, self.known)), self._join_label(first, second)] += n
        # as ``join_features`` without a sign, which are many
        known, seconds = self.known, self.tokens.seconds
        firsts: dict[str, tuple[str, float, float, float]] = {}
        for (last, token), n in self.pairs.items():
            if (second := seconds[token]) is None:
                continue
            if (first := firsts.get(last)) is None:
                a = last.lower()
                first = firsts[last] = (a, float(a in known), float(len(a)), float(a.isalpha()))
            a, in_a, size_a, letters_a = first
            _, b, in_b, small, size_b, letters_b = second
            joins[(0.0, float(a + b in known), in_a, in_b, float(f"{a}-{b}" in known), small, size_a, size_b, 0.0, letters_a, letters_b), 0.0] += n
        return joins

    def _all_codes(self) -> tuple[np.ndarray, np.ndarray]:
        """The tokens' numbers and those of their records."""
        codes = np.concatenate(self.codes) if self.codes else np.empty(0, np.int64)
        return codes, np.repeat(np.arange(len(self.codes)), np.array(list(map(len, self.codes)), np.int64))

    def _words(self) -> dict[str, int]:
        """Records that have each word of the lexicon."""
        codes, records = self._all_codes()
        words, n = self.tokens.spelled, max(1, len(self.tokens.spelled))
        first = np.array(self.tokens.first, np.int64)[codes]
        pairs = [(records * n + first)[first >= 0]]
        if others := self.tokens.others:
            more = np.zeros(len(self.tokens.rows), bool)
            more[list(others)] = True
            pairs += [r * n + np.array(others[c]) for c, r in zip(codes[more[codes]].tolist(), records[more[codes]].tolist())]
        met = np.sort(np.concatenate(pairs))
        met = met[np.diff(met, prepend=-1) > 0]
        on = np.bincount(met % n, minlength=n)
        return {words[i]: int(on[i]) for i in np.flatnonzero(on)}

    def pages(self) -> list[Page]:
        codes, records = self._all_codes()
        rows = self.tokens.rows
        words, sure = (np.bincount(records, np.array([r[k] for r in rows], np.float64)[codes], len(self.codes)).astype(int).tolist() for k in (0, 1))
        may_be = np.array([bool(r[2]) for r in rows], bool)[codes]
        odd: list[list[str]] = [[] for _ in self.codes]
        for record, code in zip(records[may_be].tolist(), codes[may_be].tolist()):
            odd[record] += rows[code][2]
        return list(zip(words, sure, map(tuple, odd), self.marks))

    def rows(self) -> list[tuple]:
        """Rows of ``COUNTED``."""
        numbers = self.numbers.copy()
        for (year, around), n in self.broken.items():
            numbers[number_features(year, around), 0.0] += n
        out: list[tuple] = [("record", None, None, None, None, None, len(self.codes))]
        out += [("name", *name, None, None, n) for name, n in self.names.items()]
        out += [("header", *form, None, None, None, n) for form, n in self.headers.items()]
        out += [("word", None, word, None, None, None, n) for word, n in self._words().items()]
        return out + [(kind, None, None, None, *row, n) for kind, of in (("number", numbers), ("join", self._join_rows())) for row, n in of.items()]


def _count_batches(known: set[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(frozenset(known))
        names = ("kind", "lccn", "item", "last", "row", "label", "n", "page_id", "page")
        kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.list_(pa.float64()), pa.float64(), pa.int64(), pa.int64(), pa.binary())
        for batch in batches:
            counts = LineCounts(known, tokens)
            ids, titles, texts = (batch.column(i).to_pylist() for i in range(3))
            for title, text in zip(titles, texts):
                counts.add(title, text)
            rows, none = counts.rows(), [None] * len(ids)
            pages = [["page"] * len(ids), titles, none, none, none, none, none, ids, [pickle.dumps(p, 5) for p in counts.pages()]]
            columns = [*zip(*rows), *[[None] * len(rows)] * 2]
            yield pa.RecordBatch.from_arrays([pa.array([*c, *p], kind) for c, p, kind in zip(columns, pages, kinds)], names=names)

    return run


def counted(pages: DataFrame, words: dict[str, bool]) -> tuple[DataFrame, DataFrame]:
    """``COUNTED`` of all texts, and (page_id, lccn, page) of each, from one scan."""
    texts = pages.filter(F.col("text").isNotNull()).select("page_id", "lccn", "text")
    found = cut(texts.mapInArrow(_count_batches(set(words)), f"{COUNTED}, page_id bigint, page binary"))
    counts = found.filter("kind != 'page'").groupBy("kind", "lccn", "item", "last", "row", "label").agg(F.sum("n").alias("n"))
    return cut(counts), found.filter("kind = 'page'").select("page_id", "lccn", "page")


def running_names(counts: DataFrame) -> DataFrame:
    """(lccn, name, last, n): the core that most records of a title repeat, and on how many."""
    seen = counts.filter("kind = 'name'").select("lccn", F.col("item").alias("core"), "last", "n")
    cores = seen.groupBy("lccn", "core").agg(F.sum("n").alias("n"), F.max_by("last", F.length("last")).alias("last"))
    best = F.max_by(F.struct("core", "last", "n"), F.struct("n", "core"))
    return (
        cores.groupBy("lccn")
        .agg(best.alias("b"))
        .select("lccn", F.col("b.core").alias("name"), F.col("b.last").alias("last"), F.col("b.n").alias("n"))
    )


def header_rows(form: str, n: int, name: str, types: tuple[str, ...], seed: int = 3) -> list[tuple[list[float], float, float]]:
    """(row, label, weight) of ``n`` header lines of one form and of copies with characters misread on purpose."""
    rows = _header_features(form, (name, None), types)
    if rows[0][0] != 1.0:
        return [(r, 0.0, float(n)) for r in rows] if rows[0][0] < 0.6 else []
    rng = random.Random(f"{seed} {form}")
    misread = lambda s: "".join(corrupt(c.lower(), rng).upper() if c.isalpha() and rng.random() < 0.08 else c for c in s)
    copies = min(2 * n, MOST_COPIES)
    forms = [(form, float(n)), *((misread(form), 2 * n / copies) for _ in range(copies))]
    return [(row, 1.0, weight) for f, weight in forms for row in _header_features(f, (name, None), types)]


def _row_batch(rows: list[tuple[str, list[float], float, float]]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.list_(pa.float64()), pa.float64(), pa.float64())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=["model", "row", "label", "n"])


def _header_batches(types: tuple[str, ...]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms, counts, names = (batch.column(i).to_pylist() for i in range(3))
            seen: Counter = Counter()
            for form, n, name in zip(forms, counts, names):
                for row, label, weight in header_rows(form, n, name, types):
                    seen[tuple(row), label] += weight
            yield _row_batch([("header", row, label, weight) for (row, label), weight in seen.items()])

    return run


def fit_counted(rows: DataFrame, widths: dict[str, int], most_rows: int = MOST_ROWS) -> dict[str, Boosted]:
    """The models, by name and number of features, of all ``ROWS``. Only the different values of each feature and the
    different rows of bins, with their counts, come to the driver."""
    rows = cut(rows.groupBy("model", "row", "label").agg(F.sum("n").alias("n")))
    values = rows.select("model", "n", F.posexplode("row").alias("place", "value")).groupBy("model", "place", "value").agg(F.sum("n").alias("n"))
    held: dict[tuple[str, int], list[tuple[float, float]]] = {}
    for r in values.collect():
        held.setdefault((r.model, r.place), []).append((r.value, r.n))
    out = {}
    for model, width in widths.items():
        columns = [np.array(sorted(held.get((model, j), [])), np.float64).reshape(-1, 2) for j in range(width)]
        bins = BINS
        while True:
            cuts = [cuts_of(c[:, 0], c[:, 1], bins) for c in columns]
            below = lambda j: F.size(F.filter(F.lit(cuts[j].tolist()).cast("array<double>"), lambda c: c < F.col("row")[j]))  # noqa: B023, E731
            binned = (
                rows.filter(F.col("model") == model).select(F.array(*[below(j) for j in range(width)]).alias("bins"), "label", "n")
                .groupBy("bins").agg(F.sum(F.col("label") * F.col("n")).alias("right"), F.sum("n").alias("n")).limit(most_rows + 1)
            )
            found = sorted(zip(*(c.to_pylist() for c in binned.toArrow().columns)))
            if len(found) <= most_rows or bins <= 2:
                break
            bins //= 2
        x, right, weight = (np.array([f[i] for f in found], kind) for i, kind in enumerate((np.int64, np.float64, np.float64)))
        out[model] = Boosted.of_counts(cuts, x.reshape(-1, width), right, weight)
    return out


def _word_table(lexicon: DataFrame) -> dict[str, bool]:
    rows = lexicon.dropna().select(F.lower("word").alias("word"), "is_common").limit(MOST_WORDS + 1).collect()
    if len(rows) > MOST_WORDS:
        raise ValueError(f"more than {MOST_WORDS} words")
    out: dict[str, bool] = {}
    for r in rows:
        out[r.word] = out.get(r.word, False) or r.is_common
    return out


def line_models(pages: DataFrame, lexicon: DataFrame) -> tuple[Lines, DataFrame]:
    """Models fitted on the lines of all records, and the titles' names (lccn, name)."""
    models, names, _ = _read(pages, lexicon)
    return models, names


def _read(pages: DataFrame, lexicon: DataFrame) -> tuple[Lines, DataFrame, DataFrame]:
    """The same, and the ``Page``s of the records."""
    words = _word_table(lexicon)
    counts, read = counted(pages, words)
    names = cut(running_names(counts))
    kinds = names.filter("n >= 3 and length(last) >= 4").groupBy("last").agg(F.count("*").alias("titles"))
    least = max(TYPE_TITLES, TYPE_PART * names.count())
    types = tuple(r.last for r in kinds.filter(F.col("titles") >= least).orderBy(F.desc("titles"), "last").collect())
    sure = names.filter(F.col("n") >= 2).select("lccn", "name")
    forms = _with_name(counts.filter("kind = 'header'"), sure).filter("name is not null").select("item", "n", "name")
    parts = forms.sparkSession.sparkContext.defaultParallelism
    headers = forms.repartition(parts, "item").mapInArrow(_header_batches(types), ROWS)
    others = counts.filter("kind in ('number', 'join')").select(F.col("kind").alias("model"), "row", "label", F.col("n").cast("double"))
    fitted = fit_counted(headers.unionByName(others), {"header": 7, "number": 10, "join": 11})
    models = Lines(words, types, fitted["header"], fitted["number"], fitted["join"])
    on = {r.item: r.n for r in counts.filter("kind in ('word', 'record')").select("item", "n").collect()}
    models.shares = {w: (on.get(w, 0) + MORE_RECORDS) / on.get(None, 1) for w in words}
    return models, sure, read


def _with_name(rows: DataFrame, names: DataFrame) -> DataFrame:
    """Texts stay where they are while the names are few enough to send."""
    letters = names.agg(F.sum(F.length("name") + F.length("lccn"))).first()[0] or 0
    return rows.join(F.broadcast(names) if letters <= MOST_LETTERS else names, "lccn", "left")


def _item_batches(models: Lines, read: bool) -> Callable:
    """Items of (page_id, page, name), or of (page_id, text, name) where the texts are not ``read`` yet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models.ready()
        for batch in batches:
            ids, pages, names = (batch.column(i).to_pylist() for i in range(3))
            if read:
                models.tokens.bound()
                pages = map(pickle.loads, pages)
            else:
                counts = LineCounts(models.known, models.tokens)
                for text in pages:
                    counts.add(None, text)
                pages = counts.pages()
            rows = []
            for page_id, page, name in zip(ids, pages, names):
                found, known = models.items(page, name)
                rows += [(page_id, kind, item, known) for kind, item in found]
            columns = zip(*rows) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, (pa.int64(), pa.string(), pa.string(), pa.float32()))],
                names=["page_id", "kind", "item", "known"],
            )

    return run


@lru_cache(maxsize=1)
def _retrieval_of(words: tuple[str, ...]) -> Retrieval:
    """One for all tasks of a Python worker."""
    return Retrieval(list(words))


def _candidate_batches(words: list[str]) -> Callable:
    """The tokens' candidates (``c``) by number; tokens without any are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _retrieval_of(tuple(words))
        for batch in batches:
            near = [find.near(t)[0].tolist() for t in batch.column(1).to_pylist()]
            found = pa.RecordBatch.from_arrays([*batch.columns, pa.array(near, pa.list_(pa.int32()))], names=["made", "token", "rare", "own", "c"])
            yield found.filter(pa.array([bool(c) for c in near], pa.bool_()))

    return run


def _rank_udf(model: Boosted, words: list[str], common: set[str], shares: dict[str, float]) -> Callable:
    @F.pandas_udf("word string, probability double")
    def run(tokens: pd.Series, candidates: pd.Series, own: pd.Series) -> pd.DataFrame:
        candidates = [[words[i] for i in c] for c in candidates]
        rows = [
            features(t, c, common, None if pd.isna(o) else [o / shares[w] for w in c])
            for t, c, o in zip(tokens, candidates, own)
        ]
        best, sure, at = [], [], 0
        score = model.probability(np.concatenate(rows)) if rows else np.empty(0)
        for row, c in zip(rows, candidates):
            mine = score[at : at + len(row)]
            at += len(row)
            best.append(c[int(mine.argmax())])
            sure.append(float(mine.max()))
        return pd.DataFrame({"word": pd.Series(best, dtype=object), "probability": pd.Series(sure, dtype="float64")})

    return run


def _made_batches(words: dict[str, bool]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(w, *made) for w in batch.column(0).to_pylist() for made in made_tokens(w, words)]
            kinds = (pa.string(), pa.string(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=["made", "token", "rare", "own"])

    return run


def _ranking_batches(words: list[str], common: set[str], shares: dict[str, float]) -> Callable:
    """Rows that the ranking is fitted on: of made tokens, and of those that may be names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for made, token, rare, own, numbers in zip(*(c.to_pylist() for c in batch.columns)):
                candidates = [words[i] for i in numbers]
                if made is None:
                    x, y = name_rows(token, [own / shares[c] for c in candidates], candidates, common)
                else:
                    x, y = made_rows(made, token, rare, own, candidates, common)
                if x:
                    seen.update(zip(map(tuple, np.concatenate(x).tolist()), y))
            yield _row_batch([("ranking", row, label, float(n)) for (row, label), n in seen.items()])

    return run


def meant_words(odd: DataFrame, lexicon: DataFrame, shares: dict[str, float], records: int) -> DataFrame:
    """(token, word, probability) of the tokens that are likelier than not a misread word. ``odd`` is (page_id, item),
    ``shares`` the words' shares of the ``records``.

    A name is as frequent as the words it is like, a misreading much rarer than the word. So the ranking is given how
    often a token of letters that never stands in lower case is found (``own``, share of the records, in any case of
    its letters) beside how often each candidate is. It is fitted on all words of the lexicon and all such tokens. The
    lexicon's 3-grams are sent to the tokens, which stay where they are until they are ranked.
    """
    words = _word_table(lexicon)
    spelled, common = sorted(words), {w for w, c in words.items() if c}
    tokens = odd.groupBy(F.col("item").alias("token")).agg(F.count("*").alias("n"))
    small = F.lower("token") == F.col("token")
    cased = tokens.groupBy(F.lower("token").alias("low")).agg(F.bool_or(small).alias("small"), F.sum("n").alias("all"))
    own = F.when(~F.col("small") & F.col("token").rlike(r"^\p{L}+$"), F.col("all") / F.lit(max(1, records)))
    spark = odd.sparkSession
    made = spark.createDataFrame([(w,) for w in spelled], "spelled string").mapInArrow(_made_batches(words), "made string, token string, rare double, own double")
    tokens = tokens.withColumn("low", F.lower("token")).join(cased, "low").select("token", own.cast("double").alias("own"))
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    tokens = tokens.unionByName(made, allowMissingColumns=True).select("made", "token", "rare", "own").repartition(parts, "token")
    looked = cut(tokens.mapInArrow(_candidate_batches(spelled), "made string, token string, rare double, own double, c array<int>"))
    fitting = looked.filter("made is not null or own is not null").mapInArrow(_ranking_batches(spelled, common, shares), ROWS)
    model = fit_counted(fitting, {"ranking": 11})["ranking"]
    rank = _rank_udf(model, spelled, common, shares)
    ranked = looked.filter("made is null").select("token", rank("token", "c", "own").alias("r"))
    return ranked.select("token", "r.word", "r.probability").filter(F.col("probability") > LEAST_PROBABILITY)


def _sure(probability: Column, known: Column) -> Column:
    """Whether a word is taken for misread in a record of which the share ``known`` of the words is known."""
    return probability > 1 - F.least(F.lit(LEAST_PROBABILITY), known / FULL_KNOWN)


def _found(pages: DataFrame, lexicon: DataFrame) -> tuple[DataFrame, DataFrame, Lines, DataFrame]:
    models, names, read = _read(pages, lexicon)
    items = cut(
        _with_name(read, names).select("page_id", "page", "name")
        .mapInArrow(_item_batches(models, read=True), "page_id bigint, kind string, item string, known float").distinct()
    )
    records = read.select("page_id").distinct().count()
    meant = cut(meant_words(items.filter("kind = 'odd'").select("page_id", "item"), lexicon, models.shares, records))
    return items, meant, models, names


def page_items(pages: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(page_id, kind, item), each once: hyphenation, misread, header and page_number.

    Null and blank texts have none; rows without a page_id take no part; repeated rows count once.
    """
    items, meant, _, _ = _found(pages, lexicon)
    items = items.filter(F.col("page_id").isNotNull())
    plain = items.filter(F.col("kind").isin("header", "page_number")).select("page_id", "kind", "item")
    met = (F.col("item") == F.col("token")) & _sure(F.col("probability"), F.col("known"))
    words = items.filter(F.col("kind").isin("divided", "odd")).join(meant, met, "left")
    divided = words.filter("kind = 'divided'").select(
        "page_id", F.lit("hyphenation").alias("kind"), F.lower(F.coalesce("word", "item")).alias("item")
    )
    odd = words.filter("kind = 'odd' and word is not null").select(
        "page_id", F.lit("misread").alias("kind"), F.col("word").alias("item")
    )
    return plain.unionByName(divided.unionByName(odd)).distinct()


def _fixer(models: Lines, meant: dict[str, tuple[str, float]] | None) -> Callable:
    """Repairs texts with the words ``meant``, or, where it is None, with those that come beside each text."""

    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        models.ready()
        plain: set[str] = set()
        for texts, titles, *maps in batches:
            each = maps[0] if maps else [None] * len(texts)
            told = [meant if m is None else {k: (v["word"], v["probability"]) for k, v in dict(m).items()} for m in each]
            yield pd.Series(
                [None if t is None else models.repaired(t, n, m or {}, plain if m is meant else None) for t, n, m in zip(texts, titles, told)],
                dtype=object,
            )

    return run


def repair(pages: DataFrame, lexicon: DataFrame, most_fixes: int = MOST_FIXES) -> DataFrame:
    """(page_id, lccn, text, repaired) of every row: paragraphs between empty lines. Null stays null.

    The misread words travel with the tasks while they are at most ``most_fixes``; more are joined to their texts, with
    the same result.
    """
    _, meant, models, names = _found(pages, lexicon)
    rows = _with_name(pages.select("page_id", "lccn", "text"), names)
    if meant.count() <= most_fixes:
        told = {r.token: (r.word, r.probability) for r in meant.collect()}
        fixed = F.pandas_udf(_fixer(models, told), "string")("text", "name")
        return rows.select("page_id", "lccn", "text", fixed.alias("repaired"))
    # texts go by a hash; where two share one, each is given the other's words too, which it does not hold
    key = F.coalesce(F.when(F.col("text").isNotNull(), F.xxhash64("text")), F.xxhash64("page_id", "lccn"))
    texts = rows.filter("text is not null").select(key.alias("page_id"), "text", "name")
    odd = texts.mapInArrow(_item_batches(models, read=False), "page_id bigint, kind string, item string, known float").filter("kind = 'odd'")
    fixes = (
        odd.select("page_id", "item").distinct()
        .join(meant, F.col("item") == F.col("token")).groupBy(F.col("page_id").alias("key"))
        .agg(F.map_from_entries(F.collect_list(F.struct("token", F.struct("word", "probability")))).alias("meant"))
    )
    fixed = F.pandas_udf(_fixer(models, None), "string")("text", "name", "meant")
    return rows.withColumn("key", key).join(fixes, "key", "left").select("page_id", "lccn", "text", fixed.alias("repaired"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_items(table(spark, sf_dir, "newspapers"), table(spark, sf_dir, "lexicon"))


def p2_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(table(spark, sf_dir, "newspapers"), table(spark, sf_dir, "lexicon"))


QUERIES = {"p2_found": p2_found, "p2_repaired": p2_repaired}
ORACLES: dict[str, str] = {}
