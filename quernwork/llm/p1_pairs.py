"""Problem 1: defective prompt and response pairs, each with the one defect it has."""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, language_code, table
from .p6_overlap import lcs_length

#: A language is a class if so many documents and so large a part of them are in it, which bounds their number.
LEAST_DOCUMENTS, LEAST_PART = 3, 2e-3
BUCKETS = 1 << 16
#: Characters that are counted at once.
PART_CHARS = 1 << 20
#: Words and word pairs of answers are counted by a hash, so that the model of refusals has a bound at any size.
WORD_BUCKETS = 1 << 21
#: Log odds that the answer's language must have over the prompt's, in all and per n-gram, and the prompt's over the
#: answer's likewise.
MARGIN, MARGIN_EACH = 8.0, 0.15
#: Length of the text ends whose likelihood is compared.
END_GRAM = 4

ASKING, ANSWERING = ("user", "human"), ("assistant", "bot", "model", "gpt", "ai")

#: Log odds from which a sentence declines.
DECLINED = 4.0

#: Words that stand in the place of an answer (fixed values).
PLACEHOLDERS = {
    "n a", "na", "null", "none", "nil", "nan", "no answer", "no response", "no reply", "blank", "empty", "undefined",
    "missing", "tbd", "todo", "pending", "see above", "to follow", "not available", "not applicable", "left blank", "answer", "response", "placeholder",
}

#: What a sentence that declines says, in five languages: labels for fitting only (fixed values).
DECLINES = re.compile(
    r"\b(?:(?:can not|cannot|can't|unable to|not (?:feel )?able to) "
    r"(?:help|assist|answer|respond|provide|offer|discuss|speak|write|treat|give|comment|say|tell)"
    r"|(?:decline|refuse) to (?:answer|speak|discuss|respond|comment|say|write|help)"
    r"|won't (?:discuss|be drawn|answer|speak)|shall not (?:answer|speak|discuss)|(?:not|n't) (?:feel )?at liberty"
    r"|keep silent|say nothing|rather not|make it a rule to pass over|leave unanswered"
    r"|(?:improper|not be proper|not proper) for me|no reply can be expected|not in my power"
    r"|outside what i am (?:allowed|permitted)|against what i am (?:allowed|permitted)|may not enter upon"
    r"|put that to another|offer no reply|no opinion to give"
    r"|ne rien dire|impossible de vous (?:aider|répondre)|ne (?:puis|peux) (?:pas )?(?:vous )?(?:répondre|aider)"
    r"|kann ich nicht (?:helfen|beantworten)|nichts sagen|nicht beantworten|nicht helfen"
    r"|no puedo (?:ayudar|responder|hablar)|no responder|no poder (?:hablar|ayudar|responder)"
    r"|non posso (?:aiutar|rispondere|parlare)|non rispondere)"
)
#: Sentences of mere courtesy, likewise (fixed values).
COURTESY = re.compile(
    r"^(?:kindly|please) (?:ask|put|try)|^is there (?:any|some)thing else|^is there any other|^i trust that you"
    r"|^(?:i )?thank(?:s| you)\b|^my apologies\.?$|^i am sorry\.?$|^i hope (?:that )?you|^merci|^danke|^gracias|^grazie"
    r"|^(?:pardon|forgive|excuse) me[^.]{0,12}\.?$|^désolé\.?$|^leider\.?$|^lo siento\.?$|^mi dispiace\.?$"
)
#: Names of the languages in each of them (fixed values).
LANGUAGE_NAMES = {
    "en": ("english", "anglais", "englisch", "englische", "inglés", "inglese"),
    "fr": ("french", "français", "französisch", "französische", "francés", "francese"),
    "de": ("german", "allemand", "deutsch", "deutsche", "alemán", "tedesco"),
    "es": ("spanish", "espagnol", "spanisch", "spanische", "español", "castellano", "spagnolo"),
    "it": ("italian", "italien", "italienisch", "italienische", "italiano"),
}
#: Abbreviations that only stand before a name (fixed values).
TITLES = {
    "mr", "mrs", "dr", "rev", "st", "prof", "capt", "col", "gen", "hon", "messrs", "lieut", "mme", "mlle", "hr", "fr",
    "sr", "sra", "sig", "no", "vol",
}
LABELS = {"question", "you", "ask", "asked", "q", "prompt", "user", "frage", "pregunta", "domanda", "demande", "answer"}

_WORD = re.compile(r"[^\W_]+")
_ITEM = re.compile(r"[ \t]*(?:[-*•–]|\d{1,3}[.)])[ \t]+\S")
_BARE = re.compile(r"[ \t]*(?:[-*•–]|\d{1,3}[.)])$")
_QUOTED = re.compile(r"“[^”]*”|«[^»]*»|„[^“]*“|\"[^\"]*\"")
_LOWER = re.compile(r"(?<![\w’'])[^\W\d_A-ZÀ-ÖØ-Þ][^\W\d_]*")
_TAG = re.compile(r"</?[a-z][^<>]*>|&nbsp;")
_SENTENCE = re.compile(r"(?<=[.!?])\s+")
_SET_OFF = re.compile(r"\[[^\]]*\]|\([^)]*\)|\{[^}]*\}|<[^>]*>|(-{2,}|—|\*{2,}|_{2,}).*\1", re.S)
_INVISIBLE = re.compile(r"[\s​-‏⁠﻿­]+")


def _grams(text: str) -> np.ndarray:
    """Hashed character 1- to 3-grams of a text whose words stand between blanks."""
    c = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    if len(c) < 3:
        return np.empty(0, np.int64)
    mix = np.uint64(0x9E3779B97F4A7C15)
    one = c * mix
    two = (one[:-1] ^ (c[1:] + np.uint64(7))) * mix
    three = (two[:-1] ^ (c[2:] + np.uint64(13))) * mix
    return (np.concatenate([one, two, three]) >> np.uint64(48)).astype(np.int64)


def _prose(text: str) -> str:
    """The words in lower case alone: names, which look alike in any language, say nothing of the language."""
    return " " + " ".join(_LOWER.findall(text)) + " "


def language_counts(samples: list[tuple[str, str]]) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """(language, hashes of n-grams, how often each stands in its texts) of (language, text)."""
    grams: dict[str, list[np.ndarray]] = {}
    for code, text in samples:
        grams.setdefault(code, []).append(_grams(_prose(text)))
    out = []
    for code, found in sorted(grams.items()):
        counts = np.bincount(np.concatenate(found), minlength=BUCKETS)
        hashes = np.flatnonzero(counts)
        out.append((code, hashes, counts[hashes]))
    return out


class LanguageModel:
    """Naive Bayes over character n-grams; ``log`` has a row for each hash and a column for each of ``codes``."""

    def __init__(self, samples: list[tuple[str, str]]) -> None:
        self._fit(sorted({code for code, _ in samples}), language_counts(samples))

    @classmethod
    def counted(cls, codes: list[str], counts: list[tuple[str, np.ndarray, np.ndarray]]) -> LanguageModel:
        """From (language, hashes, how often each stands in its texts)."""
        model = cls.__new__(cls)
        model._fit(sorted(codes), counts)
        return model

    def _fit(self, codes: list[str], found: list[tuple[str, np.ndarray, np.ndarray]]) -> None:
        self.codes = codes
        counts = np.full((BUCKETS, max(1, len(codes))), 0.5)
        for code, hashes, n in found:
            counts[hashes, codes.index(code)] += n
        self.log = np.log(counts / counts.sum(axis=0)).astype(np.float32)

    def odds(self, text: str) -> tuple[np.ndarray, int]:
        """Log likelihood by language and the number of n-grams."""
        grams = _grams(_prose(text))
        return self.log[grams].sum(axis=0, dtype=np.float64), len(grams)


def _sentences(answer: str) -> list[list[str]]:
    """The words of each sentence, figures as one word."""
    plain = re.sub(r"\d+", "9", answer.lower().replace("’", "'"))
    return [w for p in _SENTENCE.split(plain) if (w := re.findall(r"[^\W_]+(?:'[^\W_]+)?", p))]


class RefusalModel:
    """Naive Bayes over the words and word pairs of sentences: answers that decline against all others.

    The labels come from ``declines``; what is decided by is how sentences of either class are worded, so that a
    sentence need not hold any listed phrase. ``weight`` has a row for each hash of a word or pair.
    """

    PRIOR = 0.5

    def __init__(self, answers: list[str]) -> None:
        self._fit(*refusal_counts(answers))

    @classmethod
    def counted(cls, hashes: np.ndarray, others: np.ndarray, declined: np.ndarray) -> RefusalModel:
        """From hashes and how often each stands in answers that do not decline and in those that do."""
        model = cls.__new__(cls)
        model._fit(hashes, others, declined)
        return model

    def _fit(self, hashes: np.ndarray, others: np.ndarray, declined: np.ndarray) -> None:
        logs = [np.log(n + self.PRIOR) - math.log(n.sum() + self.PRIOR * (len(hashes) or 1)) for n in (others, declined)]
        weight = np.zeros(WORD_BUCKETS)
        weight[hashes] = logs[1] - logs[0]
        self.weight = array("f", weight.astype(np.float32).tobytes())

    @staticmethod
    def features(words: list[str]) -> list[int]:
        """Hashes of the words and of the pairs of a sentence."""
        return [zlib.crc32(g.encode()) & (WORD_BUCKETS - 1) for g in [*words, *map(" ".join, zip(words, words[1:]))]]

    def refuses(self, answer: str) -> bool:
        """Some sentence declines, and none tells anything that refusals do not."""
        scores = [sum(self.weight[g] for g in self.features(words)) for words in _sentences(answer)]
        return bool(scores) and max(scores) > DECLINED and min(scores) > 0


def refusal_counts(answers: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of words and pairs, how often each stands in answers that do not decline, and in those that do."""
    found: tuple[list[int], list[int]] = ([], [])
    for answer in answers:
        found[declines(answer)].extend(g for words in _sentences(answer) for g in RefusalModel.features(words))
    counts = [dict(zip(*np.unique(np.array(f, np.int64), return_counts=True))) for f in found]
    hashes = np.array(sorted(counts[0].keys() | counts[1].keys()), np.int64)
    return hashes, *(np.array([c.get(h, 0) for h in hashes], np.int64) for c in counts)


def _shape(text: str) -> str:
    """Letters keep their case only; digits and others stay by kind, as ends of texts differ by these."""
    return re.sub(r"\d", "9", text)


class EndModel:
    """How likely a text ends here: n-grams before the ends of paragraphs, and of answers that end with a sentence,
    of which most are whole, against those before other places.

    Both are weighted alike in all. A longer n-gram counts as far as it was seen; for the rest the shorter one stands
    in (``PRIOR`` sightings' worth of it).
    """

    PRIOR = 1.0

    def __init__(self, texts: list[str], answers: list[str] | None = None) -> None:
        grams: dict[str, tuple[int, int]] = {}
        found = end_counts(texts) + [(tail, n, 0) for tail, n in tail_counts(answers or []).items()]
        for gram, end, inner in found:
            for n in range(1, len(gram) + 1):
                e, i = grams.get(gram[-n:], (0, 0))
                grams[gram[-n:]] = e + end, i + inner
        self._fit(grams, sum(e for _, e, _ in found), sum(i for _, _, i in found))

    @classmethod
    def counted(cls, grams: dict[str, tuple[int, int]], n_ends: int, n_inner: int) -> EndModel:
        """From n-grams of 1 to ``END_GRAM`` with how often each stands before ends and before other places."""
        model = cls.__new__(cls)
        model._fit(grams, n_ends, n_inner)
        return model

    def _fit(self, grams: dict[str, tuple[int, int]], n_ends: int, n_inner: int) -> None:
        self.grams = grams
        self.weight = n_ends / max(1, n_inner)

    def probability(self, text: str) -> float:
        tail, p = _shape(text[-END_GRAM:]), 0.5
        for n in range(1, len(tail) + 1):
            end, inner = self.grams.get(tail[-n:], (0, 0))
            p = (end + self.PRIOR * p) / (end + inner * self.weight + self.PRIOR)
        return p


def end_counts(texts: list[str]) -> list[tuple[str, int, int]]:
    """(n-gram of ``END_GRAM``, how often it stands before ends of paragraphs, and before other places of them)."""
    paragraphs = []
    for text in texts:
        for paragraph in re.split(r"\n\s*\n", text):
            words = re.sub(r"\s+", " ", _shape(paragraph)).strip()
            if len(words) >= 40:
                paragraphs.append(words)
    if not paragraphs:
        return []
    ends = Counter(p[-END_GRAM:] for p in paragraphs)
    points = np.frombuffer("".join(paragraphs).encode("utf-32-le"), np.uint32)
    sizes = np.array([len(p) for p in paragraphs])
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(points))  # of the paragraph, this character included
    # n-grams that end before the last character but one at the latest
    first = np.flatnonzero(left > END_GRAM + 1)
    seen = np.zeros(0x110000, bool)
    seen[points] = True
    alphabet = np.flatnonzero(seen).astype(np.uint32)
    if len(alphabet) > 1 << 16 and len(texts) > 1:
        halves = Counter(), Counter()
        for part in (texts[: len(texts) // 2], texts[len(texts) // 2 :]):
            for gram, end, inner in end_counts(part):
                halves[0][gram] += end
                halves[1][gram] += inner
        return [(g, halves[0][g], halves[1][g]) for g in halves[0]]
    kind = np.uint32 if len(alphabet) <= 1 << 8 else np.uint64
    bits = kind(8 if kind is np.uint32 else 16)
    rank = np.zeros(0x110000, kind)
    rank[alphabet] = np.arange(len(alphabet)) % (1 << int(bits))
    ranks = rank[points]
    packed = np.zeros(len(first), kind)
    for k in range(END_GRAM):
        packed = packed << bits | ranks[first + k]
    packed, counts = np.unique(packed, return_counts=True)
    spelled = np.stack([alphabet[(packed >> bits * kind(END_GRAM - 1 - k)) & kind((1 << int(bits)) - 1)] for k in range(END_GRAM)], axis=1)
    flat = spelled.astype("<u4").tobytes().decode("utf-32-le")
    inner = {flat[i * END_GRAM : (i + 1) * END_GRAM]: int(n) for i, n in enumerate(counts)}
    return [(g, ends[g], inner.get(g, 0)) for g in ends.keys() | inner.keys()]


def is_empty(answer: str | None) -> bool:
    """Nothing is said: null, blank, signs and markup only, or words that stand in an answer's place."""
    plain = _TAG.sub(" ", (answer or "").lower())
    words = _WORD.findall(plain)
    return not words or " ".join(words) in PLACEHOLDERS or len(words) <= 5 and _SET_OFF.fullmatch(plain.strip()) is not None


def declines(answer: str) -> bool:
    """The label of an answer: some sentence declines and every other one is courtesy."""
    plain = answer.lower().replace("’", "'")
    parts = [p.strip() for p in _SENTENCE.split(plain) if _WORD.search(p)]
    found = [bool(DECLINES.search(re.sub(r"[^\w']+", " ", p))) for p in parts]
    return any(found) and all(d or COURTESY.search(p) for d, p in zip(found, parts))


def is_copy(prompt: str | None, answer: str) -> bool:
    """The prompt's words once or several times over, each time all or all but one, in their order, and at most a
    label or one word besides."""
    asked, said = _WORD.findall((prompt or "").lower()), _WORD.findall(answer.lower())
    times = max(1, round(len(said) / len(asked))) if asked else 1
    if len(asked) < 3 or abs(len(said) - times * len(asked)) > 4 * times:
        return False
    same = lcs_length(asked * times, said)
    besides = len(said) - same
    labels = sum(w in LABELS for w in said[:3]) - sum(w in LABELS for w in asked[:3])
    return same >= times * (len(asked) - 1) and besides - max(0, labels) <= times


def _visible(answer: str) -> str:
    return _INVISIBLE.sub(lambda m: "\n" if "\n" in m[0] else " ", answer).strip()


def _end(text: str) -> str:
    """The end whose likelihood tells whether the text breaks off, without quotes and brackets after a sentence."""
    inside = text.rstrip("”\"»’')]")
    return (inside if inside.endswith((".", "!", "?", "…")) else text)[-END_GRAM:]


def tail_counts(answers: list[str]) -> Counter:
    """What answers end with (``END_GRAM`` characters or all they have), and how often as the end of a sentence."""
    tails = Counter(_shape(_end(_visible(a))) for a in answers)
    return Counter({t: n if t.endswith((".", "!", "?", "…")) else 0 for t, n in tails.items()})


def is_truncated(answer: str, ends: EndModel) -> bool:
    """The text breaks off: a list's last mark has no entry, a title has no name, or an end is unlikely here."""
    text = _visible(answer)
    words = text.split()
    lines = [line for line in text.split("\n") if line.strip()]
    if _BARE.fullmatch(lines[-1]) and len(lines) > 1:
        return True
    if all(_ITEM.match(line) for line in lines):
        return text[-1] in ",;:(-–—“"
    if len(words) == 1:
        return text[-1] in ",;:(–—“"
    last = words[-1]
    mark = re.fullmatch(r"(\d{1,2})[.)]", last)
    if mark and int(mark[1]) > 1 and re.search(rf"(?:^|\s){int(mark[1]) - 1}[.)]\s", text):
        return True
    if last.endswith(".") and last[:-1].lower() in TITLES and last[:1].isupper():
        return True
    return ends.probability(_end(text)) < 0.5


def _named(prompt: str) -> set[str]:
    words = set(_WORD.findall(prompt.lower()))
    return {code for code, names in LANGUAGE_NAMES.items() if words & set(names)}


def other_language(prompt: str | None, answer: str, model: LanguageModel) -> bool:
    """Both languages are certain, they differ, and the prompt does not name the answer's."""
    asked = _QUOTED.sub(" ", prompt or "")
    said = _QUOTED.sub(" ", answer)
    if len(_LOWER.findall(said)) < 3:
        said = answer
    (p, n_p), (a, n_a) = model.odds(asked), model.odds(said)
    if not n_p or not n_a:
        return False
    i, j = int(p.argmax()), int(a.argmax())
    if i == j or model.codes[j] in _named(prompt or ""):
        return False
    return p[i] - p[j] > max(MARGIN, MARGIN_EACH * n_p) and a[j] - a[i] > max(MARGIN, MARGIN_EACH * n_a)


def defect_of(prompt: str | None, answer: str | None, model: LanguageModel, ends: EndModel, refusals: RefusalModel) -> str | None:
    if is_empty(answer):
        return "empty"
    if refusals.refuses(answer):
        return "refusal"
    if is_copy(prompt, answer):
        return "copied_question"
    if is_truncated(answer, ends):
        return "truncated"
    return "other_language" if other_language(prompt, answer, model) else None


#: Counts of the models: n-grams of languages and hashes of words by ``hash``, ends by ``gram``.
_COUNTS = "kind string, gram string, hash int, n bigint, other bigint"


def _count_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=["kind", "gram", "hash", "n", "other"]
    )


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch is counted in parts of about ``PART_CHARS``, as arrays of many times the text's size are made."""
    for batch in batches:
        ends: tuple[Counter, Counter] = (Counter(), Counter())
        languages: dict[str, np.ndarray] = {}
        part: list[tuple[str | None, str]] = []
        size, left = 0, batch.num_rows
        for code, text in zip(*(batch.column(i).to_pylist() for i in range(2))):
            part.append((code, text))
            size, left = size + len(text), left - 1
            if left and size < PART_CHARS:
                continue
            for gram, end, inner in end_counts([t for _, t in part]):
                ends[0][gram] += end
                ends[1][gram] += inner
            for c, hashes, n in language_counts([(c, t) for c, t in part if c is not None]):
                languages.setdefault(c, np.zeros(BUCKETS, np.int64))[hashes] += n
            part, size = [], 0
        rows: list[tuple] = [("end", gram, None, end, ends[1][gram]) for gram, end in ends[0].items()]
        for code, counts in languages.items():
            rows += [("language", code, h, int(counts[h]), 0) for h in np.flatnonzero(counts).tolist()]
        yield _count_batch(rows)


def _answer_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        answers = batch.column(0).to_pylist()
        columns = refusal_counts(answers)
        rows: list[tuple] = [("word", None, h, n, k) for h, n, k in zip(*(c.tolist() for c in columns))]
        rows += [("tail", tail, None, n, 0) for tail, n in tail_counts(answers).items() if tail]
        yield _count_batch(rows)


def fitted_models(messages: DataFrame, documents: DataFrame) -> tuple[LanguageModel, EndModel, RefusalModel]:
    """The models from the counts of all documents and all answers. What the driver gets has a bound: hashes by language,
    hashes of words, and of the n-grams those that some answer ends with."""
    rows = documents.filter(F.length("text") > 0).select(language_code(F.col("lang")).alias("code"), "text")
    counts = {r.code: r["count"] for r in rows.filter("code is not null").groupBy("code").count().filter(F.col("count") >= LEAST_DOCUMENTS).collect()}
    named = [c for c, n in counts.items() if n >= LEAST_PART * sum(counts.values())]
    texts = rows.select(F.when(F.col("code").isin(named), F.col("code")).alias("code"), "text").mapInArrow(_document_counts, _COUNTS)
    answers = messages.filter(_side().eqNullSafe("a") & (F.length("content") > 0)).select("content").mapInArrow(_answer_counts, _COUNTS)
    sums = F.sum("n").alias("n"), F.sum("other").alias("other")
    found = cut(texts.unionByName(answers).groupBy("kind", "gram", "hash").agg(*sums))
    languages = found.filter("kind = 'language'").select("gram", "hash", "n").toPandas()
    language = LanguageModel.counted(named, [(c, g["hash"].to_numpy(), g["n"].to_numpy()) for c, g in languages.groupby("gram")])
    words = found.filter("kind = 'word'").select("hash", "n", "other").toPandas()
    refusals = RefusalModel.counted(*(words[c].to_numpy() for c in ("hash", "n", "other")))
    last = F.explode(F.array_distinct(F.array(*[F.substring("gram", -n, n) for n in range(1, END_GRAM + 1)]))).alias("end")
    tails = found.filter("kind = 'tail'").select(last).distinct()
    ends = found.filter("kind in ('end', 'tail')")
    grams = ends.select(last, "n", "other").groupBy("end").agg(*sums).join(tails, "end").collect()
    total = ends.agg(*sums).first()
    return language, EndModel.counted({r.end: (r.n, r.other) for r in grams}, total.n or 0, total.other or 0), refusals


def _defects(model: LanguageModel, ends: EndModel, refusals: RefusalModel) -> Callable:
    @F.pandas_udf("string")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for prompts, answers in batches:
            yield pd.Series([defect_of(p, a, model, ends, refusals) for p, a in zip(prompts, answers)], dtype=object)

    return run


def _side() -> Column:
    """``u`` for the asking side, ``a`` for the answering one, whatever the case, blanks and name of the role."""
    role = F.lower(F.trim("role"))
    return F.when(role.isin(*ASKING), "u").when(role.isin(*ANSWERING), "a")


def message_pairs(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, dataset, prompt, answer), each once: a user message and the assistant message of the next turn.

    Messages logged twice count once; where a side of a turn stands in several versions, the one that was logged
    first counts (of those logged at once, the first in order).
    """
    rows = messages.select("conv_id", "turn", "dataset", "content", "logged_at", _side().alias("side")).filter(
        F.col("side").isNotNull() & F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    )
    first = lambda df: df.groupBy("conv_id", "turn").agg(F.min(F.struct("logged_at", "content", "dataset")).alias("m"))
    asked = first(rows.filter("side = 'u'").withColumn("turn", F.col("turn") + 1)).select("conv_id", "turn", F.col("m.content").alias("prompt"))
    said = first(rows.filter("side = 'a'")).select("conv_id", "turn", F.col("m.dataset").alias("dataset"), F.col("m.content").alias("answer"))
    return asked.join(said, ["conv_id", "turn"])


def judged_pairs(messages: DataFrame, documents: DataFrame) -> DataFrame:
    """(conv_id, turn, dataset, defect): one row per pair, ``defect`` null for a sound one. Empty tables give none."""
    models = fitted_models(messages, documents)
    return message_pairs(messages).select("conv_id", "turn", "dataset", _defects(*models)("prompt", "answer").alias("defect"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judged_pairs(table(spark, sf_dir, "chat_messages"), table(spark, sf_dir, "documents"))
    return judged.filter(F.col("defect").isNotNull()).select("conv_id", "turn", "defect")


def p1_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(dataset, defect, n_pairs): how many pairs of each dataset have each defect; null for sound ones."""
    judged = judged_pairs(table(spark, sf_dir, "chat_messages"), table(spark, sf_dir, "documents"))
    return judged.groupBy("dataset", "defect").agg(F.count("*").alias("n_pairs"))


QUERIES = {"p1_found": p1_found, "p1_report": p1_report}
ORACLES: dict[str, str] = {}
