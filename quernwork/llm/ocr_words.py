"""Misread words: folding, plausibility, alignment with a word of the lexicon, and the ranking model."""

from __future__ import annotations

import math
import random
import re

import numpy as np

from .boost import Boosted

#: Right characters and what they are misread as (fixed values).
CONFUSIONS = {
    "a": "äàáâoe", "b": "hl6", "c": "eoç", "d": "cl,t", "e": "céèêëo", "f": "sſt", "g": "9q", "h": "b,li,ii",
    "i": "l1!|íìtj;:", "j": "i", "k": "lc,lt", "l": "1i!|tI", "m": "rn,in,nn,iii", "n": "u,ri,ii,m,ñ",
    "o": "0ceóòöu", "p": "n", "q": "g9", "r": "i", "s": "f5S$ſ", "t": "lfir", "u": "n,ii,ü,ù,li,v,a,o", "v": "yu",
    "w": "vv,uu", "x": "z", "y": "v,g", "z": "2s",
}
#: Right characters that are misread as one (fixed values).
CLOSED = {("rn", "m"), ("vv", "w"), ("cl", "d"), ("li", "h"), ("ri", "n")}
#: Stray marks inside words (fixed values).
SPECKS = "|~^*•_`·■°¦"
_PAIRS = {
    (right, wrong)
    for right, all_ in CONFUSIONS.items()
    for wrong in (all_.split(",") if "," in all_ else list(all_))
}
_WRONGS = {right: sorted(w for r, w in _PAIRS if r == right) for right, _ in _PAIRS}
#: Single characters that are taken for one another fall together when words are looked up.
_CLASSES = ("ecéèêëç", "lit1!|íìIj;", "sf5ſ$S", "nuüùñ", "hb6", "o0óòö", "aäàáâ", "g9q", "vy", "z2")
_FOLD = str.maketrans({c: group[0] for group in _CLASSES for c in group} | {c: None for c in SPECKS if c != "|"})
_NO_SPECKS = dict.fromkeys(map(ord, SPECKS))
_MANY = (("vv", "w"), ("rn", "m"), ("cl", "d"), ("li", "h"), ("ri", "n"), ("iii", "m"))
MOST_EDITS = 3
#: Candidates are ranked if they share 3-grams to at least this part of what the best of them shares, however many.
NEAR_BEST = 0.6
#: Cost of a misreading that is not among the known ones.
GENERIC = 3.0
#: Part of a word's records that its single misreadings take, and from which a token is a word or name of its own; for
#: fitting. A token that cannot be a name counts as ``RARE``.
RARE, MISREAD_PART, OWN_PART = 1e-3, 0.07, 0.1
#: Alignments stay this near to the diagonal, and are given up beyond this cost.
BAND, TOO_DEAR = 3, 7.0


def folds(word: str) -> tuple[str, str]:
    """Two folded forms: single characters by class, and the same after pairs that look like one character."""
    pairs = word
    for wrong, right in _MANY:
        pairs = pairs.replace(wrong, right)
    return word.translate(_FOLD), pairs.translate(_FOLD)


def _without_one(text: str) -> set[str]:
    return {text, *(text[:i] + text[i + 1 :] for i in range(len(text)))} if len(text) > 3 else {text}


class Plausible:
    """Whether a token's folded forms come within one character of a word's, so that looking further is worthwhile."""

    def __init__(self, words: list[str]) -> None:
        self.near = {x for w in words for f in folds(w) for x in _without_one(f)}
        self.kept: dict[str, bool] = {}

    def __call__(self, token: str) -> bool:
        if (found := self.kept.get(token)) is None:
            if len(self.kept) > 1 << 18:
                self.kept.clear()
            low = token.lower()
            plain = low.translate(_NO_SPECKS)
            forms = {*folds(low), *folds(plain)} if plain != low else {*folds(low)}
            found = self.kept[token] = not self.near.isdisjoint(forms) or any(not self.near.isdisjoint(_without_one(f)) for f in forms)
        return found


def alignment(token: str, word: str) -> tuple[float, int, int]:
    """(cost, edits, generic edits) of the cheapest way to misread ``word`` as ``token``."""
    a, b = token.lower(), word
    n, m = len(a), len(b)
    head = 0
    while head < min(n, m) and a[head] == b[head]:
        head += 1
    # one character is kept on each side, as pairs may begin within the equal part
    head = max(0, head - 1)
    tail = 0
    while tail < min(n, m) - head and a[n - 1 - tail] == b[m - 1 - tail]:
        tail += 1
    tail = max(0, tail - 1)
    a, b = a[head : n - tail], b[head : m - tail]
    n, m = len(a), len(b)
    if abs(n - m) > MOST_EDITS:
        return 99.0, 99, 99
    best: dict[tuple[int, int], tuple[float, int, int]] = {(0, 0): (0.0, 0, 0)}
    for i in range(n + 1):
        for j in range(max(0, i - BAND), min(m, i + BAND) + 1):
            found = best.get((i, j))
            if found is None or found[0] > TOO_DEAR:
                continue
            cost, edits, generic = found
            steps = []
            if i < n and j < m:
                if a[i] == b[j]:
                    steps.append((1, 1, 0.0, 0, 0))
                else:
                    known = (b[j], a[i]) in _PAIRS
                    steps.append((1, 1, 1.0 if known else GENERIC, 1, int(not known)))
            if i < n:
                speck = a[i] in SPECKS
                steps.append((1, 0, 0.9 if speck else GENERIC, 1, int(not speck)))
            if j < m:
                steps.append((0, 1, GENERIC, 1, 1))
                if i < n and (b[j : j + 2], a[i]) in CLOSED:
                    steps.append((1, 2, 1.0, 1, 0))
                for k in (2, 3):
                    if (b[j], a[i : i + k]) in _PAIRS and len(a[i : i + k]) == k:
                        steps.append((k, 1, 1.0, 1, 0))
            for di, dj, c, e, g in steps:
                to, value = (i + di, j + dj), (cost + c, edits + e, generic + g)
                if to not in best or value < best[to]:
                    best[to] = value
    return best.get((n, m), (99.0, 99, 99))


def features(token: str, words: list[str], common: set[str], parts: list[float] | None = None) -> np.ndarray:
    """One row per candidate: cost, edits, generic edits, length, cost per character, common, sign or digit inside,
    capital, how much dearer than the cheapest other candidate, number as cheap, and likeness to a name: how often the
    token is found for each time that the candidate is (``parts``; none for what cannot be a name), in steps."""
    found = [alignment(token, w) for w in words]
    costs = [c for c, _, _ in found]
    odd = any(not c.isalpha() for c in token)
    rows = []
    for i, (word, (cost, edits, generic)) in enumerate(zip(words, found)):
        others = costs[:i] + costs[i + 1 :]
        rows.append((
            cost, edits, generic, len(word), cost / len(word), word in common, odd, token[:1].isupper(),
            cost - min(others, default=9.0), sum(c <= cost for c in others),
            round(math.log(min(1.0, max(RARE, parts[i] if parts else RARE))), 2),
        ))
    return np.array(rows, np.float64)


class Retrieval:
    """Words that share 3-grams of folded forms with a token, and enough of them beside the best."""

    def __init__(self, words: list[str]) -> None:
        self.words = words
        self.sizes = np.array([len(w) for w in words], np.int64)
        index: dict[str, list[int]] = {}
        for i, w in enumerate(words):
            for g in grams(w):
                index.setdefault(g, []).append(i)
        self.index = {g: np.array(ids, np.int64) for g, ids in index.items()}

    def near(self, token: str) -> tuple[np.ndarray, np.ndarray]:
        """The words' numbers, ascending, and the shares of 3-grams."""
        ids = [found for g in grams(token) if (found := self.index.get(g)) is not None]
        met, shared = np.unique(np.concatenate(ids or [np.empty(0, np.int64)]), return_counts=True)
        size = self.sizes[met]
        share = np.where(abs(size - len(token)) <= MOST_EDITS - 1, shared / (size + len(token)), 0.0)
        enough = (share > 0) & (share >= NEAR_BEST * share.max(initial=0.0))
        return met[enough], share[enough]

    def __call__(self, token: str) -> list[str]:
        numbers, shares = self.near(token)
        return [w for _, w in sorted((-s, self.words[i]) for i, s in zip(numbers.tolist(), shares.tolist()))]


def grams(word: str) -> set[str]:
    """Character 3-grams of the folded forms, with the ends marked."""
    low = word.lower()
    forms = {*folds(low), *folds(low.translate(dict.fromkeys(map(ord, SPECKS))))}
    return {p[i : i + 3] for f in forms for p in [f"^^{f}$$"] for i in range(len(p) - 2)}


def corrupt(word: str, rng: random.Random) -> str:
    """The word with one or two characters misread, or a stray mark inside."""
    out = word
    for _ in range(1 if rng.random() < 0.8 else 2):
        at = rng.randrange(len(out))
        wrongs = _WRONGS.get(out[at])
        closed = sorted((right, wrong) for right, wrong in CLOSED if right in out)
        if closed and rng.random() < 0.1:
            out = out.replace(*rng.choice(closed), 1)
        elif rng.random() < 0.1 and len(out) > 3:
            at = max(1, at)
            out = out[:at] + rng.choice(SPECKS) + out[at:]
        elif wrongs:
            out = out[:at] + rng.choice(wrongs) + out[at + 1 :]
    return out


def made_tokens(word: str, words: dict[str, bool], per_word: int = 2, seed: int = 5) -> list[tuple[str, float | None, float | None]]:
    """(token, rare, own) that the ranking is fitted on: the word itself, and the word misread on purpose; in capitals with
    the parts (see ``features``) that it is a misreading and a name of its own at."""
    if len(word) < 2:
        return []
    rng = random.Random(f"{seed} {word}")
    out: list[tuple[str, float | None, float | None]] = [(word, None, None)]
    for _ in range(per_word):
        token = corrupt(word, rng)
        if token in words:
            continue
        if rng.random() < 0.3:
            rare = math.exp(rng.uniform(math.log(RARE), math.log(MISREAD_PART)))
            out.append((token.capitalize(), rare, math.exp(rng.uniform(math.log(OWN_PART), 0.0))))
        else:
            out.append((token, None, None))
    return out


def made_rows(
    word: str, token: str, rare: float | None, own: float | None, candidates: list[str], common: set[str]
) -> tuple[list[np.ndarray], list[float]]:
    """Features and labels of a made token's candidates."""
    if token == word:
        # a word of which the lexicon might not know: none of the others that are like it is meant
        others = [c for c in candidates if c != word]
        return ([features(token, others, common)], [0.0] * len(others)) if others else ([], [])
    if word not in candidates:
        return [], []
    right = [float(c == word) for c in candidates]
    if rare is None or own is None:
        return [features(token, candidates, common)], right
    # the same token is a misreading where it is rare beside the word, and a name where it is not
    x = [features(token, candidates, common, [part] * len(candidates)) for part in (rare, own)]
    return x, right + [0.0] * len(candidates)


def name_rows(name: str, parts: list[float], candidates: list[str], common: set[str]) -> tuple[list[np.ndarray], list[float]]:
    """Features and labels of the candidates of a name of the corpus, of which none is meant. A name that is much rarer
    than a word which may have been misread so is left out, as it may be that word."""
    row = features(name, candidates, common, parts)
    if all(part >= OWN_PART or generic for part, generic in zip(parts, row[:, 2])):
        return [row], [0.0] * len(candidates)
    return [], []


def fit_ranking(words: dict[str, bool], names: list[tuple[str, float]], per_word: int = 2, seed: int = 5, shares: dict[str, float] | None = None) -> Boosted:
    """The ranking model, in one process: words of the lexicon misread on purpose against their other candidates, and
    names of the corpus (token, share of the records) against all of theirs; ``shares`` are those of the words."""
    common = {w for w, c in words.items() if c}
    find = Retrieval(sorted(words))
    x: list[np.ndarray] = []
    y: list[float] = []
    for word in sorted(words):
        for token, rare, own in made_tokens(word, words, per_word, seed):
            rows, labels = made_rows(word, token, rare, own, find(token), common)
            x += rows
            y += labels
    for name, own in names:
        if candidates := find(name):
            rows, labels = name_rows(name, [own / shares[c] for c in candidates] if shares else [1.0] * len(candidates), candidates, common)
            x += rows
            y += labels
    return Boosted(np.concatenate(x), np.array(y)) if x else Boosted(np.zeros((0, 11)), np.zeros(0))


TOKEN = re.compile(r"[^\s“”\"()\[\]{}<>;:?—–«»„]+")


def bare(token: str) -> str:
    """The token without punctuation around it."""
    return token.strip("'’‘.,-‐­¬=").rstrip("!").lstrip("¡")
