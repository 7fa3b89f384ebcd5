"""Toxicity by a weighted lexicon, matched with Aho-Corasick.

A text is folded first: look-alike letters of other scripts, full-width forms
and digits or signs written for letters become the letter they stand for,
whatever is no letter becomes one space. In the folded text an entry of the
lexicon is a whole word or the beginning of a word, so both are plain
substrings (`` idiot ``, `` idio``) and one automaton finds all of them, and the
exception phrases, in a single pass. The best entry counts for each word,
unless an exception phrase covers the word. The sum, divided by a power of the
text's length, becomes a probability by a logistic curve.

Entries, weights, exceptions and the curve are learned from a bounded sample
of labelled texts: Spark counts in how many toxic and other texts each word
and beginning of a word occurs, and only the significant ones leave it.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.llm.common import id_text, labelled_sample, map_texts, with_fields, written

#: Letters of other scripts, and below each the Latin letter it looks like.
_ALIKE = str.maketrans("авсеніјкморѕтухԁԛԝһӏ" "αβεηικνορτυχω" "ıſɑɡɩʟɴʀ",
                       "abcehijkmopstyxdqwhl" "abenikvoptuxw" "isagilnr",
                       "\u00ad\u200b\u200c\u200d\u2060\ufeff")       # invisible ones go
_ALIEN = re.compile("[%s]" % "".join(map(chr, _ALIKE))).search
#: Digits and signs written for letters.
_DIGITS = str.maketrans("0134578@$!", "oieastbasi")
_SIGNS = re.compile(r"[0134578@$!]+").sub
_GAP = re.compile(r"[\W\d_]+").sub

SHORTEST, LONGEST = 3, 16


def _letters_for(m: re.Match) -> str:
    """Signs as letters if they stand between letters, or at a word's beginning before a letter; digits also at its end."""
    text, a, b = m.string, m.start(), m.end()
    before, after = text[a - 1:a], text[b:b + 1]
    leads = after.isalpha() and not before.isdigit()
    ends = before.isalpha() and not after.isalnum() and m[0].isdigit()
    return m[0].translate(_DIGITS) if leads or ends else m[0]


def fold(text: str) -> str:
    """The words of a text, letters only, look-alikes folded, each between single spaces (no word: one space)."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    text = text.lower()
    if not text.isascii() and _ALIEN(text):
        text = text.translate(_ALIKE)
    text = _SIGNS(_letters_for, text)
    words = _GAP(" ", text).strip()
    return f" {words} " if words else " "


@dataclass
class Lexicon:
    """Entries with weights, exception phrases, and the curve that turns a
    text's sum into a probability."""
    weights: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    power: float = 0.5
    slope: float = 1.0
    shift: float = 0.0
    _automaton: ahocorasick.Automaton | None = None

    def automaton(self) -> ahocorasick.Automaton:
        if self._automaton is None:
            found = ahocorasick.Automaton()
            for phrase in self.exceptions:
                found.add_word(phrase, (len(phrase), None))
            for entry, weight in self.weights.items():
                if entry not in self.exceptions:
                    found.add_word(entry, (len(entry), weight))
            if len(found):
                found.make_automaton()
            self._automaton = found
        return self._automaton

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_automaton": None}

    def hits(self, folded: str) -> dict[int, float]:
        """Weight of the best entry of each matched word outside the exceptions, by the place before the word."""
        out: dict[int, float] = {}
        free: list[tuple[int, int]] = []
        automaton = self.automaton()
        if len(automaton):
            for end, (size, weight) in automaton.iter(folded):
                at = end - size + 1
                if weight is None:
                    free.append((at, end))
                elif weight > out.get(at, 0.0):
                    out[at] = weight
        for a, b in free:                               # as long as the phrases found: words begin at their spaces
            at = a
            while 0 <= at < b:
                out.pop(at, None)
                at = folded.find(" ", at + 1, b)
        return out

    def total(self, folded: str) -> tuple[float, int]:
        """Sum of a text's weights, and its words."""
        return float(sum(self.hits(folded).values())), folded.count(" ") - 1

    def score(self, total: np.ndarray, words: np.ndarray) -> np.ndarray:
        z = self.shift + self.slope * total / (words + 20.0) ** self.power
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _beginnings(word: str) -> Iterable[str]:
    yield f" {word} "
    for k in range(SHORTEST, min(len(word), LONGEST) + 1):
        yield f" {word[:k]}"


def _words(folded: str) -> Counter:
    """Occurrences of a text's words and their beginnings."""
    out: Counter = Counter()
    for word, n in Counter(folded.split()).items():
        for p in _beginnings(word):
            out[p] += n
    return out


def _counted(texts: DataFrame, patterns: Callable[[str], Counter]) -> DataFrame:
    """(pattern, uses, texts): how often each pattern occurs in ``texts`` (text), and in how many of them."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        uses, held = Counter(), Counter()
        for t in batch.column("text").to_pylist():
            found = patterns(fold(t or ""))
            uses.update(found)
            held.update(found.keys())
        return pa.RecordBatch.from_arrays([pa.array(list(uses), pa.string()), pa.array(list(uses.values()), pa.int64()),
                                           pa.array([held[k] for k in uses], pa.int64())], ["pattern", "uses", "texts"])

    some = map_texts(texts.select("text"), run, StructType.fromDDL("pattern string, uses long, texts long"))
    return some.groupBy("pattern").agg(F.sum("uses").alias("uses"), F.sum("texts").alias("texts"))


def _matches(patterns: Iterable[str]) -> Callable[[str], Counter]:
    """Occurrences of known patterns in a folded text."""
    found = Lexicon(dict.fromkeys(patterns, 1.0)).automaton()
    return lambda folded: Counter(folded[end - size + 1:end + 1] for end, (size, _) in found.iter(folded))


def _closed(rows: list) -> list:
    """Rows whose occurrences in toxic texts are not (nine tenths of them) those of one longer entry:
    the beginning of one word gives way to the word, that of many stays."""
    longer: dict[str, int] = {}
    for r in rows:
        longer[r.pattern[:-1]] = max(longer.get(r.pattern[:-1], 0), r.uses)
    return [r for r in rows if 10 * longer.get(r.pattern, 0) < 9 * r.uses]


def learn_lexicon(sample: DataFrame, size: int = 2000, exceptions: Iterable[str] = (), least_ratio: float = 2.0,
                  least_g: float = 20.0) -> Lexicon | None:
    """A lexicon learned from ``sample`` (text, y: 0 or 1), a bounded table; None if it lacks one of the labels.

    An entry occurs in three toxic texts or more, more often in toxic texts (``least_ratio``: natural
    logarithm of the ratio of its shares of all words, also its weight) and in significantly more of them
    (``least_g``, the likelihood ratio statistic). The ``size`` most significant ones are taken. Two words
    that hold a match yet occur in five texts or more, 95 % of them not toxic, are an exception;
    ``exceptions`` adds further phrases."""
    base = {r.y: r for r in sample.groupBy("y").agg(
        F.count(F.lit(1)).alias("texts"), F.sum(F.size(F.split("text", r"\s+"))).alias("words")).collect()}
    if 0 not in base or 1 not in base:
        return None
    toxic, other = sample.where("y = 1"), sample.where("y = 0")
    rows = _counted(toxic, _words).where("texts >= 3").orderBy(F.desc("texts"), "pattern").limit(25 * size).collect()
    innocent = {r.pattern: r for r in _counted(other, _matches([r.pattern for r in rows])).collect()} if rows else {}
    n0, n1 = base[0].texts, base[1].texts
    found = []
    for r in rows:
        t0, d0 = (innocent[r.pattern].uses, innocent[r.pattern].texts) if r.pattern in innocent else (0, 0)
        weight = math.log((r.uses + 0.5) / base[1].words) - math.log((t0 + 0.5) / base[0].words)
        share = (d0 + r.texts) / (n0 + n1)
        g = 2 * sum(d * math.log(d / (share * n)) for d, n in ((d0, n0), (r.texts, n1)) if d)
        if weight > least_ratio and g > least_g:
            found.append((-g, r, weight))
    weight_of = {r.pattern: w for _, r, w in sorted(found)[:size]}
    lexicon = Lexicon({r.pattern: weight_of[r.pattern] for r in _closed([r for r in rows if r.pattern in weight_of])})

    def around(folded: str) -> Counter:
        """The pairs of words that hold a match."""
        out: Counter = Counter()
        for at in lexicon.hits(folded):
            end = folded.find(" ", at + 1)
            before, after = folded.rfind(" ", 0, at), folded.find(" ", end + 1)
            if before >= 0:
                out[folded[before:end + 1]] += 1
            if after > 0:
                out[folded[at:after + 1]] += 1
        return out

    bad = {r.pattern: r.texts for r in _counted(toxic, around).orderBy(F.desc("texts"), "pattern").limit(25 * size).collect()}
    good = _counted(other, around).where("texts >= 5").orderBy(F.desc("texts"), "pattern").limit(size).collect()
    learned = {r.pattern for r in good if 20 * bad.get(r.pattern, 0) <= r.texts + bad.get(r.pattern, 0)}
    lexicon = Lexicon(lexicon.weights, sorted(learned | {fold(x) for x in exceptions}))

    def totals(batch: pa.RecordBatch) -> pa.RecordBatch:
        sums = [lexicon.total(fold(t or "")) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in sums], pa.float64()), pa.array([x[1] for x in sums], pa.float64()),
                                           batch.column("y")], ["total", "words", "y"])

    got = map_texts(sample, totals, StructType.fromDDL("total double, words double, y int")).toArrow()
    total, words, y = (got[c].to_numpy() for c in ("total", "words", "y"))
    return _curve(lexicon, total, words, y.astype(float))


def _curve(lexicon: Lexicon, total: np.ndarray, words: np.ndarray, y: np.ndarray) -> Lexicon:
    """The power of the length and the logistic curve (Newton steps) with the least loss."""
    best = np.inf
    for power in (0.0, 0.25, 0.5, 0.75, 1.0):
        x = total / (words + 20.0) ** power
        scale = x.std() or 1.0
        design = np.stack([x / scale, np.ones(len(x))], 1)
        w = np.zeros(2)
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(design @ w, -40, 40)))
            slope = design.T @ (y - p) - 1e-3 * w
            curve = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
            w = w + np.clip(np.linalg.solve(curve, slope), -2, 2)
        z = np.clip(design @ w, -40, 40)
        loss = float(np.logaddexp(0, np.where(y > 0, -z, z)).sum())
        if loss < best:
            best = loss
            lexicon = Lexicon(lexicon.weights, lexicon.exceptions, power, float(w[0] / scale), float(w[1]))
    return lexicon


def score_texts(df: DataFrame, lexicon: Lexicon | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted, words, matches) of every row of ``df``: ``score`` is the probability of a toxic
    text, ``predicted`` 1 from 0.5 on, ``matches`` the matched beginnings of words with weights, in text order.
    Without a lexicon every score is 0.

    A null or empty text has no match and the score of a text without words; a null id stays null; repeated
    rows are returned as often as they come; an empty table gives an empty result; other columns are not read."""
    known = lexicon or Lexicon({}, shift=-40.0)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        folded = [fold(t or "") for t in batch.column("text").to_pylist()]
        hits = [known.hits(t) for t in folded]
        total = np.array([sum(h.values()) for h in hits], float)
        words = np.array([t.count(" ") - 1 for t in folded], float)
        score = known.score(total, words)
        matches = [[{"word": t[at + 1:t.find(" ", at + 1)], "weight": w} for at, w in sorted(h.items())] for t, h in zip(folded, hits)]
        own = [pa.array(score), pa.array((score >= 0.5).astype(np.int32)), pa.array(words.astype(np.int64)),
               pa.array(matches, pa.list_(pa.struct([("word", pa.string()), ("weight", pa.float64())])))]
        return pa.RecordBatch.from_arrays([batch.column("id"), *own], ["id", "score", "predicted", "words", "matches"])

    src = df.select(*id_text(id_col, text_col))
    fields = "score double, predicted int, words long, matches array<struct<word: string, weight: double>>"
    return map_texts(src, run, with_fields(src.schema["id"], fields))


def classify(df: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
             label_id: str = "doc_id", label_col: str = "toxic", rows: int = 20000, seed: int = 42,
             exceptions: Iterable[str] = ()) -> DataFrame:
    """:func:`score_texts` of every row of ``df`` by a lexicon learned from the labels (0 or 1) of the rows of
    ``labels`` where ``learn`` (a condition on ``labels``) holds: at most about ``rows`` of them, chosen by a
    hash of the id (:func:`~strata.llm.common.labelled_sample` states what null and repeated rows teach).
    Without both labels there is no lexicon and every score is 0."""
    known = labels.where(learn).select(F.col(f"`{label_id}`").alias("id"), F.col(f"`{label_col}`").cast("double").alias("y"))
    sample = written(labelled_sample(known, df.select(*id_text(id_col, text_col)), rows, seed).select("text", "y"), "toxic-sample")
    return score_texts(df, learn_lexicon(sample, exceptions=exceptions), id_col, text_col)
