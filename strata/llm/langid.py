"""Language identification in two steps: family, then language.

A text is its relative counts of hashed byte pairs and triples (lower case).
Linear support vector machines separate the families from one another, one
against the rest; within a family, one machine per pair of languages votes.
All are trained here by dual coordinate descent on a bounded sample of
labelled texts, whose counts the executors make; every text is then scored
against one small weight matrix.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import id_text, map_texts, with_fields, written

#: Family of a language code; any other code is a family of its own.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "turkic": "az kk ky tr tk uz",
    "uralic": "et fi hu",
    "semitic": "am ar he mt",
    "indo-aryan": "bn gu hi mr ne pa si ur",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
_HALF = 4096
DIMS = 2 * _HALF
_LETTER = regex.compile(r"\p{L}").search
#: Bytes counted at a time: bounds the memory of a very long text.
_CHUNK = 1 << 22


def family(lang: str) -> str:
    return _FAMILY.get(lang.lower().split("-")[0], lang)


def counts(text: str) -> np.ndarray:
    """Relative counts of the text's hashed byte pairs and triples."""
    raw = np.frombuffer(f" {text.lower()} ".encode(), np.uint8)
    out = np.zeros(DIMS)
    for at in range(0, len(raw) - 1, _CHUNK):
        b = raw[at:at + _CHUNK + 2].astype(np.uint32)
        two = b[:-1] * np.uint32(2531) + b[1:] * np.uint32(40503)
        out[:_HALF] += np.bincount((two[:_CHUNK] >> np.uint32(3)) & np.uint32(_HALF - 1), minlength=_HALF)
        three = (two[:-1] * np.uint32(31) + b[2:] * np.uint32(2654435761))[:_CHUNK]
        out[_HALF:] += np.bincount(three >> np.uint32(20), minlength=_HALF)
    return (out / max(1, len(raw) - 1)).astype(np.float32)


def svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, epochs: int = 12, seed: int = 42) -> np.ndarray:
    """Weights (the last one the bias) of a linear support vector machine with
    squared hinge loss; ``y`` is +1 or -1, both sides weighing the same."""
    r = np.random.default_rng(seed)
    x = np.concatenate([x, np.ones((len(x), 1), x.dtype)], axis=1)
    share = np.where(y > 0, (y > 0).mean(), (y < 0).mean())
    diag = share / cost                                # 1 / (2 C) per row, C by class
    norm = (x * x).sum(1) + diag
    w, a = np.zeros(x.shape[1]), np.zeros(len(x))
    for _ in range(epochs):
        for i in r.permutation(len(x)):
            g = y[i] * (x[i] @ w) - 1 + diag[i] * a[i]
            new = max(0.0, a[i] - g / norm[i])
            if new != a[i]:
                w += (new - a[i]) * y[i] * x[i]
                a[i] = new
    return w


class Hierarchy:
    """The trained machines: one weight matrix, its rows naming what they separate."""

    #: Relative counts are small numbers; machines see them scaled.
    SCALE = 50.0

    def __init__(self, x: np.ndarray, langs: list[str], seed: int = 42):
        x = x * np.float32(self.SCALE)
        self.langs = sorted(set(langs))
        self.families = sorted({family(v) for v in self.langs})
        of = np.array([family(v) for v in langs])
        lang = np.array(langs)
        rows = []
        if len(self.families) > 1:
            rows += [svm(x, np.where(of == f, 1.0, -1.0), seed=seed) for f in self.families]
        self.members = [[v for v in self.langs if family(v) == f] for f in self.families]
        self.pairs = [(k, a, b) for k, m in enumerate(self.members) for a, b in combinations(m, 2)]
        for _, a, b in self.pairs:
            here = (lang == a) | (lang == b)
            rows.append(svm(x[here], np.where(lang[here] == a, 1.0, -1.0), seed=seed))
        self.weights = np.array(rows, np.float32).reshape(len(rows), DIMS + 1)

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and confidence (0 to 1) of each row of counts."""
        m = (x * np.float32(self.SCALE)) @ self.weights[:, :-1].T + self.weights[:, -1]
        sure = 1 / (1 + np.exp(-2.0 * m.astype(np.float64)))
        n = len(self.families) if len(self.families) > 1 else 0
        pick = m[:, :n].argmax(1) if n else np.zeros(len(x), int)
        out, score = [], np.ones(len(x))
        for i, k in enumerate(pick):
            members = self.members[k]
            votes = dict.fromkeys(members, (0, 0.0))
            for j, (f, a, b) in enumerate(self.pairs, n):
                if f == k:
                    won, lost = (a, b) if m[i, j] > 0 else (b, a)
                    votes[won] = (votes[won][0] + 1, votes[won][1] + abs(float(m[i, j])))
                    votes[lost] = (votes[lost][0], votes[lost][1] - abs(float(m[i, j])))
            best = max(members, key=lambda v: votes[v])
            out.append(best)
            score[i] = sure[i, k] if n else 1.0
            for j, (f, a, b) in enumerate(self.pairs, n):
                if best in (a, b) and f == k:
                    score[i] *= sure[i, j] if best == a else 1 - sure[i, j]
        return out, score


def sample(df: DataFrame, by: Column, rows: int, seed: int) -> DataFrame:
    """About ``rows`` rows of ``df`` (column ``id``), the same share of what
    each value of ``by`` is due, chosen by a hash of the id: no sort, no
    single task."""
    src = df.withColumn("_by", by)
    sizes = src.groupBy("_by").agg(F.count(F.lit(1)).alias("_n"))
    # written: a few rows of known size, which the join broadcasts instead of shuffling texts by value
    sizes = written(sizes, "sizes")
    share = sizes.withColumn("_share", F.lit(rows / max(1, sizes.count())) / F.col("_n"))
    pick = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1_000_003)) / 1_000_003.0
    return src.join(share, "_by").where(pick < F.col("_share")).drop("_by", "_n", "_share")


def train(df: DataFrame, rows: int = 2400, seed: int = 42) -> Hierarchy | None:
    """Machines learned from ``df`` (id, text, lang): a sample of about
    ``rows`` texts in all, each language having an equal part. Only their
    counts (``DIMS`` numbers each) reach the driver. None if there are no rows."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = [counts(t or "").tobytes() for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(x, pa.binary())], ["lang", "x"])

    chosen = sample(df, F.col("lang"), rows, seed).select("lang", "text")
    got = map_texts(chosen, run, with_fields(chosen.schema["lang"], "x binary")).collect()
    got.sort(key=lambda r: (r.lang, bytes(r.x)))       # the same machines whatever the order of tasks
    if not got:
        return None
    return Hierarchy(np.frombuffer(b"".join(r.x for r in got), np.float32).reshape(len(got), DIMS), [r.lang for r in got], seed)


def identify(df: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             rows: int = 2400, seed: int = 42) -> DataFrame:
    """(id, lang_pred, score) of every row of ``df``; machines are learned from the rows where
    ``learn`` (a condition on ``df``) holds, id and language are not null and the text has a letter.

    ``und`` (score 0) where the text is null, empty or without a letter, and everywhere if there is
    nothing to learn from. With one learned language every other text gets it. Equal margins of families, and equal votes and margins
    within one, go to the first in alphabetical order. A null id stays null;
    repeated rows are returned as often as they come; an empty table gives an empty result;
    other columns are not read."""
    known = df.where(learn).select(*id_text(id_col, text_col), F.col(f"`{lang_col}`").cast("string").alias("lang"))
    model = train(known.where(F.col("id").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")), rows, seed)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        lang, score = ["und"] * len(texts), np.zeros(len(texts))
        at = [i for i, t in enumerate(texts) if model is not None and _LETTER(t)]
        if at:
            found, sure = model.predict(np.stack([counts(texts[i]) for i in at]))
            score[at] = sure
            for i, v in zip(at, found):
                lang[i] = v
        return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(lang, pa.string()), pa.array(score)], ["id", "lang_pred", "score"])

    src = df.select(*id_text(id_col, text_col))
    return map_texts(src, run, with_fields(src.schema["id"], "lang_pred string, score double"))
