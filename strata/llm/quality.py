"""Quality classifier: histogram gradient-boosted trees over document statistics.

Executors turn every whole text into some twenty figures. Trees are grown on
the driver from a bounded sample of labelled rows' figures: features are cut
into at most 64 bins, a level's gradient histograms come from one counting
pass per feature, and the best cut by gain splits each node. The trees are
kept as arrays of complete binary trees (feature and threshold per node, value
per leaf), which numpy walks for a whole batch at once, a level per step.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import id_text, map_texts, text_bytes, with_fields, written

STATISTICS = (
    "log_words", "mean_word", "longest_word", "short_words", "distinct_words", "top_word", "distinct_windows",
    "log_lines", "words_per_line", "equal_lines", "stops_per_word", "symbols", "exclamations", "pipes", "capitals",
    "digits", "spaces", "non_ascii", "commas", "quotes", "brackets", "capital_words",
)


def _mask(chars: str) -> np.ndarray:
    out = np.zeros(256)
    out[list(chars.encode())] = 1
    return out


_CLASSES = np.stack([
    _mask("#*$%&|<>"), _mask("!"), _mask("|"), _mask("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _mask("0123456789"),
    _mask(" \t\n\v\f\r"), np.arange(256) >= 128, _mask(","), _mask("'\""), _mask("()[]{}")], axis=1).astype(np.float64)


def statistics(data: bytes) -> list[float]:
    """The figures of one text, in the order of :data:`STATISTICS`."""
    n = max(1, len(data))
    symbols, shouts, pipes, capitals, digits, spaces, wide, commas, quotes, brackets = (
        np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ _CLASSES / n)
    w = data.split()
    k = max(1, len(w))
    lengths = np.fromiter(map(len, w), np.int64, len(w))
    lines = [x for x in data.split(b"\n") if x.strip()]
    seen = Counter(w)
    windows = set(zip(w, w[1:], w[2:]))
    stops = data.count(b".") + data.count(b"!") + data.count(b"?")
    return [np.log1p(len(w)), float(lengths.sum()) / k, float(lengths.max(initial=0)), float((lengths <= 3).sum()) / k,
            len(seen) / k, max(seen.values(), default=0) / k, len(windows) / max(1, len(w) - 2),
            np.log1p(len(lines)), len(w) / max(1, len(lines)), 1 - len(set(lines)) / max(1, len(lines)), stops / k,
            symbols, shouts, pipes, capitals, digits, spaces, wide, commas, quotes, brackets,
            sum(map(bytes.isupper, w)) / k]


class Forest:
    """Boosted trees for a 0/1 label, flattened."""

    def __init__(self, trees: int = 60, depth: int = 5, rate: float = 0.15, bins: int = 64, least: float = 1.0):
        self.trees, self.depth, self.rate, self.bins, self.least = trees, depth, rate, bins, least

    def fit(self, x: np.ndarray, y: np.ndarray) -> Forest:
        n, m = x.shape
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(m)]
        binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], 1)
        inner, leaves = (1 << self.depth) - 1, 1 << self.depth
        self.feature = np.zeros((self.trees, inner), np.int32)
        self.threshold = np.full((self.trees, inner), np.inf)
        self.value = np.zeros((self.trees, leaves))
        mean = (y.sum() + 1) / (n + 2)
        self.start = float(np.log(mean / (1 - mean)))
        z = np.full(n, self.start)
        for t in range(self.trees):
            p = 1 / (1 + np.exp(-z))
            g, h = p - y, p * (1 - p)
            node = np.zeros(n, np.int64)               # place within the level
            for level in range(self.depth):
                width, first = 1 << level, (1 << level) - 1
                best = np.zeros(width)
                for j in range(m):
                    if not len(cuts[j]):
                        continue
                    b = len(cuts[j]) + 1
                    key = node * b + binned[:, j]
                    gl = np.bincount(key, g, width * b).reshape(width, b).cumsum(1)
                    hl = np.bincount(key, h, width * b).reshape(width, b).cumsum(1)
                    ga, ha = gl[:, -1:], hl[:, -1:]
                    gain = gl ** 2 / (hl + 1) + (ga - gl) ** 2 / (ha - hl + 1) - ga ** 2 / (ha + 1)
                    gain[(hl < self.least) | (ha - hl < self.least)] = 0
                    gain = gain[:, :-1]
                    at = gain.argmax(1)
                    top = gain[np.arange(width), at]
                    up = top > best + 1e-9
                    best[up] = top[up]
                    self.feature[t, first:first + width][up] = j
                    self.threshold[t, first:first + width][up] = cuts[j][at[up]]
                f, c = self.feature[t, first + node], self.threshold[t, first + node]
                node = 2 * node + (x[np.arange(n), f] > c)
            total, weight = np.bincount(node, g, leaves), np.bincount(node, h, leaves)
            self.value[t] = -self.rate * total / (weight + 1)
            z += self.value[t, node]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each row, all trees side by side."""
        z = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for t in range(self.trees):
            node = np.zeros(len(x), np.int64)
            for level in range(self.depth):
                at = (1 << level) - 1 + node
                node = 2 * node + (x[rows, self.feature[t, at]] > self.threshold[t, at])
            z += self.value[t, node]
        return 1 / (1 + np.exp(-z))


_FIELDS = "stats array<float>"


def document_statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, stats) of every row of ``df``; a null text reads as empty."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.array([statistics(t) for t in text_bytes(batch)], np.float32)
        flat = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
        return pa.RecordBatch.from_arrays([batch.column("id"), flat], ["id", "stats"])

    src = df.select(*id_text(id_col, text_col))
    return map_texts(src, run, with_fields(src.schema["id"], _FIELDS))


def classify(df: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
             label_id: str = "doc_id", label_col: str = "quality", rows: int = 20000, seed: int = 42) -> DataFrame:
    """(id, score, predicted) of every row of ``df``. Trees are grown from the labels (0 or 1) of the
    rows of ``labels`` where ``learn`` (a condition on ``labels``) holds: at most about ``rows`` of
    them, chosen by a hash of the id.

    Null and empty texts are scored like any other; null labels and labels without id are not learned
    from; several labels of an id count as their mean, half rounded up, and an id with several texts teaches one of them. Without anything to learn every score is 0.5.
    A null id stays null; repeated rows are returned as often as they come; an empty table gives an empty
    result; other columns are not read."""
    stats = written(document_statistics(df, id_col, text_col), "statistics")
    known = labels.where(learn).select(F.col(f"`{label_id}`").alias("id"), F.col(f"`{label_col}`").cast("double").alias("y"))
    known = known.where(F.col("id").isNotNull() & F.col("y").isNotNull())
    known = known.groupBy("id").agg(F.floor(F.avg("y") + 0.5).cast("double").alias("y"))
    n = known.count()
    pick = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1_000_003)) / 1_000_003.0
    chosen = known.where(pick < rows / max(n, 1)).join(stats, "id")
    got = chosen.groupBy("id", "y").agg(F.min_by("stats", F.xxhash64("stats")).alias("stats")).select("id", "y", "stats").toArrow()
    order = np.lexsort((got["y"].to_numpy(), got["id"].to_numpy()))
    model = None
    if len(order):
        x = np.stack(got["stats"].to_numpy())[order]
        model = Forest().fit(x.astype(np.float64), got["y"].to_numpy()[order])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.stack(batch.column("stats").to_numpy(zero_copy_only=False)).astype(np.float64)
        score = model.score(x) if model else np.full(len(x), 0.5)
        return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                                          ["id", "score", "predicted"])

    return map_texts(stats, run, with_fields(stats.schema["id"], "score double, predicted int"))
