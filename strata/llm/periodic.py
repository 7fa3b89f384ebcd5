"""Periodic runs of words, found by a Kruskal pass over common prefixes.

A run is a stretch of consecutive words with smallest period q, at least
``min_length`` and 2q long, that no neighbouring word extends. Suffixes of a
text that share their first L words form a class, a set of positions; going
through the suffix array's common prefixes from the longest to the shortest
unites classes like Kruskal's algorithm unites trees. The smaller set is put
into the larger one, and only positions that become neighbours by that are
looked at: two of them at distance d, d at most the common prefix L, start two
equal blocks of d words one after the other, the seed of a run with smallest
period d that ends d + L words behind the first.

(Were the smallest period a smaller divisor of d, the position between them
would share a longer prefix, be in the set already, and lie between.) Each start within a run seeds
it as long as its common prefix reaches d, the run's own start included, so a run's start is
the smallest seed of its end and period. A run of the reported length
starts with L >= ``min_length`` / 2 equal words, so shorter common
prefixes are never united: in ordinary prose almost nothing is.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from strata.llm.common import id_text, map_texts, text_bytes, with_fields
from strata.llm.repetition import suffix_neighbours

#: Words ranked in one array, unless a single text has more.
_ARRAY_WORDS = 200_000
#: Positions in one piece of a set.
_PIECE = 512


class Positions:
    """A set of positions in ascending order, in pieces of bounded size: an
    insertion moves one piece, whatever the size of the set."""

    __slots__ = ("pieces", "firsts", "size")

    def __init__(self, first: int):
        self.pieces, self.firsts, self.size = [[first]], [first], 1

    def __iter__(self) -> Iterator[int]:
        for piece in self.pieces:
            yield from piece

    def add(self, x: int) -> tuple[int, int]:
        """Puts ``x`` in; the neighbours below and above it (-1: none)."""
        k = max(0, bisect_left(self.firsts, x) - 1)
        piece = self.pieces[k]
        j = bisect_left(piece, x)
        below = piece[j - 1] if j else -1
        above = piece[j] if j < len(piece) else self.firsts[k + 1] if k + 1 < len(self.firsts) else -1
        piece.insert(j, x)
        self.firsts[k] = piece[0]
        self.size += 1
        if len(piece) > _PIECE:
            half = len(piece) // 2
            self.pieces.insert(k + 1, piece[half:])
            del piece[half:]
            self.firsts.insert(k + 1, self.pieces[k + 1][0])
        return below, above


def _unite(a: Positions, b: Positions) -> tuple[Positions, list[tuple[int, int]]]:
    """The union of two sets, and the neighbours in it that come from different ones."""
    if a.size < b.size:
        a, b = b, a
    met = []
    last = -1                                           # the smaller set's position put in before
    for x in b:
        below, above = a.add(x)
        if met and met[-1][0] == last and met[-1][1] > x:
            met.pop()                                   # x lies between
        if below >= 0 and below != last:
            met.append((below, x))
        if above >= 0:
            met.append((x, above))
        last = x
    return a, met


def seeds(x: np.ndarray, y: np.ndarray, common: np.ndarray, least: int) -> tuple[list[int], list[int], list[int]]:
    """(starts, periods, ends) seeded by the neighbours ``x``, ``y`` of the suffix
    array with ``common`` words in common, of which at least ``least``."""
    far = np.flatnonzero(common >= least)
    order = far[np.argsort(-common[far], kind="stable")]
    held: dict[int, Positions] = {}
    root: dict[int, int] = {}

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    starts, periods, ends = [], [], []
    for i, j, shared in zip(x[order].tolist(), y[order].tolist(), common[order].tolist()):
        for p in (i, j):
            if p not in root:
                root[p] = p
                held[p] = Positions(p)
        a, b = find(i), find(j)
        one, other = held.pop(a), held.pop(b)
        if one.size < other.size:
            a, b = b, a
        root[b] = a
        held[a], met = _unite(one, other)
        for lo, hi in met:
            if hi - lo <= shared:
                starts.append(lo)
                periods.append(hi - lo)
                ends.append(hi + shared)
    return starts, periods, ends


def find_runs(words: list[list], min_length: int = 12) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each list of words, by start, then period."""
    sizes = np.array([len(w) for w in words], np.int64)
    total = int(sizes.sum())
    out: list[list[tuple[int, int, int]]] = [[] for _ in words]
    if not total:
        return out
    ids: dict = {}
    flat = np.fromiter((ids.setdefault(x, len(ids)) for w in words for x in w), np.int64, total)
    text = np.repeat(np.arange(len(words)), sizes)
    _, which, counts = np.unique(text * len(ids) + flat, return_inverse=True, return_counts=True)
    ranks = (np.cumsum(counts) - counts)[which]
    bounds = np.cumsum(sizes)
    x, y, common = suffix_neighbours(ranks, np.repeat(bounds, sizes))
    starts, periods, ends = (np.array(v, np.int64) for v in seeds(x, y, common, max(1, (min_length + 1) // 2)))
    if not len(starts):
        return out
    by = np.lexsort((starts, periods, ends))            # a run's seeds: its end and period, the smallest start first
    starts, periods, ends = starts[by], periods[by], ends[by]
    first = np.r_[True, (ends[1:] != ends[:-1]) | (periods[1:] != periods[:-1])]
    starts, periods, lengths = starts[first], periods[first], (ends - starts)[first]
    long = lengths >= np.maximum(min_length, 2 * periods)
    starts, periods, lengths = starts[long], periods[long], lengths[long]
    by = np.lexsort((periods, starts))
    base = bounds - sizes
    for s, n, q in zip(starts[by].tolist(), lengths[by].tolist(), periods[by].tolist()):
        t = int(text[s])
        out[t].append((s - int(base[t]), n, q))
    return out


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """``words`` with one period of each run: words that a run contains after its first period are dropped."""
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return [w for w, k in zip(words, np.cumsum(edge).tolist()) if not k]


def _arrays(words: list[list]) -> Iterator[list[list]]:
    """Lists of words, dealt into arrays of bounded size."""
    group, held = [], 0
    for w in words:
        if group and held + len(w) > _ARRAY_WORDS:
            yield group
            group, held = [], 0
        group.append(w)
        held += len(w)
    if group:
        yield group


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 12) -> DataFrame:
    """(id, n_words, runs array<struct<start, length, period>>, collapsed) of every row of ``df``: the
    periodic runs of the text's words (runs without white space), numbered from 0, by start, then period, and
    the words that remain, joined by one space, if each run keeps its first period only.

    A null or empty text has no words, no runs and the collapsed text ""; a null id stays null; repeated rows
    are returned as often as they come; an empty table gives an empty result; other columns are not read."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = [t.split() for t in text_bytes(batch)]
        found = [r for group in _arrays(words) for r in find_runs(group, min_length)]
        as_rows = [[dict(zip(("start", "length", "period"), r)) for r in runs] for runs in found]
        kept = [b" ".join(collapse(w, r) if r else w).decode("utf-8", "replace") for w, r in zip(words, found)]
        own = [pa.array([len(w) for w in words], pa.int64()),
               pa.array(as_rows, pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "length", "period")]))),
               pa.array(kept, pa.string())]
        return pa.RecordBatch.from_arrays([batch.column("id"), *own], ["id", "n_words", "runs", "collapsed"])

    src = df.select(*id_text(id_col, text_col))
    fields = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return map_texts(src, run, with_fields(src.schema["id"], fields))
