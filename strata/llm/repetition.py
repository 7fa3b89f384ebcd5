"""Quality rules on repetition: a suffix array per text.

The words of a text are ranked by prefix doubling (numpy sorts, only positions
whose prefix still repeats are ranked again); neighbouring suffixes' longest
common prefixes come from the ranks kept of each doubling. The largest common
prefix a position shares with any other position is the larger of its two
neighbours' values, and the span it starts is a maximal repeated substring's
occurrence: the union of those spans, as a share of all words, and the longest
of them are what the rules limit.

Texts are handled a batch at a time in one array, ranked by (text, word) so
that nothing repeats across texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import id_text, map_texts, text_bytes, with_fields

#: Words ranked in one array, unless a single text has more.
_ARRAY_WORDS = 200_000
_SPACES = (" ", "\t", "\n", "\v", "\f", "\r")

FIELDS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "repeat_fraction double, longest_repeat long, base_failed boolean, kept boolean")


def suffix_neighbours(ranks: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes that are neighbours in the suffix array and begin with the same
    symbol, in the array's order, as two arrays of positions, and the length
    of their common prefix, without running past ``end`` (the exclusive bound
    of each position's text). ``ranks``: each symbol as the number of positions
    whose symbol is smaller, different texts having different symbols."""
    n = len(ranks)
    levels, rank, length = [ranks], ranks, 1
    order = np.argsort(ranks, kind="stable")
    while True:
        sorted_rank = rank[order]
        tied = np.zeros(n, bool)
        same = sorted_rank[1:] == sorted_rank[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        if not tied.any():
            break
        at = np.flatnonzero(tied)                     # slots of the suffix array still to be ordered
        pos = order[at]
        nxt = pos + length
        inside = nxt < end[pos]
        second = np.where(inside, rank[np.minimum(nxt, n - 1)] + 1, 0)
        by = np.lexsort((second, rank[pos]))
        order[at] = pos[by]
        # a rank is the first slot of its group, so untouched ranks keep their place
        first, sec = rank[pos[by]], second[by]
        new = np.r_[True, (first[1:] != first[:-1]) | (sec[1:] != sec[:-1])]
        # suffixes that end here share nothing further: each is a group of its own
        new |= sec == 0
        new[1:] |= sec[:-1] == 0
        rank = rank.copy()
        rank[order[at]] = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        levels.append(rank)
        length *= 2
    # longest common prefix of neighbours, by descending the doublings
    a, b = order[:-1], order[1:]
    pairs = np.flatnonzero(ranks[a] == ranks[b])
    x, y = a[pairs].copy(), b[pairs].copy()
    common = np.zeros(len(pairs), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        ok = (x < end[a[pairs]]) & (y < end[b[pairs]])
        ok &= levels[k][np.minimum(x, n - 1)] == levels[k][np.minimum(y, n - 1)]
        step = np.where(ok, 1 << k, 0)
        common += step
        x += step
        y += step
    return a[pairs], b[pairs], common


def longest_shared(ranks: np.ndarray, end: np.ndarray) -> np.ndarray:
    """For each position, the length of the longest run of symbols starting
    there that also starts at another position (arguments as above)."""
    a, b, common = suffix_neighbours(ranks, end)
    best = np.zeros(len(ranks), np.int64)
    np.maximum.at(best, a, common)
    np.maximum.at(best, b, common)
    return best


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` positions the union of the spans covers."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + lengths, -1)
    return np.cumsum(edge[:n]) > 0


def measure(words: list[list], min_repeat: int) -> list[tuple[int, int, int]]:
    """(words in 3-word windows that repeat, words in repeated substrings of
    ``min_repeat`` words or more, longest repeat) of each list of words."""
    sizes = np.array([len(w) for w in words], np.int64)
    total = int(sizes.sum())
    if not total:
        return [(0, 0, 0)] * len(words)
    text = np.repeat(np.arange(len(words)), sizes)
    ids: dict = {}
    flat = np.fromiter((ids.setdefault(x, len(ids)) for w in words for x in w), np.int64, total)
    key = text * len(ids) + flat
    order = np.argsort(key, kind="stable")
    slot = np.arange(total)
    first = np.r_[True, key[order][1:] != key[order][:-1]]
    ranks = np.empty(total, np.int64)
    ranks[order] = slot[np.maximum.accumulate(np.where(first, slot, 0))]
    end = np.repeat(np.cumsum(sizes), sizes)
    best = longest_shared(ranks, end)
    three, long = np.flatnonzero(best >= 3), np.flatnonzero(best >= min_repeat)
    in_three = covered(three, np.full(len(three), 3), total)
    in_long = covered(long, best[long], total)
    counts = [np.bincount(text, weights=x, minlength=len(words)).astype(np.int64) for x in (in_three, in_long)]
    longest = np.zeros(len(words), np.int64)
    np.maximum.at(longest, text, best)
    return list(zip(counts[0].tolist(), counts[1].tolist(), longest.tolist()))


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


def _lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip("".join(_SPACES))]
    return len(lines) - len(set(lines))


def rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50,
          max_window_percent: int = 50, min_repeat: int = 8, max_fraction: float = 0.3,
          max_longest: int = 200, carry: bool = False) -> DataFrame:
    """The rules' figures and verdict for every row of ``df``: id, n_words,
    word_chars, n_symbols, n_dup_lines, n_repeat_words, repeat_fraction,
    longest_repeat, base_failed, kept.

    Words are runs without white space. A text fails the base rules with under
    ``min_words`` words or with more than ``max_window_percent`` percent of its
    words in 3-word windows that occur twice or more. It is then kept if
    repeated substrings of ``min_repeat`` words or more cover at most
    ``max_fraction`` of its words and the longest has at most ``max_longest``.

    Null and empty texts have no words (figures 0, base_failed, not kept);
    a null id stays null; repeated rows are returned as often as they come; an
    empty table gives an empty result; other columns are not read. With
    ``carry`` the whole input row comes along as struct ``row``."""
    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        data = text_bytes(batch)
        words = [x.split() for x in data]
        found = [x for group in _arrays(words) for x in measure(group, min_repeat)]
        rows = []
        for raw, w, (windows, spans, longest) in zip(data, words, found):
            t = raw.decode("utf-8", "replace")
            n = len(w)
            failed = n < min_words or 100 * windows > max_window_percent * n
            share = spans / n if n else 0.0
            rows.append((n, len(t) - sum(map(t.count, _SPACES)), sum(map(t.count, "#*$%&|<>")), _lines(t),
                         windows, share, longest, failed,
                         not failed and share <= max_fraction and longest <= max_longest))
        types = [pa.int64()] * 5 + [pa.float64(), pa.int64(), pa.bool_(), pa.bool_()]
        own = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
        return pa.RecordBatch.from_arrays([batch.column(0), *own], [batch.schema.field(0).name, *_NAMES])

    if carry:
        src = df.select(F.struct("*").alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))
    else:
        src = df.select(*id_text(id_col, text_col))
    return map_texts(src, judge, with_fields(src.schema.fields[0], FIELDS))


_NAMES = [x.split()[0] for x in FIELDS.split(", ")]


def keep_good(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """The rows of ``df`` that :func:`rules` keeps, columns unchanged."""
    return rules(df, id_col, text_col, carry=True, **limits).where("kept").select("row.*")
