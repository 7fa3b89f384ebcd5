"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier one: a minimal perfect hash over the vocabulary resolves a pre-token that
is one token as a whole. Tier two: any other pre-token is merged from its
bytes, a heap giving the adjacent pair of lowest rank (leftmost first) over a
linked list of parts.

A text falls apart at every single space between two other characters: no
pre-token reaches across, and what follows doesn't depend on what came before.
Each worker remembers the ids of recent pieces (bounded, two generations), so
the split pattern and the merges run once per piece that is new to it.
"""

from __future__ import annotations

import base64
import gc
import re
from array import array
from heapq import heapify, heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import id_text, map_texts, with_fields

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN

#: Pieces remembered per generation by a worker (about 200 bytes each).
_REMEMBER = 400_000
_NONE = 1 << 31


def read_ranks(path: str) -> list[tuple[bytes, int]]:
    """(bytes, rank) of every entry of a rank file."""
    with open(path, "rb") as f:
        return [(base64.b64decode(a), int(b)) for a, b in (x.split() for x in f if x.strip())]


class PerfectHash:
    """A minimal perfect hash: every key has a slot of its own in a table of
    exactly as many slots. Keys are hashed into small buckets; largest first,
    each bucket gets the first displacement that sends its keys to free slots
    (a bucket of one key names its slot outright)."""

    _MIX = 0x9E3779B97F4A7C15
    _MASK = (1 << 64) - 1

    def __init__(self, keys: list[bytes], values: list[int]):
        n = len(keys)
        self.size, self.buckets = n, max(1, n // 2)
        hashes = [xxhash.xxh3_64_intdigest(k) for k in keys]
        if len(set(hashes)) < n:
            raise ValueError("two keys share a 64-bit hash")
        members: list[list[int]] = [[] for _ in range(self.buckets)]
        for i, h in enumerate(hashes):
            members[h % self.buckets].append(i)
        self.shift = [0] * self.buckets
        slots: list[int | None] = [None] * n
        by_size = sorted(range(self.buckets), key=lambda b: -len(members[b]))
        for b in by_size:
            if len(members[b]) < 2:
                break
            d = 0
            while True:
                at = [self._slot(hashes[i], d) for i in members[b]]
                if len(set(at)) == len(at) and all(slots[x] is None for x in at):
                    break
                d += 1
            self.shift[b] = d
            for i, x in zip(members[b], at):
                slots[x] = i
        free = iter([x for x in range(n) if slots[x] is None])
        for b in by_size:
            if len(members[b]) == 1:
                x = next(free)
                self.shift[b] = -x - 1
                slots[x] = members[b][0]
        self.keys = [keys[i] for i in slots]
        self.values = [values[i] for i in slots]

    def _slot(self, h: int, d: int) -> int:
        x = (h ^ (d * self._MIX)) & self._MASK
        x = ((x ^ (x >> 31)) * self._MIX) & self._MASK
        return (x >> 32) % self.size

    def get(self, key: bytes) -> int | None:
        h = xxhash.xxh3_64_intdigest(key)
        d = self.shift[h % self.buckets]
        x = -d - 1 if d < 0 else self._slot(h, d)
        return self.values[x] if self.keys[x] == key else None


class _Memory(dict):
    """Ids (as int32 bytes) of recent pieces. What isn't known is looked for
    in the generation before, else made by ``make``."""

    def __init__(self, make):
        super().__init__()
        self.make, self.before = make, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.before.get(piece)
        if ids is None:
            ids = self.make(piece)
        if len(piece) <= 64:
            self[piece] = ids
        return ids

    def trim(self) -> None:
        if len(self) > _REMEMBER:
            self.before = dict(self)
            self.clear()


class Encoder:
    """Encodes and decodes texts; safe to send to executors (a table of the
    vocabulary's size)."""

    def __init__(self, ranks: list[tuple[bytes, int]], pattern: str = PATTERN):
        self.pattern, self.ranks = pattern, dict(ranks)
        self.whole = PerfectHash([a for a, _ in ranks], [b for _, b in ranks])
        self.bytes_of = {b: a for a, b in ranks}
        self.__setstate__(self.__dict__)

    def __getstate__(self) -> dict:
        return {k: self.__dict__[k] for k in ("pattern", "ranks", "whole", "bytes_of")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._split = regex.compile(self.pattern).findall
        self._two = [self.ranks.get(bytes((a, b)), _NONE) for a in range(256) for b in range(256)]
        self._token = _Memory(self.token)
        self._first = _Memory(self.piece)
        self._spaced = _Memory(lambda p: self.piece(" " + p))

    def merge(self, token: bytes) -> list[int]:
        """Ids of one pre-token, from its bytes."""
        n, ranks = len(token), self.ranks
        if n == 1:
            return [ranks[token]]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        two = self._two
        of = [two[a << 8 | b] for a, b in zip(token, token[1:])]   # rank of the pair that starts at a part
        heap = [r << 32 | i for i, r in enumerate(of) if r != _NONE]
        of.append(_NONE)
        heapify(heap)
        while heap:
            x = heappop(heap)
            i = x & 0xFFFFFFFF
            if of[i] != x >> 32:
                continue
            j = after[i]
            k = after[j]
            after[i] = k
            of[j] = of[i] = _NONE
            if k < n:
                before[k] = i
                r = ranks.get(token[i:after[k]])
                if r is not None:
                    of[i] = r
                    heappush(heap, r << 32 | i)
            p = before[i]
            if p >= 0:
                r = ranks.get(token[p:k])
                if r is None:
                    of[p] = _NONE
                else:
                    of[p] = r
                    heappush(heap, r << 32 | p)
        out, i = [], 0
        while i < n:
            out.append(ranks[token[i:after[i]]])
            i = after[i]
        return out

    def token(self, text: str) -> bytes:
        """Ids of one pre-token."""
        raw = text.encode()
        whole = self.whole.get(raw)
        return array("i", self.merge(raw) if whole is None else (whole,)).tobytes()

    def piece(self, text: str) -> bytes:
        """Ids of one piece of a text."""
        return b"".join(map(self._token.__getitem__, self._split(text)))

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text, as int32."""
        if not text:
            return np.zeros(0, "<i4")
        first, *rest = _ALONE.split(text) if _RUN.search(text) else text.split(" ")
        out = b"".join([self._first[first], *map(self._spaced.__getitem__, rest)])
        for memory in (self._token, self._first, self._spaced):
            memory.trim()
        return np.frombuffer(out, "<i4")

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.asarray(ids).tolist()))


#: A space beside other white space, or at either end: such texts are split
#: only at spaces that stand alone between other characters.
_RUN = re.compile(r" \s|\s |^ | $")
_ALONE = re.compile(r"(?<=\S) (?=\S)")

_ENCODERS: dict[tuple[str, str], Encoder] = {}


def _encoder(df: DataFrame, vocabulary: str, pattern: str):
    """A broadcast of the encoder; its size is that of the vocabulary, not of
    the data. The rank file is read on the driver only."""
    key = (vocabulary, pattern)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(read_ranks(vocabulary), pattern)
    return df.sparkSession.sparkContext.broadcast(_ENCODERS[key]), key


def _here(shared, key) -> Encoder:
    """The worker's own encoder, which keeps its memory from task to task."""
    if key not in _ENCODERS:
        _ENCODERS[key] = shared.value
        gc.set_threshold(100_000, 50, 100)     # the memory is large and has no cycles
    return _ENCODERS[key]


def _list(rows: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(rows), pa.int32()))


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY,
           pattern: str = PATTERN, round_trip: bool = False) -> DataFrame:
    """(id, n_tokens, ids array<int>) of every row of ``df``; with
    ``round_trip`` also ``decoded``, the bytes the ids decode to. Special
    tokens are never made.

    A null text encodes as the empty one (no ids); a null id stays null;
    repeated rows are returned as often as they come; an empty table gives an
    empty result; other columns are not read."""
    shared, key = _encoder(df, vocabulary, pattern)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoder = _here(shared, key)
        ids = [encoder.encode(t or "") for t in batch.column("text").to_pylist()]
        out = [batch.column("id"), pa.array([len(x) for x in ids], pa.int64()), _list(ids)]
        names = ["id", "n_tokens", "ids"]
        if round_trip:
            out.append(pa.array([encoder.decode(x) for x in ids], pa.binary()))
            names.append("decoded")
        return pa.RecordBatch.from_arrays(out, names)

    src = df.select(*id_text(id_col, text_col))
    more = ", decoded binary" if round_trip else ""
    return map_texts(src, run, with_fields(src.schema["id"], f"n_tokens long, ids array<int>{more}"))


def decode(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """(id, decoded binary) of every row of ``df``; a null list decodes to no
    bytes, an id outside the vocabulary is an error."""
    shared, key = _encoder(df, vocabulary, PATTERN)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoder = _here(shared, key)
        raw = [encoder.decode(x or ()) for x in batch.column("ids").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(raw, pa.binary())], ["id", "decoded"])

    src = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{ids_col}`").alias("ids"))
    return map_texts(src, run, with_fields(src.schema["id"], "decoded binary"))
