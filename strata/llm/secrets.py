"""Secret scans: rules propose, a character convolutional network decides.

Base findings (three kinds of rules) always stay. Other candidates come from
high-recall generators: long tokens that mix letters and digits, and private
key blocks. Every candidate, base or not, is scored with its surrounding
characters by a small convolutional network in numpy, in overlapping windows
over the whole of it of which the highest counts; a candidate that no base
finding contains is added if its calibrated score reaches the threshold.

The network is trained here, on labelled findings of ``examples`` rows made
from published credential formats and from look-alikes that are none (file
names, time stamps, versions, slugs, identifiers) in prose and code. A quarter
of them calibrates the score and sets the threshold: the highest that still
finds ``recall`` of that quarter's secrets.
"""

from __future__ import annotations

import random
import re
import string
from functools import lru_cache
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import id_text, map_texts, with_fields

#: Base kinds in the order that breaks ties, then what the method adds.
KINDS = ("assign", "access", "hex", "token", "pem")
_ORDER = {k: i for i, k in enumerate(KINDS)}

def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_ASSIGN = re.compile("(" + "|".join(map(_any_case, ("password", "passwd", "secret", "token"))) + "|"
                     + _any_case("api") + "_?" + _any_case("key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile("AKIA[A-Z0-9]+")
_HEX = re.compile("[0-9a-f]{32,}")                     # maximal runs, as the base rule's
_TOKEN = re.compile("[A-Za-z0-9][A-Za-z0-9_+/=.-]{18,}[A-Za-z0-9=]")
_MIXED = re.compile("(?=.*[0-9])(?=.*[A-Za-z])", re.S)
_DIGIT = re.compile("[0-9]")
_PEM = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:(?!-----BEGIN ).)*?-----END [A-Z ]*PRIVATE KEY-----", re.S)

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """The base findings of a text: leftmost non-overlapping per kind, a
    match that fails its length being dropped without another try."""
    out: list[Span] = []
    if "=" in text or ":" in text:
        out += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    out += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return out


def other_candidates(text: str, base: list[Span]) -> list[Span]:
    """What the generators propose that no base finding contains."""
    out: list[Span] = []
    if "-----BEGIN " in text:
        out += [("pem", *m.span()) for m in _PEM.finditer(text)]
    if _DIGIT.search(text):
        out += [("token", *m.span()) for m in _TOKEN.finditer(text) if _MIXED.match(m[0])]
    if not base or not out:
        return out
    taken = sorted((s, e) for _, s, e in base)
    starts = np.array([s for s, _ in taken])
    reach = np.maximum.accumulate([e for _, e in taken])
    at = np.searchsorted(starts, [s for _, s, _ in out], side="right") - 1     # last base span that starts no later
    return [c for c, i in zip(out, at) if i < 0 or reach[i] < c[2]]


# --- the network -----------------------------------------------------------

_LEFT, _BODY, _RIGHT, _WIDE = 24, 48, 8, 5
_STEP = 12
_LEN = _LEFT + _BODY + _RIGHT
_EMBED, _FILTERS, _HIDDEN = 8, 24, 16


def window(text: str, start: int, end: int, at: int | None = None) -> np.ndarray:
    """Character codes (ASCII, 127 for others, 0 for none) of a part of a
    candidate, from its start or from ``at``, and of what stands on either
    side, and 128 more on the part itself."""
    at = start if at is None else at
    body = text[at:min(end, at + _BODY)]
    left, right = text[max(0, at - _LEFT):at], text[end:end + _RIGHT] if at + _BODY >= end else text[at + _BODY:at + _BODY + _RIGHT]
    row = left.rjust(_LEFT, "\0") + body.ljust(_BODY, "\0") + right.ljust(_RIGHT, "\0")
    codes = np.frombuffer(row.encode("utf-32-le"), np.uint32).astype(np.int64)
    codes = np.minimum(codes, 127)
    codes[_LEFT:_LEFT + len(body)] += 128
    return codes


def starts(start: int, end: int) -> list[int]:
    """Where the windows over a candidate begin: at its start, every few
    characters, and so that the last one ends with it."""
    last = max(start, end - _BODY)
    return [*range(start, last, _STEP), last]


class CharNet:
    """Embedding, one convolution, maximum and mean over positions, a hidden
    layer, a logit; plain numpy, trained by Adam."""

    def __init__(self, seed: int):
        r = np.random.default_rng(seed)
        w = _WIDE * _EMBED
        self.p = {"emb": r.normal(0, 0.3, (256, _EMBED)), "conv": r.normal(0, w ** -0.5, (w, _FILTERS)),
                  "conv_b": np.zeros(_FILTERS), "hid": r.normal(0, (2 * _FILTERS) ** -0.5, (2 * _FILTERS, _HIDDEN)),
                  "hid_b": np.zeros(_HIDDEN), "out": r.normal(0, _HIDDEN ** -0.5, _HIDDEN), "out_b": np.zeros(1)}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.slope, self.shift, self.threshold = 1.0, 0.0, 0.5

    def _forward(self, x: np.ndarray):
        p = self.p
        e = p["emb"][x]
        cols = np.concatenate([e[:, i:_LEN - _WIDE + 1 + i] for i in range(_WIDE)], axis=2)
        c = np.maximum(cols @ p["conv"] + p["conv_b"], 0)
        top = c.argmax(1)
        pooled = np.concatenate([np.take_along_axis(c, top[:, None], 1)[:, 0], c.mean(1)], axis=1)
        h = np.maximum(pooled @ p["hid"] + p["hid_b"], 0)
        return h @ p["out"] + p["out_b"][0], (cols, c, top, pooled, h)

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> dict:
        p = self.p
        z, (cols, c, top, pooled, h) = self._forward(x)
        dz = ((1 / (1 + np.exp(-z)) - y) / len(y)).astype(np.float32)
        g = {"out": h.T @ dz, "out_b": dz.sum(keepdims=True)}
        dh = np.outer(dz, p["out"]) * (h > 0)
        g["hid"], g["hid_b"] = pooled.T @ dh, dh.sum(0)
        dp = dh @ p["hid"].T
        dc = np.repeat(dp[:, None, _FILTERS:] / c.shape[1], c.shape[1], axis=1)
        rows = np.arange(len(x))[:, None]
        dc[rows, top, np.arange(_FILTERS)[None]] += dp[:, :_FILTERS]
        dc *= c > 0
        g["conv"] = np.einsum("nlw,nlf->wf", cols, dc, optimize=True)
        g["conv_b"] = dc.sum((0, 1))
        dcols = dc @ p["conv"].T
        de = np.zeros((*x.shape, _EMBED), np.float32)
        for i in range(_WIDE):
            de[:, i:_LEN - _WIDE + 1 + i] += dcols[:, :, i * _EMBED:(i + 1) * _EMBED]
        g["emb"] = np.stack([np.bincount(x.ravel(), de[..., k].ravel(), 256) for k in range(_EMBED)], 1)
        return g

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int, seed: int, rate: float = 0.01, batch: int = 128) -> None:
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(w) for k, w in self.p.items()}
        t = 0
        for _ in range(epochs):
            order = r.permutation(len(x))
            for at in range(0, len(x), batch):
                t += 1
                i = order[at:at + batch]
                for k, g in self._gradients(x[i], y[i]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    step = rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
                    self.p[k] = (self.p[k] - step).astype(np.float32)

    def calibrate(self, found: list[tuple[str, int, int]], y: np.ndarray, recall: float) -> None:
        """Platt scaling on held-out findings, and the highest threshold that
        finds ``recall`` of their secrets."""
        z = self.highest(found)
        a, b = 1.0, 0.0
        for _ in range(25):                           # Newton steps, with a small pull to the start
            q = 1 / (1 + np.exp(-(a * z + b)))
            g = np.array([((q - y) * z).sum() + (a - 1), (q - y).sum() + b])
            w = q * (1 - q)
            hess = np.array([[(w * z * z).sum() + 1, (w * z).sum()], [(w * z).sum(), w.sum() + 1]])
            a, b = np.array([a, b]) - np.linalg.solve(hess, g)
        self.slope, self.shift = float(a), float(b)
        hit = np.sort(self.calibrated(z[y == 1]))
        self.threshold = float(hit[int((1 - recall) * len(hit))])

    def calibrated(self, z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * z + self.shift)))

    def highest(self, found: list[tuple[str, int, int]]) -> np.ndarray:
        """The highest logit among the windows of each candidate (text, start,
        end), a bounded number of windows at a time."""
        out = np.full(len(found), -np.inf)
        every = ((k, window(t, s, e, at)) for k, (t, s, e) in enumerate(found) for at in starts(s, e))
        for some in batched(every, 512):
            np.maximum.at(out, [k for k, _ in some], self._forward(np.stack([w for _, w in some]))[0].astype(np.float64))
        return out

    def score_spans(self, found: list[tuple[str, int, int]]) -> np.ndarray:
        """Calibrated scores of candidates."""
        return self.calibrated(self.highest(found))

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated scores of windows, a bounded number at a time."""
        z = [self._forward(x[i:i + 512])[0] for i in range(0, len(x), 512)]
        z = np.concatenate(z).astype(np.float64) if z else np.zeros(0)
        return 1 / (1 + np.exp(-(self.slope * z + self.shift)))


# --- labelled findings -----------------------------------------------------

def _finding(r: random.Random) -> tuple[str, int, int, int]:
    """One labelled finding: its text, the candidate's span, 1 for a secret."""
    alnum, lower = string.ascii_letters + string.digits, string.ascii_lowercase
    pick = lambda chars, n: "".join(r.choice(chars) for _ in range(n))
    word = lambda: pick(lower, r.randint(2, 9))
    secret = r.random() < 0.5
    if secret:
        body = r.choice([
            lambda: pick("0123456789abcdef", r.choice((32, 40, 64))), lambda: pick(alnum + "+/", r.choice((24, 40, 44))),
            lambda: "ghp_" + pick(alnum, 36), lambda: "sk_live_" + pick(alnum, 24), lambda: "sk-" + pick(alnum, 40),
            lambda: "xoxb-" + pick(string.digits, 11) + "-" + pick(alnum, 24), lambda: "AIza" + pick(alnum + "_-", 35),
            lambda: "glpat-" + pick(alnum + "_-", 20), lambda: "AKIA" + pick(string.ascii_uppercase + string.digits, 16),
            lambda: "eyJ" + pick(alnum, 20) + "." + pick(alnum + "_-", 30) + "." + pick(alnum + "_-", 30),
            lambda: "-----BEGIN RSA PRIVATE KEY-----\n" + pick(alnum + "+/", 64) + "\n-----END RSA PRIVATE KEY-----"])()
    else:
        n = lambda a, b: str(r.randint(a, b))
        body = r.choice([
            lambda: f"IMG_20{n(10, 29)}{n(10, 12)}{n(10, 28)}_{n(100000, 235959)}.{r.choice(('jpg', 'png', 'jpeg'))}",
            lambda: f"20{n(10, 29)}-{n(10, 12)}-{n(10, 28)}T{n(10, 23)}:{n(10, 59)}".replace(":", "-") + f"-{n(10, 59)}.{n(100, 999)}Z",
            lambda: f"{word()}-{word()}-{n(0, 9)}.{n(0, 30)}.{n(0, 9)}-{r.choice(('beta', 'rc1', 'linux'))}.tar.gz",
            lambda: "-".join([word() for _ in range(r.randint(2, 4))] + [n(1, 3000), word(), word()]),
            lambda: "_".join([word() for _ in range(r.randint(2, 4))] + [word() + n(1, 99), word(), word()]),
            lambda: f"www.{word()}{word()}.example.{word()}/20{n(10, 29)}/{n(1, 12)}/{word()}-{word()}",
            lambda: f"{word()}.{word()}.{word()}{n(1, 99)}.example.com", lambda: word() + n(1, 9) + word() + word() + word() + word(),
            lambda: "/".join(["usr", word(), word() + n(1, 9), word(), word() + ".py"]),
            lambda: r.choice("abcx") * r.randint(12, 20) + r.choice("019") * r.randint(8, 12),
            lambda: "".join(w.capitalize() for w in (word(), word(), word(), word())) + n(1, 99)])()
    prose = " ".join(word() for _ in range(5))
    lead = r.choice([prose + " ", prose + ".\n", word() + ' = "', word() + ": ", r.choice(("key=", "auth: ", "Bearer ", "credential = '", "export SECRET=")) if secret or r.random() < 0.2 else "see ", ""])
    tail = r.choice([" " + prose, '"\n', ".", ", " + word(), "###", "", "'"])
    return lead + body + tail, len(lead), len(lead) + len(body), int(secret)


def _longer(r: random.Random) -> tuple[str, int, int, int, int]:
    """A labelled finding behind others that are none, joined as in addresses,
    paths and key=value chains; also where its last part starts."""
    alnum, lower = string.ascii_letters + string.digits, string.ascii_lowercase
    pick = lambda chars, n: "".join(r.choice(chars) for _ in range(n))
    parts = [pick(lower, r.randint(3, 9)) for _ in range(r.randint(2, 12))] + [pick(string.ascii_uppercase, 1) + pick(string.digits, r.randint(1, 8))]
    r.shuffle(parts)
    head = "".join(w + r.choice("/./-_") for w in parts) + r.choice(("", "id=", "key="))
    text, s, e, secret = _finding(r)
    while "\n" in text[s:e] or " " in text[s:e]:
        text, s, e, secret = _finding(r)
    lead = r.choice(("https://", "see ", '"', ""))
    return lead + head + text[s:], len(lead), len(lead) + len(head) + e - s, secret, len(lead) + len(head)


@lru_cache(maxsize=4)
def trained(examples: int = 6000, recall: float = 0.95, epochs: int = 4, seed: int = 42) -> CharNet:
    """The network, trained once per process on ``examples`` labelled findings, and on half as many
    that stand behind other parts. Of a secret's windows, those with none of it are look-alikes, and
    those with less than 16 of its characters aren't used."""
    r = random.Random(seed)
    found = [(*x, x[1]) for x in (_finding(r) for _ in range(examples))]
    more = [_longer(r) for _ in range(examples // 2)]
    cut, far = 3 * len(found) // 4, 3 * len(more) // 4
    x, y = [], []
    for t, s, e, secret, inner in found[:cut] + more[:far]:
        for at in starts(s, e):
            seen = min(e, at + _BODY) - max(inner, at)
            if not secret or seen <= 0 or seen >= min(16, e - inner):
                x.append(window(t, s, e, at))
                y.append(int(secret and seen > 0))
    net = CharNet(seed)
    net.train(np.stack(x), np.array(y), epochs, seed)
    held = found[cut:] + more[far:]
    net.calibrate([h[:3] for h in held], np.array([h[3] for h in held]), recall)
    return net


# --- the operator ----------------------------------------------------------

_SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"
_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def masked(text: str, spans: list, mask: str = "[SECRET]") -> str:
    """``text`` with the union of the spans replaced by ``mask``."""
    out, at = [], 0
    for _, s, e, *_ in sorted(spans, key=lambda x: (x[1], x[2])):
        if s >= at:
            out += [text[at:s], mask]
        at = max(at, e)
    return "".join(out) + text[at:]


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", examples: int = 6000,
         recall: float = 0.95, carry: bool = False) -> DataFrame:
    """(id, base, spans, masked) of every row of ``df``: base findings and all findings, each an
    array of (kind, start, end, score) by start, then kind in the order of :data:`KINDS`; offsets
    are code points, the end exclusive. ``masked`` is the text with all findings replaced, null if
    there are none.

    Null and empty texts have no findings; a null id stays null; repeated rows are returned as often
    as they come; an empty table gives an empty result; other columns are not read. With ``carry`` the
    whole input row comes along as struct ``row`` instead of the id."""
    net = trained(examples, recall)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        base = [base_spans(t) for t in texts]
        both = [b + other_candidates(t, b) for t, b in zip(texts, base)]
        where = [(t, s, e) for t, spans in zip(texts, both) for _, s, e in spans]
        scores = iter(net.score_spans(where))
        by = lambda x: (x[1], _ORDER[x[0]])
        firm, found = [], []
        for b, spans in zip(base, both):
            scored = [(*x, float(next(scores))) for x in spans]
            firm.append(sorted(scored[:len(b)], key=by))
            found.append(sorted(scored[:len(b)] + [x for x in scored[len(b):] if x[3] >= net.threshold], key=by))
        column = lambda rows: pa.array([[dict(zip(("kind", "start", "end", "score"), x)) for x in r] for r in rows], _TYPE)
        text = pa.array([masked(t, s) if s else None for t, s in zip(texts, found)], pa.string())
        return pa.RecordBatch.from_arrays([batch.column(0), column(firm), column(found), text],
                                          [batch.schema.field(0).name, "base", "spans", "masked"])

    if carry:
        src = df.select(F.struct("*").alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))
    else:
        src = df.select(*id_text(id_col, text_col))
    return map_texts(src, run, with_fields(src.schema.fields[0], f"base {_SPANS}, spans {_SPANS}, masked string"))


def redact(df: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", **settings) -> DataFrame:
    """Every row of ``df``, its findings masked; ``length_col`` of a changed text is counted anew."""
    found = scan(df, text_col=text_col, carry=True, **settings)
    cols = []
    for c in df.columns:
        col = F.col(f"row.`{c}`")
        if c == text_col:
            col = F.coalesce(F.col("masked").cast(df.schema[c].dataType), col)
        elif c == length_col:
            col = F.when(F.col("masked").isNotNull(), F.length("masked").cast(df.schema[c].dataType)).otherwise(col)
        cols.append(col.alias(c))
    return found.select(*cols)
