"""Personal data by candidate gradient boosting.

1. Base detectors find email addresses, IP addresses, card numbers and phone numbers of a fixed form
   (leftmost, non-overlapping per kind; a match that fails its test is dropped). Base spans are always kept.
2. High-recall generators propose more spans, which may overlap each other: numbers in other groupings,
   parts of matches, spelled-out addresses ("name (at) host dot org", in any case), addresses of eight groups
   with colons. Forms that are surely something else - dates, times, versions, ISBNs, MAC addresses, prose like
   "look at me.now" - are proposed as counter-examples only.
3. Boosted regression trees on histograms score every candidate by its form (length, digits, separators,
   groups, checksums, ranges) and context (characters at both sides, words before). They are trained on
   candidates of the base forms from a sample of at most about SAMPLE documents with candidates, labelled by
   whether the base test accepts exactly that span, on the counter-examples of each kind, and on addresses and
   numbers of the sample rewritten in their place (spelled out, without the country's part); scores are calibrated on one document in five set aside
   (Platt scaling), and a kind's threshold is the least score at which PRECISION of these is right.
4. Candidates above their kind's threshold that overlap nothing chosen before, best first, are added.

Null texts are empty. Spans are code points, end exclusive. Rows that share an id are texts of their own. An
empty table, or one without candidates, trains nothing and adds nothing to the base spans.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsframe.llm.common import small_batches

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 8000
PRECISION = 0.99
TREES, DEPTH, BINS, RATE, MIN_LEAF = 40, 3, 32, 0.2, 10

# The base forms. An address is found from its @ on, so that long runs without one cost nothing.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

# Generators beyond the base forms
_NAME, _PART, _DOT = r"(?<![\w.%+-])[A-Za-z0-9._%+-]{1,64}", r"[A-Za-z0-9-]{1,63}", r"\s?(?:\(dot\)|\[dot\]|\{dot\}|\sdot\s)\s?"
# in brackets the "at" speaks for itself; the bare word needs a spelled "dot" behind it
SPELLED = re.compile(rf"{_NAME}(?:\s?(?:\(at\)|\[at\]|\{{at\}})\s?{_PART}(?:(?:\.|{_DOT}){_PART}){{1,4}}|\s+at\s+{_PART}(?:{_DOT}{_PART}){{1,4}})", re.I)
AT = re.compile(r"[\s(\[{]at[\s)\]}]", re.I)  # implied by SPELLED, whatever the text's length and case
PROSE = re.compile(rf"{_NAME}\s+at\s+{_PART}(?:\.{_PART}){{1,4}}", re.I)
GROUPED = re.compile(r"(?<![\w.+])\(?[0-9]{2,5}\)?(?:[ ./-]\(?[0-9]{2,5}\)?){1,4}(?![\w])")
COLONS = re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![\w:])")
# Surely not personal data: dates and times, versions, ISBNs, hardware addresses
OTHER = {
    "phone": re.compile(r"(?<![0-9])(?:[12][0-9]{3}[-./ ](?:0?[1-9]|1[0-2])[-./ ](?:0?[1-9]|[12][0-9]|3[01])|(?:0?[1-9]|[12][0-9]|3[01])[-./ ](?:0?[1-9]|1[0-2])[-./ ][12][0-9]{3}|97[89][- ]?(?:[0-9][- ]?){9}[0-9])(?![0-9])"),
    "ip": re.compile(r"(?<![\w:.-])(?:[0-9A-Fa-f]{2}[:-]){5}[0-9A-Fa-f]{2}(?![\w:-])|(?:(?<=\bv)|(?<=version )|(?<=release ))[0-9]+(?:\.[0-9]+){1,3}(?![\w.])", re.I),
    "card": re.compile(r"(?<![0-9])97[89][- ]?(?:[0-9][- ]?){9}[0-9](?![0-9])"),
    "email": PROSE,
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def accepted(kind: str, s: str) -> bool:
    """The base test of a match of its kind's form."""
    if kind == "email":
        return True
    if kind == "ip":
        return all(len(p := part.lstrip("0") or "0") <= 3 and int(p) <= 255 for part in s.split("."))
    digits = NOT_DIGIT.sub("", s)
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15


def forms(text: str) -> Iterator[tuple[str, int, int]]:
    """Matches of the base forms, tested or not."""
    if "@" in text:
        last = 0
        at = text.find("@")
        while at >= 0:
            m = DOMAIN.match(text, at)
            start = at
            while m and start > last and text[start - 1] in LOCAL_CHARS:
                start -= 1
            if m and start < at:
                yield "email", start, m.end()
                last = m.end()
            at = text.find("@", max(at + 1, last))
    for kind, form in (("ip", IP), ("card", CARD), ("phone", PHONE)):
        for m in form.finditer(text):
            yield kind, m.start(), m.end()


HAS_DIGIT = re.compile("[0-9]")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    return [(k, s, e) for k, s, e in forms(text) if accepted(k, text[s:e])]


def candidates(text: str) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, whether it has a base form), without repeats."""
    found = {(k, s, e): True for k, s, e in forms(text)}
    more: list[tuple[str, int, int]] = []
    for k, s, e in list(found):
        if k == "phone":  # without the country's part
            p = text.find(" ", s, e)
            if p > 0:
                more.append(("phone", p + 1, e))
        elif k == "email":
            more.append(("email", text.index("@", s) + 1, e))
    if HAS_DIGIT.search(text):
        grouped = [("phone", m.start(), m.end()) for m in GROUPED.finditer(text)]
        if grouped:
            more += clear_of(grouped, [m.span() for m in OTHER["phone"].finditer(text)])
        more += [("ip", m.start(), m.end()) for m in COLONS.finditer(text)]
    if AT.search(text):
        more += [("email", m.start(), m.end()) for m in SPELLED.finditer(text)]
    for c in more:
        found.setdefault(c, False)
    return [(*k, v) for k, v in found.items()]


def clear_of(spans: list[tuple[str, int, int]], others: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
    """The spans that overlap none of the others."""
    others = sorted(others)
    starts, reach = [s for s, _ in others], list(accumulate((e for _, e in others), max))
    out = []
    for k, s, e in spans:
        n = bisect_left(starts, e)  # others that begin before the span's end
        if not n or reach[n - 1] <= s:
            out.append((k, s, e))
    return out


SPELLINGS = (" (at) ", "(at)", " at ", "[at]", " [at] ", " AT ")


def rewritten(text: str, kind: str, start: int, end: int, n: int) -> tuple[str, int, int] | None:
    """(text around, start, end) with a base span written in another form, the n-th of a few; None without one."""
    span = text[start:end]
    if kind == "email":
        local, domain = span.rsplit("@", 1)
        at = SPELLINGS[n % len(SPELLINGS)]
        dot = at.lower().replace("at", "dot")
        if "(" in at or "[" in at:
            dot = dot if n % 4 < 2 else "."
        new = local[-64:] + at + domain.replace(".", dot)
        new = new.upper() if n % 5 == 0 else new
    elif kind == "phone" and " " in span:
        new = span[span.index(" ") + 1 :]
    else:
        return None
    before = text[max(0, start - 64) : start]
    return before + new + text[end : end + 64], len(before), len(before) + len(new)


def counter_examples(text: str) -> list[tuple[str, int, int]]:
    """Spans that are surely not personal data of the kind; none that the base test accepts."""
    out = [(k, m.start(), m.end()) for k, form in OTHER.items() for m in form.finditer(text)]
    return clear_of(out, [(s, e) for _, s, e in base_spans(text)])


CONTEXT = {  # fixed values: words before a span that speak for its kind
    "email": ("mail", "contact", "write", "correo", "adresse"), "ip": ("ip", "host", "server", "addr"),
    "card": ("card", "visa", "karte", "tarjeta", "carte", "pay"), "phone": ("tel", "phone", "call", "fax", "mobil", "fon")}


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    s = text[start:end]
    digits = NOT_DIGIT.sub("", s)
    parts = [p for p in re.split(r"[^0-9A-Za-z]+", s) if p]
    before, after = text[start - 1 : start], text[end : end + 1]
    words = text[max(0, start - 24) : start].lower()
    octets = [int(p[:9]) for p in parts if p.isdigit()] if kind == "ip" else []
    return [
        float(KINDS.index(kind)), float(len(s)), float(len(digits)), len(digits) / max(1, len(s)), float(len(parts)),
        float(max((len(p) for p in parts), default=0)), float(min((len(p) for p in parts), default=0)), float(s.count(".")), float(s.count(" ")), float(s.count("-")),
        float(s.startswith("+")), float(any(c in s for c in "([{")), float("@" in s), float(sum(c.isalpha() for c in s)), float(len(set(digits))),
        float(kind == "card" and luhn(digits)), float(max(octets, default=-1)), float(before.isalnum()), float(after.isalnum()),
        float(before in ("", " ", "\n", "\t")), float(after in ("", " ", "\n", ".", ",")), float(any(w in words for w in CONTEXT[kind])),
        float(ord(s[0]) if s else 0), float(len(parts[-1]) if parts else 0), float(sum(p.lower() == "dot" for p in parts)),
    ]


def examples(text: str, n: int) -> Iterator[tuple[str, str, int, int, int]]:
    """(text, kind, start, end, label) of a text's matches of the base forms, their rewritten forms and its counter-examples."""
    for k, s, e in {(k, s, e): True for k, s, e in forms(text)}:
        right = accepted(k, text[s:e])
        yield text, k, s, e, int(right)
        other = rewritten(text, k, s, e, n + s) if right else None
        if other:
            yield other[0], k, *other[1:], 1
    for k, s, e in counter_examples(text):
        yield text, k, s, e, 0


@dataclass
class Booster:
    """Logistic boosting of small trees over binned features, with Platt scaling and thresholds by kind."""

    cuts: list[np.ndarray] = field(default_factory=list)
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    start: float = 0.0
    platt: tuple[float, float] = (1.0, 0.0)
    thresholds: dict[str, float] = field(default_factory=dict)

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(self.cuts)], 1)

    def raw(self, bins: np.ndarray) -> np.ndarray:
        out = np.full(len(bins), self.start)
        rows = np.arange(len(bins))
        for feature, cut, value in self.trees:
            node = np.zeros(len(bins), int)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (bins[rows, feature[node]] > cut[node])
            out += value[node]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(x) or not self.trees:
            return np.zeros(len(x))
        a, b = self.platt
        return 1 / (1 + np.exp(-(a * self.raw(self.binned(x)) + b)))

    def fit(self, x: np.ndarray, y: np.ndarray) -> None:
        self.cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        bins = self.binned(x)
        p = min(max(y.mean(), 1e-3), 1 - 1e-3)
        self.start = math.log(p / (1 - p))
        out = np.full(len(y), self.start)
        for _ in range(TREES):
            q = 1 / (1 + np.exp(-out))
            tree = self.grow(bins, y - q, q * (1 - q) + 1e-6)
            self.trees.append(tree)
            feature, cut, value = tree
            node = np.zeros(len(y), int)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (bins[np.arange(len(y)), feature[node]] > cut[node])
            out += value[node]

    def grow(self, bins: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        inner, size = (1 << DEPTH) - 1, (1 << (DEPTH + 1)) - 1
        feature, cut, value = np.zeros(size, int), np.full(size, BINS + 1), np.zeros(size)
        node = np.zeros(len(g), int)
        for n in range(size):
            rows = np.flatnonzero(node == n)
            gs, hs = g[rows].sum(), h[rows].sum()
            value[n] = RATE * gs / (hs + 1.0) if len(rows) else value[(n - 1) // 2] if n else 0.0
            if n >= inner:
                continue
            best = (1e-6, 0, BINS + 1)
            for j in range(bins.shape[1]):
                b = bins[rows, j]
                gl = np.cumsum(np.bincount(b, g[rows], BINS + 1))
                hl = np.cumsum(np.bincount(b, h[rows], BINS + 1))
                nl = np.cumsum(np.bincount(b, minlength=BINS + 1))
                gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)
                gain[(nl < MIN_LEAF) | (len(rows) - nl < MIN_LEAF)] = 0
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (gain[k], j, k)
            feature[n], cut[n] = best[1], best[2]
            right = bins[rows, feature[n]] > cut[n]
            node[rows] = 2 * n + 1 + right
        return feature, cut, value

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        raw = self.raw(self.binned(x)) if len(x) else np.zeros(0)
        a, b = 1.0, 0.0
        for _ in range(200):  # gradient steps on the logistic loss
            q = 1 / (1 + np.exp(-(a * raw + b)))
            d = q - y
            if len(y):
                a -= 0.1 * float((d * raw).mean())
                b -= 0.1 * float(d.mean())
        self.platt = (a, b)
        q = self.score(x)
        for n, kind in enumerate(KINDS):
            of = x[:, 0] == n if len(x) else np.zeros(0, bool)
            order = np.argsort(-q[of], kind="stable")
            right = np.cumsum(y[of][order]) / np.arange(1, of.sum() + 1) if of.any() else np.zeros(0)
            good = np.flatnonzero(right >= PRECISION)
            self.thresholds[kind] = max(0.5, float(q[of][order][good[-1]])) if len(good) else 2.0


def train(documents: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Booster:
    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text rlike '[0-9@]'")
    n = docs.count()
    share = min(1_000_000, int(1e6 * sample / max(1, n)))
    drawn = docs.where(F.pmod(F.xxhash64(F.lit(5), "id", F.substring("text", 1, 64)), F.lit(1_000_000)) < share)
    width = len(features("", "email", 0, 0))

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            rows, labels, fold = [], [], []
            for text in b.column(0).to_pylist():
                f = hashlib.md5(text.encode("utf-8", "surrogatepass")).digest()[0] % 5
                for x, k, s, e, y in examples(text, f):
                    # with its context and alone, so that a span's form counts where the context tells nothing
                    rows += [features(x, k, s, e), features(x[s:e], k, 0, e - s)]
                    labels += [y, y]
                    fold += [f, f]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), pa.array(labels, pa.int32()), pa.array(fold, pa.int32())], ["x", "y", "fold"])

    got = drawn.select("text").mapInArrow(described, "x array<double>, y int, fold int").toArrow()
    model = Booster()
    if not got.num_rows:
        return model
    x = np.concatenate([c.flatten().to_numpy() for c in got.column("x").chunks]).reshape(-1, width)
    y, fold = got.column("y").to_numpy().astype(float), got.column("fold").to_numpy()
    order = np.lexsort([*x.T[::-1], fold])
    x, y, fold = x[order], y[order], fold[order]
    aside = fold == 4
    if (~aside).sum() >= 4 * MIN_LEAF:
        model.fit(x[~aside], y[~aside])
        model.calibrate(x[aside], y[aside])
    return model


def all_spans(text: str, model: Booster) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, all spans): base spans stay, chosen candidates that overlap none are added, best first."""
    if "@" not in text and not HAS_DIGIT.search(text) and not AT.search(text):
        return [], []
    found = candidates(text)
    base = [(k, s, e) for k, s, e, has_form in found if has_form and accepted(k, text[s:e])]
    rest = [c for c in found if not c[3]] if model.trees else []
    chosen = list(base)
    if rest:
        q = model.score(np.array([features(text, k, s, e) for k, s, e, _ in rest]))
        for n in np.argsort(-q, kind="stable"):
            k, s, e, _ = rest[n]
            if q[n] >= model.thresholds.get(k, 2.0) and all(e <= s2 or s >= e2 for _, s2, e2 in chosen):
                chosen.append((k, s, e))
    key = lambda x: (x[1], KINDS.index(x[0]), x[2])
    return sorted(base, key=key), sorted(chosen, key=key)


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find(documents: DataFrame, model: Booster, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    kind = dict(documents.dtypes)[id_col]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            counts: list[list[int]] = [[] for _ in KINDS]
            digests, spans = [], []
            for text in b.column(1).to_pylist():
                base, every = all_spans(text or "", model)
                for c, k in zip(counts, KINDS):
                    c.append(sum(x[0] == k for x in base))
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined(every))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                                             ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return documents.select(F.col(id_col), F.col(text_col)).mapInArrow(
        found, f"doc_id {kind}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")


def redact(df: DataFrame, model: Booster, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """df with every span replaced by its kind in brackets; of overlapping spans the first begun counts, and
    the others are covered by it. length_col, if given, gets the new number of code points."""
    place = df.columns.index(text_col)
    long = df.columns.index(length_col) if length_col else None

    def redacted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            texts = []
            for text in b.column(place).to_pylist():
                _, spans = all_spans(text or "", model)
                out, at = [], 0
                for k, s, e in spans:
                    if s >= at:
                        out += [text[at:s], f"[{k.upper()}]"]
                    at = max(at, e)
                texts.append("".join(out) + text[at:] if spans else text)
            columns = list(b.columns)
            columns[place] = pa.array(texts, b.column(place).type)
            if long is not None:
                columns[long] = pa.array([None if x is None else len(x) for x in texts], b.column(long).type)
            yield pa.RecordBatch.from_arrays(columns, b.schema.names)

    return df.mapInArrow(redacted, T.StructType(df.schema.fields))


def spans_table(documents: DataFrame) -> DataFrame:
    return find(documents, train(documents))
