"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are 2- and 3-grams of the lower-cased text, in which every run of characters that are no letters
counts as one space; they are hashed to DIM slots. A slot's weight in a text is its share of the text's
n-grams times its inverse document frequency, counted over all training texts. The regression is trained
by follow-the-regularised-leader (proximal, per coordinate) with elastic-net penalties on a sample of at
most about SAMPLE texts - each label's share is bounded, the draw goes by a hash of the id - and one in
five of these is set aside to fit a temperature, whole and as short cuts of CUTS characters, since whole texts alone
are told apart without error and would make every score 1. Scores are calibrated probabilities of the label
returned. The model's floor is the least score of the set-aside whole texts but one in FLOOR, and at most ABOVE
times what chance gives: a text below it is in none of the languages, one in two of them is not rejected.

Scores are sums over n-grams, so whole texts of any length are read in blocks. Null texts and texts without
a letter are ``und`` with score 0. Rows with a null or empty label train nothing; null ids count as training
rows. Without any labelled text every text is ``und``. Ties between labels go to the first in order.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsframe.llm.common import small_batches

DIM = 1 << 15
SAMPLE = 6000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.02
SCALE = 30.0
CHUNK = 1 << 19
CUTS = (6, 15, 40)
FLOOR, ABOVE = 500, 1.25

_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def slots(texts: list[str | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, past the last, n-gram slots, where each text's slots begin), a few texts at a time;
    2- and 3-grams that start at the same character stand side by side."""
    i, is_letter = 0, letters()
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j] or "") < CHUNK):
            size += len(texts[j] or "")
            j += 1
        parts, at = [], np.zeros(j - i + 1, np.int64)
        for n, x in enumerate(texts[i:j]):
            codes = np.frombuffer((x or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
            word = is_letter[codes]
            keep = word.copy()
            keep[1:] |= word[:-1]  # the first of each run of others stays, as a space
            codes = np.where(word, codes, 32)[keep]
            if word.any():
                codes = np.concatenate(([32], codes, [32, 32])).astype(np.uint32)
                a, b, c = codes[:-2], codes[1:-1], codes[2:]
                two = (a * np.uint32(0x9E3779B1)) ^ (b * np.uint32(0x85EBCA77))
                three = (two ^ np.uint32(0x27D4EB2F)) * np.uint32(0xC2B2AE3D) + c * np.uint32(0x165667B1)
                both = np.stack([two, three], 1).ravel()
                both ^= both >> np.uint32(15)
                both *= np.uint32(0x2C1B3C6D)
                both ^= both >> np.uint32(13)
                parts.append(both & np.uint32(DIM - 1))
                at[n + 1] = len(both)
        np.cumsum(at, out=at)
        yield i, j, np.concatenate(parts) if parts else np.zeros(0, np.uint32), at
        i = j


@dataclass
class Model:
    labels: list[str]
    idf: np.ndarray  # DIM
    weights: np.ndarray  # DIM x labels
    bias: np.ndarray
    temperature: float
    floor: float = 0.0

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        names, scores = [], np.zeros(len(texts))
        table = (self.weights * (self.idf * SCALE)[:, None]).astype(np.float32)
        for i, j, ids, at in slots(texts):
            n = np.diff(at)
            some = np.flatnonzero(n)
            sums = np.zeros((j - i, len(self.labels)))
            if len(some) and self.labels:
                sums[some] = np.add.reduceat(table[ids], at[some], axis=0) / n[some, None]
            p = softmax((sums + self.bias) / self.temperature) if self.labels else np.zeros((j - i, 1))
            best = p.argmax(1)
            for k in range(j - i):
                known = n[k] > 0 and bool(self.labels)
                names.append(self.labels[best[k]] if known else "und")
                scores[i + k] = p[k, best[k]] if known else 0.0
        return names, scores


@dataclass
class Examples:
    """Drawn texts as Arrow columns; a text's numbers are copied only while they are used."""

    table: pa.Table
    idf: np.ndarray
    labels: list[str]
    rows: list[int] = field(default_factory=list)

    def numbers(self, column: str, k: int, kind: str) -> np.ndarray:
        return np.frombuffer(self.table.column(column)[k].as_buffer(), kind)

    def size(self, k: int) -> int:
        return len(self.numbers("slots", k, "<u4"))

    def in_order(self) -> list[int]:
        """By id (null last), label and slots."""
        ids, names = (self.table.column(c).to_pylist() for c in ("id", "label"))
        known = lambda k: (ids[k] is None, ids[k], names[k])
        return [k for _, same in groupby(sorted(range(len(ids)), key=known), known) for k in sorted(same, key=lambda k: self.table.column("slots")[k].as_py())]

    def one(self, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        ids = self.numbers("slots", k, "<u4").astype(np.int64)
        return ids, self.numbers("shares", k, "<f4") * self.idf[ids] * SCALE, self.labels.index(self.table.column("label")[k].as_py())

    def whole_and_cuts(self, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        ids, x, label = self.one(k)
        yield ids, x, label
        cuts, begin = self.numbers("cuts", k, "<u4").astype(np.int64), 0
        for size in CUTS:
            part = cuts[begin : begin + 2 * size]
            yield part, self.idf[part] * SCALE / len(part), label
            begin += 2 * size

    def of(self, rows: list[int]) -> Examples:
        return Examples(self.table, self.idf, self.labels, rows)

    def __len__(self) -> int:
        return len(self.rows)

    def __getitem__(self, n: int) -> tuple[np.ndarray, np.ndarray, int]:
        """The n-th row to learn from, with the bias as its last slot."""
        ids, x, label = self.one(self.rows[n])
        return np.append(ids, DIM), np.append(x, 1.0), label


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def ftrl(rows: Sequence[tuple[np.ndarray, np.ndarray, int]] | Examples, n_labels: int) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal for softmax regression; rows: (slots, values, label). The last slot is the bias."""
    z, n = np.zeros((DIM + 1, n_labels)), np.zeros((DIM + 1, n_labels))

    def solved(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for k in order.permutation(len(rows)):
            ids, x, label = rows[k]
            w = solved(z[ids], n[ids])
            p = softmax((x @ w)[None, :])[0]
            p[label] -= 1.0
            g = x[:, None] * p[None, :]
            before = n[ids]
            after = before + g * g
            z[ids] += g - (np.sqrt(after) - np.sqrt(before)) / ALPHA * w
            n[ids] = after
    w = solved(z, n)
    return w[:DIM], w[DIM]


def temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """Of a grid, the temperature with the least negative log likelihood on the texts set aside."""
    if not len(labels):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
    loss = [-np.log(softmax(scores / t)[np.arange(len(labels)), labels] + 1e-12).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def train(labelled: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> Model:
    """labelled: every row that may be learned from."""
    df = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(label_col).alias("label"))
    df = df.where("text is not null and label is not null and label <> ''")
    counts = {r[0]: r[1] for r in df.groupBy("label").count().collect()}
    labels = sorted(counts)
    if not labels:
        return Model([], np.ones(DIM), np.zeros((DIM, 0)), np.zeros(0), 1.0)

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(DIM, np.int64), 0
        for b in small_batches(batches):
            for i, j, ids, at in slots(b.column(0).to_pylist()):
                for k in range(j - i):
                    mark = np.zeros(DIM, np.int8)
                    mark[ids[at[k] : at[k + 1]]] = 1
                    total += mark
                n += j - i
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIM + 1)), pa.array(np.append(total, n))], ["slot", "n"])

    df_counts = np.zeros(DIM + 1)
    for r in df.select("text").mapInArrow(seen, "slot long, n long").groupBy("slot").sum("n").collect():
        df_counts[r[0]] = r[1]
    idf = np.log((1 + df_counts[DIM]) / (1 + df_counts[:DIM])) + 1.0

    # each label gives about sample / labels rows, or all it has; a tenth more than that can't come
    share = {k: min(1.0, sample / len(labels) / v) for k, v in counts.items()}
    cut = F.lit(0).cast("long")
    for k, s in share.items():
        cut = F.when(F.col("label") == k, F.lit(int(s * 1_000_000))).otherwise(cut)
    drawn = df.where(F.pmod(F.xxhash64(F.lit(11), "id"), F.lit(1_000_000)) < cut)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, 128):
            out = []
            for i, j, ids, at in slots(b.column(1).to_pylist()):
                for k in range(j - i):
                    own = ids[at[k] : at[k + 1]]
                    u, c = np.unique(own, return_counts=True)
                    # two n-grams a character; the cuts begin somewhere in the text, by its own n-grams
                    begin = 2 * (int(own.sum(dtype=np.int64)) % max(1, len(own) // 2 - CUTS[-1])) if len(own) else 0
                    cuts = b"".join(np.resize(own[begin : begin + 2 * n], 2 * n).astype("<u4").tobytes() for n in CUTS) if len(own) else b""
                    out.append((u.astype("<u4").tobytes(), (c / max(1, c.sum())).astype("<f4").tobytes(), cuts))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array([x[n] for x in out], pa.binary()) for n in range(3)), b.column(2)], ["id", "slots", "shares", "cuts", "label"])

    got = drawn.select("id", "text", "label").mapInArrow(counted, f"id {dict(df.dtypes)['id']}, slots binary, shares binary, cuts binary, label string").toArrow()
    examples = Examples(got, idf, labels)
    order = examples.in_order()
    some = [(n, k) for n, k in enumerate(order) if examples.size(k)]
    rows, aside = examples.of([k for n, k in some if n % 5 != 4]), [k for n, k in some if n % 5 == 4]
    weights, bias = ftrl(rows, len(labels))
    judged = [(x @ weights[i] + bias, y) for k in aside for i, x, y in examples.whole_and_cuts(k)]
    scores = np.array([x for x, _ in judged]).reshape(-1, len(labels))
    truth = np.array([y for _, y in judged], int)
    model = Model(labels, idf, weights, bias, temperature(scores, truth))
    if aside:
        whole = softmax(scores[:: 1 + len(CUTS)] / model.temperature)
        best = np.sort(whole.max(1)[whole.argmax(1) == truth[:: 1 + len(CUTS)]])
        model.floor = float(min(ABOVE / len(labels), best[len(best) // FLOOR])) if len(best) else 0.0
    return model


def predict(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """df with lang_pred (string) and score (double); columns of these names are replaced."""
    df = df.drop("lang_pred", "score")
    schema = T.StructType([*df.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    place = df.columns.index(text_col)

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            names, scores = model.predict(b.column(place).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(names, pa.string()), pa.array(scores)], [*b.schema.names, "lang_pred", "score"])

    return df.mapInArrow(labelled, schema)


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def language_table(documents: DataFrame) -> DataFrame:
    model = train(documents.where(~held_out()))
    out = predict(documents.select("doc_id", held_out().alias("held_out"), "text"), model)
    return out.select("doc_id", "held_out", "lang_pred", "score")
