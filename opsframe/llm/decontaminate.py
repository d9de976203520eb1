"""Benchmark decontamination by latent semantic retrieval.

1. Texts are words without case and punctuation, hashed; a word's feature is its hash modulo DIM. A passage is
   PASSAGE words; document frequencies are counted over the disjoint passages of all documents.
2. The latent space is the randomised SVD of the TF-IDF matrix A of all disjoint passages of all documents (unit
   rows): a random start, one power step A'(A Q), then the Rayleigh-Ritz step on (A Q)'(A Q), each a distributed
   product whose parts are summed by Spark. The matrix is DIM x (RANK + MORE) whatever the corpus. The space is
   whitened, so that no direction outweighs others.
3. Every document is searched in whole: passages of PASSAGE words at every half passage, against passages of
   all benchmark items, by cosine from COSINE on. A passage with less than COVER of its squared TF-IDF weight in
   words of any item has a TF-IDF cosine below the root of that with all of them and is not looked up; nor is
   a pair followed with less than OVERLAP in words of the item itself. Benchmark items go in slices of SLICE
   passages, so what is sent to tasks is bounded; more slices are more passes.
   An item shorter than a passage would be lost among the words around it: beside the latent search, items of
   SHORTEST to PASSAGE - 1 words are looked up as runs of exactly their words, in every place of every document.
4. A candidate is checked in the document's words around it: the longest common subsequence with the item's
   words must reach SAME of the item, or - a paraphrase - LOOSE of it with at least ANSWER of the item's last
   quarter, its answer, in order.

Null texts have no words. Items without words match nothing. Rows that share an id are searched separately and
may repeat a link. Empty tables give no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsframe.llm.common import grams, saved, small_batches, word_blocks

DIM = 1 << 14
PASSAGE = 16
RANK, MORE = 64, 8
BLOCK = 1 << 16
TASK, TASKS = 400_000, 1024
COSINE, COVER, OVERLAP = 0.55, 0.5, 0.4
SLICE = 4096
SAME, LOOSE, ANSWER = 0.8, 0.65, 0.9
SHORTEST = 4
PARTS = 32


def words(texts: list[str | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    return word_blocks([None if x is None else x.lower().encode("utf-8", "surrogatepass") for x in texts], "plain")


def feature_rows(h: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows of width features, DIM where a text's last row is not full; first row of each text)."""
    n = np.diff(at)
    per = -(-n // width)
    first = np.zeros(len(n) + 1, np.int64)
    np.cumsum(per, out=first[1:])
    out = np.full(first[-1] * width, DIM, np.int32)
    place = np.arange(len(h)) + np.repeat(first[:-1] * width - at[:-1], n)
    out[place] = (h & np.uint64(DIM - 1)).astype(np.int32)
    return out.reshape(-1, width), first


def passages(documents: DataFrame) -> DataFrame:
    """All disjoint passages of all documents, saved: rows of up to BLOCK passages, two bytes a feature."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            for _, _, h, at in words(b.column(0).to_pylist()):
                rows = feature_rows(h, at, PASSAGE)[0].astype("<u2")
                for i in range(0, len(rows), BLOCK):
                    yield pa.RecordBatch.from_arrays([pa.array([rows[i : i + BLOCK].tobytes()], pa.binary())], ["rows"])

    return saved(documents.select("text").mapInArrow(cut, "rows binary"), "passages")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The passages of a task, about BLOCK to twice as many at a time."""
    held, n = [], 0
    for b in small_batches(batches, 1):
        held.append(np.frombuffer(b.column(0)[0].as_py(), "<u2").reshape(-1, PASSAGE))
        n += len(held[-1])
        if n >= BLOCK:
            yield np.concatenate(held)
            held, n = [], 0
    if n:
        yield np.concatenate(held)


def passage_frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """In how many passages each feature occurs, and how many passages there are."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(DIM + 1, np.int64), 0
        for block in _blocks(batches):
            block = np.sort(block, axis=1)
            fresh = np.ones(block.shape, bool)
            fresh[:, 1:] = block[:, 1:] != block[:, :-1]
            total += np.bincount(block[fresh], minlength=DIM + 1)
            n += len(block)
        total[DIM] = n
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIM + 1)), pa.array(total)], ["feature", "n"])

    out = np.zeros(DIM + 1, np.int64)
    for f, n in rows.mapInArrow(counted, "feature long, n long").groupBy("feature").sum("n").collect():
        out[f] = n
    return out[:DIM], int(out[DIM])


def _weights(rows: np.ndarray, idf: np.ndarray) -> np.ndarray:
    w = idf[rows]
    return w / np.maximum(np.sqrt((w * w).sum(1, keepdims=True)), 1e-9)


def _placed(rows: np.ndarray, w: np.ndarray, q: np.ndarray) -> np.ndarray:
    """A q of a block: the weighted sum of the rows of q that a passage's features name."""
    y = np.empty((len(rows), q.shape[1]), np.float32)
    for i in range(0, len(rows), 1024):
        y[i : i + 1024] = np.einsum("np,npk->nk", w[i : i + 1024], q[rows[i : i + 1024]])
    return y


def _add_back(z: np.ndarray, rows: np.ndarray, w: np.ndarray, y: np.ndarray) -> None:
    """z += A'y of a block, feature by feature."""
    order = np.argsort(rows.ravel(), kind="stable")
    f, w, of = rows.ravel()[order], w.ravel()[order], order // PASSAGE
    edge = np.flatnonzero(np.concatenate(([True], f[1:] != f[:-1], [True]))).tolist()
    for k, i, j in zip(f[edge[:-1]].tolist(), edge, edge[1:]):
        z[k] += w[i:j] @ y[of[i:j]]


def _summed(rows: DataFrame, added: Callable[[Iterator[np.ndarray]], np.ndarray], shape: tuple[int, int], kind: type, parts: int) -> np.ndarray:
    """The sum of the tasks' matrices of numbers of a kind, of which Spark sums ``parts`` slices."""
    step = shape[0] // parts

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _blocks(batches)
        for first in blocks:
            z = added(itertools.chain([first], blocks))
            yield pa.RecordBatch.from_arrays([pa.array(range(parts), pa.int32()), pa.array([z[p * step : (p + 1) * step].tobytes() for p in range(parts)], pa.binary())], ["part", "z"])

    def summed(key: tuple, t: pa.Table) -> pa.Table:
        z = sum(np.frombuffer(x.as_py(), kind).astype(np.float64) for x in t.column("z"))
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "z": pa.array([z.astype(kind).tobytes()], pa.binary())})

    out = np.zeros((parts, step, shape[1]))
    for part, z in rows.mapInArrow(sliced, "part int, z binary").groupBy("part").applyInArrow(summed, "part int, z binary").collect():
        out[part] = np.frombuffer(z, kind).reshape(step, -1)
    return out.reshape(shape)


def _with_padding(idf: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.append(idf, 0.0).astype(np.float32), np.vstack([q, np.zeros((1, q.shape[1]))]).astype(np.float32)


def power_step(rows: DataFrame, idf: np.ndarray, q: np.ndarray) -> np.ndarray:
    """A'(A q) over all passages."""
    weights, padded = _with_padding(idf, q)

    def added(blocks: Iterator[np.ndarray]) -> np.ndarray:
        z = np.zeros(padded.shape, np.float32)
        for block in blocks:
            w = _weights(block, weights)
            _add_back(z, block, w, _placed(block, w, padded))
        return z[:DIM]

    return _summed(rows, added, q.shape, np.float32, PARTS)


def projected(rows: DataFrame, idf: np.ndarray, q: np.ndarray) -> np.ndarray:
    """q'A'A q = (A q)'(A q) over all passages."""
    weights, padded = _with_padding(idf, q)

    def added(blocks: Iterator[np.ndarray]) -> np.ndarray:
        t = np.zeros((q.shape[1], q.shape[1]))
        for block in blocks:
            y = _placed(block, _weights(block, weights), padded)
            for i in range(0, len(y), 4096):
                exact = y[i : i + 4096].astype(np.float64)
                t += exact.T @ exact
        return t

    return _summed(rows, added, (q.shape[1], q.shape[1]), np.float64, 1)


def latent_space(documents: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(DIM + 1 x RANK: a feature's place in the whitened space times its inverse document frequency; the
    squares of these frequencies)."""
    rows = passages(documents)
    frequency, n = passage_frequencies(rows)
    idf = np.log((n + 1) / (frequency + 1)) + 1e-3
    # a task sends a matrix of DIM x (RANK + MORE), so tasks take TASK passages at least where there are many
    tasks = min(max(-(-n // TASK), rows.sparkSession.sparkContext.defaultParallelism), TASKS)
    rows = rows.coalesce(tasks)
    q = np.linalg.qr(power_step(rows, idf, np.random.default_rng(17).standard_normal((DIM, RANK + MORE))))[0]
    t = projected(rows, idf, q)
    values, vectors = np.linalg.eigh((t + t.T) / 2)
    best = np.argsort(-values)[:RANK]
    best = best[values[best] > 1e-6 * max(values.max(), 1e-12)]
    place = (q @ vectors[:, best]) / np.sqrt(values[best]) * idf[:, None]
    return np.vstack([place, np.zeros((1, place.shape[1]))]).astype(np.float32), np.append(idf * idf, 0.0).astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-9)


@dataclass
class Items:
    """A slice of benchmark items: ids, word hashes, and the places of their passages."""

    ids: list[int]
    hashes: list[np.ndarray]
    places: np.ndarray  # passages x rank, unit length
    of: np.ndarray  # item of each passage
    held: np.ndarray  # items x features: which they hold


def benchmark_items(rows: list[tuple[int, str | None]], space: np.ndarray) -> Items:
    ids, hashes, places, of = [], [], [], []
    for _, _, h, at in words([r[1] for r in rows]):
        for k in range(len(at) - 1):
            w = h[at[k] : at[k + 1]]
            ids.append(rows[len(hashes)][0])
            hashes.append(w.copy())
            if len(w):
                f = space[(w & np.uint64(DIM - 1)).astype(np.int64)]
                for s in sorted({*range(0, len(w) - PASSAGE + 1, PASSAGE // 2), max(0, len(w) - PASSAGE)}):
                    places.append(f[s : s + PASSAGE].sum(0))
                    of.append(len(hashes) - 1)
    unit = _unit(np.array(places, np.float32).reshape(len(places), space.shape[1]))
    held = np.zeros((len(ids), DIM + 1), bool)
    for k, w in enumerate(hashes):
        held[k, (w & np.uint64(DIM - 1)).astype(np.int64)] = True
    return Items(ids, hashes, unit, np.array(of, np.int64), held)


def common_subsequence(masks: dict[int, int], n: int, window: list[int]) -> int:
    """Length of the longest common subsequence, by bits of one number per word of the window."""
    full = (1 << n) - 1
    v = full
    for w in window:
        u = v & masks.get(w, 0)
        if u:
            v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def _masks(w: np.ndarray) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, x in enumerate(w.tolist()):
        out[x] = out.get(x, 0) | 1 << i
    return out


def short_runs(items: Items) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length: hashes of the short items' word runs, sorted, and the items (equal items one after the other)."""
    out: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for n in sorted({len(w) for w in items.hashes if SHORTEST <= len(w) < PASSAGE}):
        k = np.array([i for i, w in enumerate(items.hashes) if len(w) == n])
        g = np.array([grams(items.hashes[i], n)[0] for i in k], np.uint64)
        order = np.argsort(g, kind="stable")
        out[n] = g[order], k[order]
    return out


def search(documents: DataFrame, items: Items, space: np.ndarray, weight: np.ndarray, id_col: str = "doc_id") -> DataFrame:
    """doc_id, item_id, cosine, same, answer, start_word of every leak of the items into documents."""
    kind = dict(documents.dtypes)[id_col]
    half, rank = PASSAGE // 2, space.shape[1]
    columns = ["doc_id", "item_id", "cosine", "same", "answer", "start_word"]

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = [_masks(w) for w in items.hashes]
        tails = [_masks(w[len(w) - -(-len(w) // 4) :]) for w in items.hashes]
        sets = [np.unique(w) for w in items.hashes]
        runs = short_runs(items)
        vocabulary = items.held.any(0)
        vocabulary[DIM] = False

        def check(w: np.ndarray, k: int, start: int) -> tuple[float, float]:
            n = len(items.hashes[k])
            window = w[max(0, start - n) : start + PASSAGE + n]
            known = np.isin(window, sets[k])
            if len(np.unique(window[known])) < LOOSE * len(sets[k]) - 1e-9:
                return 0.0, 0.0
            seen = window[known].tolist()
            tail = -(-n // 4)
            return common_subsequence(masks[k], n, seen) / n, common_subsequence(tails[k], tail, seen) / tail

        for b in small_batches(batches):
            ids = b.column(0).to_pylist()
            found: list[tuple] = []
            for i, _, h, at in words(b.column(1).to_pylist()):
                if not len(h) or not len(items.of) or not rank:
                    continue
                halves, first = feature_rows(h, at, half)
                # a passage is a half and the next one of its text; a text's last half is a passage if it is alone
                n = np.diff(first)
                ends = first[1:][n > 1] - 1
                follow = np.ones(len(halves), bool)
                follow[ends] = False
                follow[first[:-1][n == 1]] = False
                heads = np.flatnonzero(follow | np.repeat(n == 1, n))
                nexts = np.where(follow[heads], heads + 1, len(halves))
                inside = np.append((weight * vocabulary)[halves].sum(1), 0.0)
                every = np.append(weight[halves].sum(1), 0.0)
                covered = inside[heads] + inside[nexts] >= COVER * (every[heads] + every[nexts])
                heads, nexts = heads[covered], nexts[covered]
                halves = np.vstack([halves, np.full((1, half), DIM, np.int32)])
                text_of = np.repeat(np.arange(len(n)), n)
                best: dict[tuple[int, int], tuple] = {}
                for size, (known, of) in runs.items():
                    g = grams(h, size)
                    hit = np.flatnonzero(np.isin(g, known))
                    owner = np.searchsorted(at, hit, "right") - 1
                    hit, owner = hit[hit + size <= at[owner + 1]], owner[hit + size <= at[owner + 1]]  # not across two texts
                    for p, t in zip(hit.tolist(), owner.tolist()):
                        for z in range(int(np.searchsorted(known, g[p], "left")), int(np.searchsorted(known, g[p], "right"))):
                            best.setdefault((t, int(of[z])), (ids[i + t], items.ids[of[z]], 1.0, 1.0, 1.0, p - int(at[t])))
                for c in range(0, len(heads), 4096):
                    head = heads[c : c + 4096]
                    rows = np.concatenate([halves[head], halves[nexts[c : c + 4096]]], 1)
                    near = _unit(space[rows].sum(1)) @ items.places.T
                    x, y = np.nonzero(near >= COSINE)
                    cosines = near[x, y]
                    # the best of an item's passages, then what of the passage's weight is in the item's words
                    order = np.lexsort((-cosines, items.of[y], x))
                    x, k, cosines = x[order], items.of[y][order], cosines[order]
                    fresh = np.ones(len(x), bool)
                    fresh[1:] = (x[1:] != x[:-1]) | (k[1:] != k[:-1])
                    x, k, cosines = x[fresh], k[fresh], cosines[fresh]
                    w2 = weight[rows]
                    shared = np.empty(len(x))
                    for p in range(0, len(x), 1 << 16):
                        q = slice(p, p + (1 << 16))
                        shared[q] = (w2[x[q]] * items.held[k[q, None], rows[x[q]]]).sum(1)
                    good = shared >= OVERLAP * w2.sum(1)[x]
                    for r, item, cosine in zip(x[good].tolist(), k[good].tolist(), cosines[good].tolist()):
                        t = int(text_of[head[r]])
                        old = best.get((t, item))
                        if old and old[3] >= SAME:
                            continue
                        start = int(head[r] - first[t]) * half
                        same, answer = check(h[at[t] : at[t + 1]], item, start)
                        if same >= SAME or same >= LOOSE and answer >= ANSWER:
                            row = (ids[i + t], items.ids[item], cosine, same, answer, start)
                            if not old or same > old[3]:
                                best[t, item] = row
                found += best.values()
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[n] for f in found], b.column(0).type if n == 0 else pa.int64() if n in (1, 5) else pa.float64()) for n in range(6)], columns)

    return documents.select(F.col(id_col).alias("doc_id"), "text").mapInArrow(
        searched, f"doc_id {kind}, item_id long, cosine double, same double, answer double, start_word long")


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Every (document, benchmark item) pair in which the item's passage occurs, also paraphrased."""
    space, weight = latent_space(documents)
    rows = sorted(((r[0], r[1]) for r in benchmark.select(F.col("item_id").cast("long"), "text").collect()), key=lambda r: (r[0] is None, r[0], r[1] or ""))
    slices, size = [[]], 0
    for r in rows:
        n = -(-len((r[1] or "").split()) * 2 // PASSAGE) + 1
        if size + n > SLICE and slices[-1]:
            slices.append([])
            size = 0
        slices[-1].append(r)
        size += n
    out = None
    for s in slices:
        part = search(documents, benchmark_items(s, space), space, weight)
        out = part if out is None else out.unionByName(part)
    return out
