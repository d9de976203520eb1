"""Small helpers shared by the operators: reading tables, shared intermediate tables, word hashes.

Words are ``[^\\x20\\x09-\\x0D]+``. Hashing works on whole blocks of bytes with numpy inside a task:
a word's hash is a polynomial in its bytes modulo 2**64 (words over 64 bytes: XXH3), then mixed.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from opsframe.session import ensure_checkpoint_dir

BLOCK = 1 << 20
LONG_WORD = 64
_BASE = 0x9E3779B97F4A7C15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared checkpoint folder and read again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixing (xor-shift and multiply), in place."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the (odd) base modulo 2**64, and their inverses."""
    inverse = pow(_BASE, -1, 1 << 64)
    out = []
    for b in (_BASE, inverse):
        p = np.full(n, np.uint64(b))
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


_tables: dict[str, np.ndarray] = {}


def _lookup() -> dict[str, np.ndarray]:
    if not _tables:
        white = np.zeros(256, bool)
        white[[9, 10, 11, 12, 13, 32]] = True
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        plain = lower.copy()  # ASCII punctuation counts as white space
        for c in range(128):
            if not chr(c).isalnum():
                plain[c] = 32
        up, down = _powers(BLOCK + 1)
        _tables.update(white=white, lower=lower, plain=plain, up=up, down=down)
    return _tables


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[starts[i]:ends[i]], block by block; never 0."""
    t, n = _lookup(), len(starts)
    out = np.zeros(n, np.uint64)
    i = 0
    while i < n:
        base = starts[i]
        j = max(int(np.searchsorted(ends, base + BLOCK, "right")), i + 1)
        if ends[j - 1] - base <= BLOCK:
            block = data[base : ends[j - 1]].astype(np.uint64)
            block += np.uint64(1)
            block *= t["up"][: len(block)]
            sums = np.zeros(len(block) + 1, np.uint64)
            np.cumsum(block, out=sums[1:])
            s = starts[i:j] - base
            out[i:j] = (sums[ends[i:j] - base] - sums[s]) * t["down"][s]
        i = j
    for k in np.flatnonzero(ends - starts > LONG_WORD):
        out[k] = xxhash.xxh3_64_intdigest(data[starts[k] : ends[k]].tobytes())
    mix(out)
    out[out == 0] = 1
    return out


def word_blocks(texts: list[bytes | None], how: str = "") -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, past the last, word hashes, where each text's words begin) for runs of texts of
    about a megabyte. how: '' as they are, 'lower' with A-Z lowered, 'plain' also without ASCII punctuation."""
    t, i = _lookup(), 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j] or b"") < BLOCK):
            size += len(texts[j] or b"") + 1
            j += 1
        data = np.frombuffer(b" ".join(x or b"" for x in texts[i:j]) + b" ", np.uint8)
        if how:
            data = t[how][data]
        white = t["white"][data]
        edge = np.flatnonzero(white[1:] != white[:-1]) + 1
        if len(white) and not white[0]:
            edge = np.concatenate(([0], edge))
        starts, ends = edge[0::2], edge[1::2]
        at = np.zeros(j - i + 1, np.int64)
        np.cumsum([len(x or b"") + 1 for x in texts[i:j]], out=at[1:])
        yield i, j, hash_spans(data, starts, ends), np.searchsorted(starts, at)
        i = j


def text_bytes(column: pa.Array) -> list[bytes | None]:
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def small_batches(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Slices of few rows, so that one task holds few texts at a time."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k consecutive values, by doubling; empty if there are fewer."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    out, done, part, width, rest = None, 0, h, 1, k
    while rest:
        if rest & 1:
            piece = part[done : done + len(h) - k + 1]
            out = piece.copy() if out is None else mix(out * np.uint64(0xD6E8FEB86659FD93) + piece)
            done += width
        rest >>= 1
        if rest:
            part = mix(part[:-width] * np.uint64(0xA0761D6478BD642F) + part[width:])
            width *= 2
    return out
