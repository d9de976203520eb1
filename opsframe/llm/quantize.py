"""Vector code compression: product codes by memoised grid cells.

Vectors whose value is null or holds a null or non-finite component are dropped. Each component x becomes the
integer floor(256 * x); the vector is cut into PARTS equal consecutive parts, each with a codebook of up to ENTRIES
entries, which starts as that part of the ENTRIES smallest vec_ids. ROUNDS times every part goes to its nearest
entry (squared Euclidean distance, ties to the lower index) and each used entry becomes the floor of the mean of its
parts; then parts are assigned once more.

Assignment by grid cells: a part lies in the cell of side CELL of its components' grid. Over that cell's box each
entry has a least and a greatest distance; an entry whose least distance is above another's greatest is farther than
that one everywhere in the box (dominated), so only the others can be nearest to a point of it. They are worked out
once per cell, kept in the task's memory by cell, and only they are evaluated exactly. The memory holds at most CACHED
cells a part and starts anew when it is full; this changes no result.

All arithmetic is on integers. Sums are added up inside each task first (one row a part, entry and position), then by
Spark; only the codebooks, ENTRIES times the dimension, come to the driver and go out with the tasks.

The dimension is the length of the vector of the smallest vec_id. A vector of another length, or with a component of
2**20 and more in size (whose distances would not fit a long), can't be coded: its row stays with a null code and
error. If the dimension is not divisible by PARTS no vector is coded. A null vec_id is coded and starts no entry; rows
that share an id are coded each, the least of their vectors starts one entry. Equal vectors get equal codes. Fewer ids
than ENTRIES make as many entries. An empty table gives no rows. Only the id, vector and label columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsframe.llm.common import saved, small_batches

PARTS, ENTRIES, ROUNDS = 16, 64, 2
CELL = 32
CACHED = 1 << 16
WIDEST = float(1 << 20)


def usable(vector: Column) -> Column:
    """Neither null nor with a null or non-finite component."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


class GridCells:
    """Nearest entries of one codebook (entries x width); candidates are kept by cell."""

    def __init__(self, book: np.ndarray, cell: int = CELL, cached: int = CACHED):
        self.book, self.cell, self.cached = book, cell, cached
        self.starts: dict[bytes, int] = {}
        self.clear()

    def clear(self) -> None:
        self.starts.clear()
        self.entries = np.zeros(0, np.int64)  # the cells' candidates, one after the other
        self.first = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)

    def add(self, cells: np.ndarray) -> None:
        """Candidates of further cells: the entries not dominated across the cell's box."""
        for i in range(0, len(cells), 1024):
            some = cells[i : i + 1024]
            low = some[:, None, :] * self.cell
            high = low + (self.cell - 1)
            near = np.maximum(np.maximum(low - self.book, self.book - high), 0)
            far = np.maximum(np.abs(self.book - low), np.abs(self.book - high))
            least, most = (near * near).sum(2), (far * far).sum(2)
            row, entry = np.nonzero(least <= most.min(1)[:, None])
            count = np.bincount(row, minlength=len(some))
            self.first = np.concatenate((self.first, len(self.entries) + np.cumsum(count) - count))
            self.count = np.concatenate((self.count, count))
            self.entries = np.concatenate((self.entries, entry))
            for c in some:
                self.starts[c.tobytes()] = len(self.starts)

    def places(self, cells: np.ndarray) -> np.ndarray:
        """Each row's cell in the memory; unknown cells are added."""
        rows = np.ascontiguousarray(cells).view([("", cells.dtype)] * cells.shape[1]).ravel()
        _, at, back = np.unique(rows, return_index=True, return_inverse=True)
        different = cells[at]
        keys = [c.tobytes() for c in different]
        new = [i for i, x in enumerate(keys) if x not in self.starts]
        if new and len(self.starts) + len(new) > self.cached:
            self.clear()
            new = range(len(keys))
        if len(new):
            self.add(different[list(new)])
        return np.array([self.starts[x] for x in keys], np.int64)[back]

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry (the lowest of equally near ones) and its squared distance, of each point."""
        place = self.places(points // self.cell)
        count = self.count[place]
        begin = np.cumsum(count) - count
        point = np.repeat(np.arange(len(points)), count)
        entry = self.entries[np.arange(len(point)) - begin[point] + self.first[place][point]]
        gap = points[point] - self.book[entry]
        distance = (gap * gap).sum(1)
        least = np.minimum.reduceat(distance, begin)
        index = np.minimum.reduceat(np.where(distance == least[point], entry, len(self.book)), begin)
        return index, least


def integers(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """floor(256 * x) of the vectors that can be coded, as a matrix, and which rows they are."""
    column = column.cast(pa.large_list(pa.float64()))
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    fits = sizes == dim
    at = np.flatnonzero(fits)
    matrix = values[np.repeat(fits, sizes)].reshape(len(at), dim)
    narrow = (np.abs(matrix) < WIDEST).all(1)
    return np.floor(256 * matrix[narrow]).astype(np.int64), at[narrow]


def assigned(matrix: np.ndarray, grids: list[GridCells]) -> tuple[np.ndarray, np.ndarray]:
    """Codes and squared distances, rows x parts."""
    width = matrix.shape[1] // len(grids)
    both = [g.nearest(np.ascontiguousarray(matrix[:, p * width : (p + 1) * width])) for p, g in enumerate(grids)]
    return np.stack([c for c, _ in both], 1), np.stack([d for _, d in both], 1)


def sums(vectors: DataFrame, books: np.ndarray) -> np.ndarray:
    """Count and componentwise sum (last place: the count) of the parts assigned to each entry of each part."""
    parts, entries, width = books.shape

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grids = [GridCells(b) for b in books]
        total = np.zeros((parts, entries, width + 1), np.int64)
        for b in small_batches(batches, 4096):
            matrix, _ = integers(b.column(0), parts * width)
            if len(matrix):
                codes, _ = assigned(matrix, grids)
                for p in range(parts):
                    order = np.argsort(codes[:, p], kind="stable")
                    used, at = np.unique(codes[order, p], return_index=True)
                    total[p, used, :width] += np.add.reduceat(matrix[order, p * width : (p + 1) * width], at)
                    total[p, used, width] += np.diff(np.append(at, len(order)))
        place = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total.ravel()[place])], ["place", "total"])

    out = np.zeros(parts * entries * (width + 1), np.int64)
    # at most one row per place: ENTRIES * (dimension + PARTS)
    for place, total in vectors.select("vector").mapInArrow(summed, "place long, total long").groupBy("place").agg(F.sum("total")).collect():
        out[place] = total
    return out.reshape(parts, entries, width + 1)


def first_books(kept: DataFrame, parts: int, entries: int) -> np.ndarray | None:
    """parts x entries x width: the vectors of the smallest ids, cut into parts; None if no vector can be coded."""
    ids = [r[0] for r in kept.where("id is not null").select("id").distinct().orderBy("id").limit(entries).collect()]
    if not ids:
        return None
    # one row an id, at most ENTRIES rows
    starts = kept.where(F.col("id").between(ids[0], ids[-1])).groupBy("id").agg(F.min("vector").alias("vector")).orderBy("id").collect()
    dim = len(starts[0].vector)
    matrix, _ = integers(pa.array([r.vector for r in starts], pa.list_(pa.float64())), dim)
    if dim == 0 or dim % parts or not len(matrix):
        return None
    return np.ascontiguousarray(matrix.reshape(len(matrix), parts, dim // parts).transpose(1, 0, 2))


def train(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks, parts x entries x width, from kept (id, vector)."""
    books = first_books(kept, parts, entries)
    for _ in range(rounds if books is not None else 0):
        total = sums(kept, books)
        count = total[:, :, -1:]
        books = np.where(count > 0, total[:, :, :-1] // np.maximum(count, 1), books)
    return books


def encode(kept: DataFrame, books: np.ndarray | None) -> DataFrame:
    """kept without its vector, and code (two hex digits a part) and error (squared distances added up)."""
    rest = [c for c in kept.columns if c != "vector"]
    if books is None:
        return kept.select(*rest, F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    digits = np.array([f"{i:02x}" for i in range(books.shape[1])])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grids = [GridCells(b) for b in books]
        for b in small_batches(batches, 4096):
            code, error = np.full(b.num_rows, None, object), np.full(b.num_rows, None, object)
            matrix, rows = integers(b.column("vector"), books.shape[0] * books.shape[2])
            if len(rows):
                codes, gaps = assigned(matrix, grids)
                code[rows] = ["".join(x) for x in digits[codes].tolist()]
                error[rows] = gaps.sum(1)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in rest), pa.array(code, pa.string()), pa.array(error, pa.int64())], [*rest, "code", "error"])

    types = dict(kept.dtypes)
    return kept.mapInArrow(coded, ", ".join([f"`{c}` {types[c]}" for c in rest] + ["code string", "error long"]))


def codebooks_sha256(books: np.ndarray | None) -> str:
    """Of all entries' decimal components, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist() if books is not None else [])).encode()).hexdigest()


def compress(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray | None]:
    """(id, label, code, error) of every kept vector, and the codebooks."""
    kept = (embeddings.where(usable(F.col(vector_col)))
            .select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("vector")))
    books = train(kept.select("id", "vector"), parts, entries, rounds)
    return saved(encode(kept, books), "codes"), books


def codes_digest(embeddings: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error (the errors of equal labels added up, nulls together), codebooks_sha256."""
    rows, books = compress(embeddings)
    by_label = rows.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return (rows.join(by_label, F.col("label").eqNullSafe(F.col("_label")))
            .select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(codebooks_sha256(books)).alias("codebooks_sha256")))
