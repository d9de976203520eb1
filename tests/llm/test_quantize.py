"""Product codes against a plain twin and against SQL."""

import hashlib
import math
import random

import duckdb
import numpy as np
import pytest

from opsframe.llm import quantize, queries
from tests.conftest import SF
from tests.llm import cases

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, parts=16, entries=64, rounds=2):
    """The same codes with every entry evaluated, in plain Python."""
    kept = [(i, [math.floor(256 * x) for x in v], n) for i, v, n in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    first = {}
    for i, v, _ in sorted((k for k in kept if k[0] is not None), key=lambda k: (k[0], k[1])):
        first.setdefault(i, v)
    start = [first[i] for i in sorted(first)[:entries]]
    dim = len(start[0])
    w = dim // parts
    fits = [k for k in kept if len(k[1]) == dim and max(map(abs, k[1])) < 2**28]
    books = [[v[p * w : (p + 1) * w] for v in start] for p in range(parts)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(parts):
            groups = {}
            for _, v, _ in fits:
                x = v[p * w : (p + 1) * w]
                groups.setdefault(near(p, x)[1], []).append(x)
            new.append([[sum(c) // len(groups[i]) for c in zip(*groups[i])] if i in groups else e for i, e in enumerate(books[p])])
        books = new
    out = []
    for i, v, n in fits:
        both = [near(p, v[p * w : (p + 1) * w]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in both), sum(d for d, _ in both), n))
    labels = {}
    for _, _, d, n in out:
        labels[n] = labels.get(n, 0) + d
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, c, d, labels[n], digest) for i, c, d, n in out), key=repr)


def got(df):
    return sorted(cases.rows(quantize.codes_digest(df).select("vec_id", "code", "error", "label_error", "codebooks_sha256")), key=repr)


def test_codes_of_the_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    assert got(df) == plain(cases.rows(df.select("vec_id", "embedding", "label")))


def test_codes_equal_sql(spark):
    c = duckdb.connect()
    c.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    want = c.execute(queries.ORACLE["op12_vector_codes"]).fetchall()
    assert sorted(want, key=repr) == got(spark.read.parquet(f"{SF}/embeddings.parquet"))


@pytest.mark.parametrize(("spread", "n"), [(0.4, 300), (30.0, 300), (0.01, 200), (1.0, 20)])
def test_codes_with_ties_and_bad_rows(spark, spread, n):
    rng = random.Random(n)
    rows = [(i * 3, [rng.choice((-1, 1)) * rng.random() * spread for _ in range(32)], rng.choice((None, 1, 2))) for i in range(n)]
    rows += [(1000 + i, list(rows[i][1]), 1) for i in range(10)]  # copies
    rows += [(None, [0.5] * 32, None), (-7, None, 1), (-6, [0.1] * 31 + [None], 1), (-5, [float("nan")] * 32, 2), (-4, [float("inf")] * 32, 2),
             (6, [-0.25] * 32, 3), (6, [0.25] * 32, 3), (7, [0.0] * 32, 4), (7, [0.0] * 32, 4)]
    df = spark.createDataFrame(rows, SCHEMA)
    rows = cases.rows(df)
    assert got(df) == plain(rows)


def test_vectors_that_cannot_be_coded(spark):
    rows = [(1, [0.5] * 16, 1), (2, [0.25] * 16, 1), (3, [1.0] * 8, 1), (4, [3e30] + [0.0] * 15, 2), (5, [], None)]
    out = {r.vec_id: r for r in quantize.codes_digest(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert out[1].code == "00" * 16 and out[2].code == "01" * 16 and out[1].error == out[2].error == out[1].label_error == 0
    assert all(out[i].code is None and out[i].error is None for i in (3, 4, 5)) and out[5].label_error is None
    odd = quantize.codes_digest(spark.createDataFrame([(1, [0.5] * 15, 1)], SCHEMA)).collect()
    assert [(r.code, r.error) for r in odd] == [(None, None)]
    assert quantize.codes_digest(spark.createDataFrame([], SCHEMA)).count() == 0
    more = spark.createDataFrame([(1, [0.5] * 16, 1, "x", "y")], SCHEMA + ", id string, vector string")
    assert quantize.codes_digest(more).count() == 1


def test_cells_leave_out_only_dominated_entries():
    rng = np.random.default_rng(4)
    for cell, cached in ((1, 5), (7, 50), (32, 1 << 16), (5000, 3)):
        book = rng.integers(-200, 200, (64, 4))
        book[9] = book[3]
        grid = quantize.GridCells(book, cell, cached)
        for _ in range(4):
            points = rng.integers(-300, 300, (500, 4))
            index, distance = grid.nearest(points)
            every = ((points[:, None, :] - book) ** 2).sum(2)
            assert (index == every.argmin(1)).all() and (distance == every.min(1)).all()
        assert cell != 32 or grid.count.mean() < 40
