"""SimHash components against brute force."""

import random

import numpy as np
import pytest
import xxhash

from opsframe.llm import simhash
from tests.llm import cases


def plain_fingerprint(text, k=3):
    w = cases.WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    runs = [" ".join(w[i : i + k]) for i in range(max(len(w) - k + 1, 1))] if w else []
    h = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components_by_brute_force(fps, distance=3):
    """Least place reachable, of every place."""
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(fps):
        for j in range(i):
            if (x ^ fps[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def near(rng, base, most):
    for b in rng.sample(range(64), rng.randrange(most + 1)):
        base ^= 1 << b
    return base


@pytest.mark.parametrize(("limit", "most"), [(1024, 6), (2, 6), (30, 9)])
def test_links_find_all_near_fingerprints(spark, limit, most):
    """Clusters of near fingerprints: searched in whole buckets, and by finer blocks where a bucket is over the limit."""
    rng = random.Random(limit)
    fps = sorted({near(rng, c, most) for c in [rng.getrandbits(64) for _ in range(8)] + [0, 2**64 - 1] for _ in range(60)})
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    found = simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long"), limit=limit).collect()
    place = {s: i for i, s in enumerate(signed)}
    assert all((fps[place[r.a]] ^ fps[place[r.b]]).bit_count() <= 3 for r in found)
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for r in found:
        a, b = find(place[r.a]), find(place[r.b])
        root[max(a, b)] = min(a, b)
    assert [find(i) for i in range(len(fps))] == components_by_brute_force(fps)


def test_every_near_pair_shares_a_bucket_of_bounded_size():
    plan = simhash.masks()
    assert len(plan) == 20 and all(len(f) == 56 for _, f in plan)
    assert max(64 - (m % 2**64).bit_count() for _, f in plan for m in f) <= 13
    rng = random.Random(5)
    for _ in range(2000):
        d = sum(1 << b for b in rng.sample(range(64), 3))
        assert any(not d & m for m, _ in plan)
        assert all(any(not d & x for x in f) for m, f in plan if not d & m)


def test_forest_is_linear():
    fps = np.array([1 << (i % 3) for i in range(50)] + [2**40 + 1], np.int64)
    assert len(simhash.forest(fps, 3)) == 50


def test_simhash_of_documents(spark):
    docs = [(r[0], r[1]) for r in cases.documents(spark).select("doc_id", "text").collect()]
    rng = random.Random(3)
    base = [f"t{rng.randrange(900)}" for _ in range(300)]
    for i in range(40):  # long texts that differ in a few words have near fingerprints
        w = list(base)
        for _ in range(i % 4):
            w[rng.randrange(300)] = f"e{rng.randrange(999)}"
        docs.append((9000 + i, " ".join(w)))
    docs += [(20_000, None), (20_001, ""), (20_002, " \t"), (20_003, "A b"), (20_004, "a  B")]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.simhash_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    docs.sort()
    fps = [plain_fingerprint(t) for _, t in docs]
    assert got == {d: (f"{f:016x}", docs[c][0]) for (d, _), f, c in zip(docs, fps, components_by_brute_force(fps))}
    assert got[20_000][0] == "0" * 16 and got[20_003] == got[20_004] and len({c for _, c in got.values()}) < len(got) - 20


def test_simhash_edges(spark):
    got = simhash.simhash_components(cases.edges(spark)).collect()
    assert len(got) == len(cases.EDGES)
    by = {r.doc_id: r for r in got}
    assert by[1001].component_id == by[1002].component_id == by[1003].component_id == 1001
    assert by[1009].component_id == 1008 and by[1006].component_id == by[1005].component_id == 1005
    assert by[None].fingerprint == f"{plain_fingerprint('no id ' * 60):016x}"
    assert simhash.simhash_components(cases.empty(spark)).count() == 0


def test_rows_that_share_an_id_are_one_document(spark):
    a, b = "alpha beta gamma delta " * 9, "one two three four five " * 9
    rows = [(5, a), (5, b), (7, a), (8, b), (None, a), (None, "neither here nor there"), (9, "alone")]
    got = simhash.simhash_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in got) == [(0, 0), (0, 5), (5, 5), (5, 5), (7, 5), (8, 5), (9, 9)]


def test_a_bit_needs_more_than_half():
    assert simhash.fingerprint(b"a b c d", 3) == plain_fingerprint("a b c d")
    text = " ".join(f"x{i}" for i in range(simhash.PIECE + 50))
    assert simhash.fingerprint(text.encode(), 3) == plain_fingerprint(text)
