"""Near duplicates, substring removal and decontamination against brute force."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from opsframe.llm import decontaminate, minhash, substring
from tests.llm import cases


def shingles(text, k):
    w = cases.WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def components_by_brute_force(docs, k, percent):
    sets = {d: shingles(t, k) for d, t in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            s, t = sets[a], sets[b]
            if s and t and 100 * min(len(s), len(t)) >= percent * max(len(s), len(t)) and 100 * len(s & t) >= percent * len(s | t):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in sets}


def near_copies(n, words, edits, seed):
    rng = random.Random(seed)
    base = [f"t{rng.randrange(9000)}" for _ in range(words)]
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(edits if i != n // 2 else 0):
            w[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates(spark, k, percent):
    docs = [(r[0], r[1]) for r in cases.documents(spark).select("doc_id", "text").collect()]
    # groups in which copies are linked through one text only, or through chains
    for g, (n, words, edits) in enumerate([(40, 60, 1), (60, 90, 2), (50, 200, 6), (30, 40, 1)]):
        docs += [(10_000 + 1000 * g + i, t) for i, t in enumerate(near_copies(n, words, edits, g))]
    docs += [(20_000, None), (20_001, ""), (20_002, "A b"), (20_003, "a B"), (20_004, "a"), (20_005, "a b c d e f g")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r[0]: tuple(r)[1:] for r in minhash.near_duplicates(df, k, percent).collect()}
    assert got == components_by_brute_force(docs, k, percent)


def test_components_of_chains(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 150), (7, 7)]
    got = dict(cases.rows(minhash.components(spark.createDataFrame(links, "a long, b long"))))
    assert {k: v for k, v in got.items() if k != v} == {**{i: 0 for i in range(1, 61)}, 200: 100, 150: 100}


def test_near_duplicates_edges(spark):
    got = collections.defaultdict(list)
    for d, n, c, kept in cases.rows(minhash.near_duplicates(cases.edges(spark), 3, 85)):
        got[d].append((n, c, kept))
    assert got[1001] == got[1002] == [(0, got[1001][0][1], True)] or got[1001] == [(0, 1001, True)]
    assert got[1005][0][1:] == (1005, True) and got[1006][0][1:] == (1005, False)
    assert [x[1:] for x in got[1009]] == [(1008, False)] * 2 and got[None] == [(2, None, True)]
    assert minhash.near_duplicates(cases.empty(spark)).count() == 0
    left = minhash.one_of_each(cases.edges(spark), 3, 85)
    assert left.columns == cases.edges(spark).columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id) == [-5, 1001, 1002, 1003, 1004, 1005, 1007, 1008, 1010, 1011]


def test_near_duplicates_by_row(spark):
    """Rows that share an id are one document with several texts; rows without one are compared like all others."""
    rng = random.Random(8)
    a, b, c, d = (" ".join(f"v{rng.randrange(9000)}" for _ in range(80)) for _ in range(4))
    docs = [(5, a), (5, b), (7, a + " more"), (8, b + " more"), (9, c), (None, c + " more"), (None, d), (None, d + " more"), (None, d), (5, None), (None, ""), (None, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = collections.defaultdict(list)
    for r in minhash.near_duplicates(df).collect():
        got[r.doc_id].append((r.component_id, r.kept))
    assert got[5] == [(5, True)] * 3 and got[7] == got[8] == [(5, False)] and got[9] == [(9, True)]
    alone = collections.Counter(got[None])
    assert alone[9, False] == 1 and alone[None, True] + alone[None, False] == 5 and alone[None, True] in (3, 4)
    left = collections.Counter((r.doc_id, r.text) for r in minhash.one_of_each(df).collect())
    chosen = [x for x in left if x[0] is None and x[1]]
    assert len(chosen) == 1 and chosen[0][1] in (d, d + " more")
    assert left == collections.Counter([(5, a), (5, b), (9, c), (5, None), (None, ""), chosen[0]])


def test_shared_id_takes_no_other_text(spark):
    rng = random.Random(9)
    a, b = (" ".join(f"v{rng.randrange(9000)}" for _ in range(60)) for _ in range(2))
    df = spark.createDataFrame([(3, a), (5, a + " x"), (5, b), (5, b.upper())], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in minhash.near_duplicates(df).collect()} == {(3, 3), (5, 3)}
    left = [(r.doc_id, r.text) for r in minhash.one_of_each(df).collect()]
    assert len(left) == 2 and (3, a) in left and {x[1].lower() for x in left} == {a, b}


def removed_by_brute_force(docs, window):
    words = [(d, cases.WORD.findall(t or "")) for d, t in docs]
    low = {}
    for d, w in words:
        if d is not None:
            for i in range(len(w) - window + 1):
                key = tuple(w[i : i + window])
                low[key] = min(low.get(key, d), d)
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if d is not None and low[tuple(w[i : i + window])] < d:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return collections.Counter(out)


@pytest.mark.parametrize("group", [20_000, 5])
def test_remove_repeats(spark, group):
    """group=5: hot prefixes are replaced by longer ones, some up to whole windows."""
    rng = random.Random(3)
    some = [(r[0], r[1]) for r in cases.documents(spark).where("doc_id < 120").select("doc_id", "text").collect()]
    passage = " ".join(f"p{i}" for i in range(70))
    own = [(500 + i, " ".join(f"a{rng.randrange(9)}" for _ in range(rng.randrange(90))) + " " + passage[: rng.randrange(150, 400)]) for i in range(40)]
    own += [(600 + i, "go " * n) for i, n in enumerate([49, 50, 51, 120])]
    docs = some + own + [(e[0], e[1]) for e in cases.EDGES if e[0] not in (1005, 1006)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    out = substring.remove_repeats(df, group=group)
    got = collections.Counter((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in out.collect())
    assert got == removed_by_brute_force(docs, 50)


def test_longer_prefixes(spark):
    """Every step of the prefixes: passages of one start whose copies go on together for 26 to 60 words."""
    rng = random.Random(12)
    start = [f"s{i}" for i in range(26)]
    docs = []
    for i in range(120):
        same = start + [f"t{j}" for j in range((i * 7) % 35)]
        docs.append((i, " ".join([f"x{rng.randrange(10**6)}" for _ in range(i % 30)] + same + [f"y{rng.randrange(10**6)}" for _ in range(60)])))
    docs += [(200 + i, docs[i][1] + " tail") for i in range(0, 120, 9)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    out = substring.remove_repeats(df, group=12)
    got = collections.Counter((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in out.collect())
    assert got == removed_by_brute_force(docs, 50)


def test_remove_repeats_empty(spark):
    assert substring.repeats_digest(cases.empty(spark)).count() == 0
    assert substring.repeats_digest(cases.edges(spark)).count() == len(cases.EDGES)


def test_common_subsequence():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(1, 30))] for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert decontaminate.common_subsequence(decontaminate._masks(np.array(a)), len(a), b) == t[-1][-1]


def test_leaks(spark):
    """Every whole or paraphrased benchmark item is found, and nothing else."""
    docs = [(r[0], r[1]) for r in cases.documents(spark).select("doc_id", "text").collect()]
    bench = spark.read.parquet(f"{cases.SF}/benchmark.parquet")
    items = [(r[0], r[1]) for r in bench.collect()]
    whole = {(d, i) for d, t in docs for i, x in items if x in t}
    rng = random.Random(5)
    planted = set()
    for n, (i, x) in enumerate(items[:25]):
        w = x.upper().split()
        for _ in range(len(w) // 8):  # a word in eight replaced, not in the answer
            w[rng.randrange(max(1, len(w) - len(w) // 3))] = f"other{rng.randrange(99)}"
        docs.append((5000 + n, docs[n][1][:300] + "\n" + ", ".join(w) + "\n" + docs[n + 1][1][:200]))
        planted.add((5000 + n, i))
    docs += [(e[0], e[1]) for e in cases.EDGES]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(df, bench).collect()}
    assert whole <= got
    assert len(planted - got) <= 1  # recall of paraphrases
    assert {g for g in got if g[0] is None or 1000 <= g[0] <= 1011 or g[0] < 0} == set()
    first = {d for d, _ in whole}
    assert all(g in planted or g in whole or g[0] >= 5000 and {docs[g[0] - 5000][0], docs[g[0] - 4999][0]} & first for g in got)


def test_leaks_of_nothing(spark):
    bench = spark.read.parquet(f"{cases.SF}/benchmark.parquet")
    assert decontaminate.leaks(cases.empty(spark), bench).count() == 0
    assert decontaminate.leaks(cases.edges(spark), bench.limit(0)).count() == 0
    none = spark.createDataFrame([(1, None), (2, ""), (None, "a b c")], "item_id long, text string")
    assert decontaminate.leaks(cases.edges(spark), none).count() == 0


def test_bucket_search_is_bounded(spark, monkeypatch):
    """A bucket of unlinked members is dealt over groups of two blocks, in which each pair of components meets once."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 2_000)
    named = spark.range(600).select(F.lit(0).alias("band"), F.lit(7).cast("long").alias("hash"), F.col("id").alias("rep"), F.lit(50).cast("long").alias("n_shingles"),
                                    F.greatest("id", F.lit(100)).alias("component"))  # 0 to 100 are linked
    groups = collections.defaultdict(lambda: ([], []))
    for r in minhash.dealt(named).collect():
        groups[r.i, r.j][r.ask].append(r.rep)
    assert max(50 * len(x) for g in groups.values() for x in g) <= 2 * 2_000
    met = collections.Counter()
    for (i, j), (held, asks) in groups.items():
        met.update((min(x, y), max(x, y)) for x in asks for y in held if max(x, 100) != max(y, 100) and (i != j or y < x))
    assert set(met.values()) == {1} and len(met) == 600 * 599 // 2 - 101 * 100 // 2


def test_near_duplicates_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 150)
    docs = []
    for g, (n, words, edits) in enumerate([(40, 60, 1), (30, 200, 6), (30, 90, 2)]):
        docs += [(1000 * g + i, t) for i, t in enumerate(near_copies(n, words, edits, g))]
    got = {r[0]: tuple(r)[1:] for r in minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == components_by_brute_force(docs, 5, 80)

def test_short_items_are_found_word_for_word(spark):
    """Recall by length: items of four words and more that stand verbatim among other words."""
    rng = random.Random(21)
    word = lambda: f"w{rng.randrange(4000)}"
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([4, 5, 6, 8, 10, 12, 15] * 6)]
    docs = [(i, " ".join([word() for _ in range(60)] + [t.upper() if i % 2 else t] + [word() for _ in range(60)])) for i, t in items]
    docs += [(1000 + i, " ".join(word() for _ in range(120))) for i in range(100)]
    docs += [(2000, items[0][1].rsplit(" ", 2)[0]), (2001, items[0][1].split()[-1]), (None, "x, " + items[6][1] + "!")]
    found = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    pairs = {(r.doc_id, r.item_id) for r in found}
    assert {(i, i) for i, _ in items} <= pairs and (None, 6) in pairs
    assert [(r.doc_id, r.item_id, r.same, r.answer) for r in found if (r.doc_id or 0) >= 1000] == []


def many_passages(spark):
    """Half a million passages of 20 kinds, all their singular values squared, and the features' weights."""
    rng = random.Random(8)
    kinds = [" ".join(f"k{rng.randrange(400)}" for _ in range(decontaminate.PASSAGE)) for _ in range(20)]
    copies = [[200 + 13 * ((7 * i + d) % 20) for i in range(20)] for d in range(8)]  # of the kinds in a document
    docs = [(d, " ".join(" ".join([k] * n) for k, n in zip(kinds, c))) for d, c in enumerate(copies)]
    many = spark.createDataFrame(docs, "doc_id long, text string").crossJoin(spark.range(10).select(F.col("id").alias("again")))
    many = many.select((F.col("doc_id") * 10 + F.col("again")).alias("doc_id"), "text")
    n = 10 * np.array(copies).sum(0)
    assert n.sum() > 500_000
    rows = np.vstack([decontaminate.feature_rows(h, at, decontaminate.PASSAGE)[0] for _, _, h, at in decontaminate.words(kinds)])
    held = np.zeros((20, decontaminate.DIM))
    np.add.at(held, (np.repeat(np.arange(20), decontaminate.PASSAGE), rows.ravel()), 1)
    idf = np.log((n.sum() + 1) / (n @ (held > 0) + 1)) + 1e-3
    a = np.zeros(held.shape)
    np.add.at(a, (np.repeat(np.arange(20), decontaminate.PASSAGE), rows.ravel()), decontaminate._weights(rows, idf).ravel())
    return many, np.linalg.eigvalsh((a @ a.T) * np.sqrt(np.outer(n, n))), idf


def test_latent_space_is_fitted_on_every_passage(spark):
    many, want, idf = many_passages(spark)
    place, _ = decontaminate.latent_space(many)
    np.testing.assert_allclose(np.sort(1 / ((place[:-1] / idf[:, None]) ** 2).sum(0)), want, rtol=1e-3)


def test_pipeline_fits_the_latent_space_on_every_passage(spark, monkeypatch):
    import corpus_pipeline

    many, want, idf = many_passages(spark)
    fitted, fit = [], decontaminate.latent_space
    monkeypatch.setattr(decontaminate, "latent_space", lambda documents: fitted.append(fit(documents)) or fitted[0])
    assert corpus_pipeline.benchmark(spark, many, cases.SF).count() == 80
    place, _ = fitted[0]
    np.testing.assert_allclose(np.sort(1 / ((place[:-1] / idf[:, None]) ** 2).sum(0)), want, rtol=1e-3)
