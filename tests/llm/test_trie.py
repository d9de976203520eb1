"""The prefix trie against a plain one."""

import collections
import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest

from opsframe.llm import queries, trie
from tests.conftest import SF
from tests.llm import cases

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(v, key=lambda t: t[0])] for c, v in own.items()}
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, v in sorted(own.items()):
        h = zlib.crc32(str(c).encode()) % 9
        path = own.get(c - c % 5, [])[:h] + v[h:]
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
        ends[tuple(path)].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    return sorted(((m[0], len(p), members[p[:-1]][0] if p else None, len(m), children[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest()) for p, m in members.items()), key=repr)


def got(df, **more):
    return sorted(cases.rows(trie.prefix_trie(df, **more).select(*COLUMNS)), key=repr)


def test_trie_of_the_table_equals_a_plain_one_and_sql(spark):
    c = duckdb.connect()
    c.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF}/conversations.parquet')")
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    want = plain(cases.rows(df.select("conv_id", "turn", "role", "text")))
    assert got(df) == want
    assert sorted((tuple(r) for r in c.execute(queries.ORACLE["op13_prefix_trie"]).fetchall()), key=repr) == want


@pytest.mark.parametrize(("shard_turns", "columns", "seed"), [(400_000, 16, 0), (40, 2, 1), (15, 1, 2), (90, 3, 3)])
def test_trie_over_shards(spark, shard_turns, columns, seed):
    """Few different turns, so most conversations share prefixes; many equal ones; null and repeated turns."""
    rng = random.Random(seed)
    rows = []
    for c in range(400):
        first = [("user", "hi")] * rng.randrange(4)
        turns = first + [(rng.choice(["user", "assistant", None, ""]), rng.choice(["a", "é", "", None, "long " * 9])) for _ in range(rng.randrange(1, 7))]
        if c % 3 == 0:  # a third of all conversations are equal, with their bases too
            turns = [("user", f"t{i}") for i in range(12)]
        rows += [(c, i if i else None, *t) for i, t in enumerate(turns)]
    rows += [(None, 0, "user", "no conversation"), (7003, 1, "u", "x"), (7009, 5, "u", "x")]
    rows += [(5000, i, "user", f"w{i % 3}") for i in range(300)] + [(5001, i, "user", f"w{i % 3}") for i in range(260)]  # long ones
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({n: cases.F.lit("extra") for n in ("path", "base", "h", "shard", "key")})
    assert got(df, shard_turns=shard_turns, columns=columns) == plain(rows)


def test_turnless_and_empty(spark):
    turnless = [c for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2][:3]
    rows = [(c, 0, "user", "x") for c in turnless]
    want = got(spark.createDataFrame(rows, SCHEMA))
    assert want == plain(rows) and len(want) == 1 and want[0][4:6] == (0, 1)
    assert trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert trie.prefix_trie(spark.createDataFrame([(None, 1, "u", "t")], SCHEMA)).count() == 0
    negative = [(-3, 0, "user", "x"), (0, 0, "user", "y"), (0, 1, "user", "z")]
    assert got(spark.createDataFrame(negative, SCHEMA))[0][3] == 2


def test_order_and_shared_turns():
    rng = np.random.default_rng(2)
    for columns in (1, 2, 7):
        lists = [rng.integers(0, 2, rng.integers(0, 12)).tolist() for _ in range(300)] + [[1] * 40, [1] * 39, [1] * 40]
        size = np.array([len(x) for x in lists])
        ids = np.array([v for x in lists for v in x])
        rows = trie.Rows(np.arange(len(lists)), size, ids, ids * 3, ids, columns)
        order = rows.order()
        assert order.tolist() == sorted(range(len(lists)), key=lambda i: (lists[i], i))
        shared = rows.taken(order).shared()
        for i in range(1, len(order)):
            a, b = lists[order[i - 1]], lists[order[i]]
            assert shared[i] == next((j for j in range(min(len(a), len(b))) if a[j] != b[j]), min(len(a), len(b)))
