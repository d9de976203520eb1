"""Order-dependent operators checked against sequential replays (brute force)."""

import datetime as dt
import random
import re

from pyspark.sql import functions as F

from opsframe.operators.joins import first_suffix_match, suffix_join
from opsframe.operators.windows import dense_index, keyed_index, primary_until_first_hit, running_count_before, step_of_message, step_spans
from opsframe.plans import jobs

SAFE = re.compile(r"^[0-9A-Za-z\-_]+\Z")


def control_rows(n=600, seed=7):
    rnd = random.Random(seed)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        ts = t0 + dt.timedelta(minutes=rnd.randint(0, 5 * 24 * 60))
        cmd = rnd.choice(["serve", "serve", "unserve"])
        name = rnd.choice(["b1", "b2", "bad name!", "b_3"])
        rows.append((i, ts, 10000 + rnd.randint(0, 4), cmd, name))
    return rows


def replay(rows):
    """The control server's port table, command by command."""
    served, out = {}, {}
    for i, ts, port, cmd, name in sorted(rows, key=lambda r: (r[1], r[0])):
        if cmd == "serve":
            if port in served:
                out[i] = "refused_busy"
            elif not SAFE.match(name):
                out[i] = "refused_name"
            else:
                served[port], out[i] = name, "ok"
        else:
            out[i] = "ok" if port in served else "error_not_served"
            served.pop(port, None)
    return out, served


def test_port_outcomes_equal_sequential_replay(spark):
    rows = control_rows()
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz, port int, cmd string, bundle_name string")
    got = {r["id"]: r["outcome"] for r in jobs.port_outcomes(df).collect()}
    want, live = replay(rows)
    assert got == want
    reg = {r["port"]: r["bundle_name"] for r in jobs.port_registry(df).collect()}
    assert reg == live


def test_busy_port_second_serve_refused(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, t, 9000, "serve", "first"), (2, t + dt.timedelta(seconds=1), 9000, "serve", "second")],
                               "id long, ts timestamp_ntz, port int, cmd string, bundle_name string")
    got = {r["id"]: r["outcome"] for r in jobs.port_outcomes(df).collect()}
    assert got == {1: "ok", 2: "refused_busy"}
    assert [r["bundle_name"] for r in jobs.port_registry(df).collect()] == ["first"]


def log_rows(n=500, seed=3):
    rnd = random.Random(seed)
    t0 = dt.datetime(2024, 1, 1)
    return [(i, rnd.randint(1, 4), t0 + dt.timedelta(minutes=rnd.randint(0, 4 * 24 * 60)),
             rnd.choice(["Step 0", "Step 1"]), rnd.choice(["sb", "se", "i", "w", "e"])) for i in range(n)]


def test_step_spans_and_messages_equal_replay(spark):
    rows = log_rows()
    df = spark.createDataFrame(rows, "id long, job_id long, ts timestamp_ntz, message string, logtype string")
    spans = {r["begin_id"]: (r["status"], r["end_id"]) for r in step_spans(df, "job_id", "message", F.to_date("ts")).collect()}
    want = {}
    by_key = {}
    for r in sorted(rows, key=lambda r: (r[2], r[0])):
        if r[4] in ("sb", "se"):
            by_key.setdefault((r[1], r[3]), []).append(r)
    for seq in by_key.values():
        for a, b in zip(seq, seq[1:] + [None]):
            if a[4] == "sb":
                want[a[0]] = ("done", b[0]) if b is not None and b[4] == "se" else ("unfinished", None)
    assert spans == want
    tagged = {r["id"]: r["step_begin_id"] for r in step_of_message(df, "job_id", F.to_date("ts")).collect()}
    cur, want2 = {}, {}
    for r in sorted(rows, key=lambda r: (r[2], r[0])):
        if r[4] == "sb":
            cur[r[1]] = r[0]
        elif r[4] == "se":
            cur[r[1]] = None
        want2[r[0]] = cur.get(r[1])
    assert tagged == want2


def test_running_count_and_dense_index(spark):
    rnd = random.Random(1)
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, rnd.randint(0, 2), t0 + dt.timedelta(hours=rnd.randint(0, 200)), rnd.random() < 0.3) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, k int, ts timestamp_ntz, f boolean")
    got = {r["id"]: r["n"] for r in running_count_before(df, ["k"], ["ts", "id"], "f", F.to_date("ts"), "n").collect()}
    want, seen = {}, {}
    for r in sorted(rows, key=lambda r: (r[2], r[0])):
        want[r[0]] = seen.get(r[1], 0)
        seen[r[1]] = seen.get(r[1], 0) + (1 if r[3] else 0)
    assert got == want
    idx = {r["id"]: r["i"] for r in dense_index(df, ["ts", "id"], "i", buckets=5).collect()}
    order = [r[0] for r in sorted(rows, key=lambda r: (r[2], r[0]))]
    assert [idx[i] for i in order] == list(range(len(rows)))


def test_dense_index_heavy_ties_and_nulls(spark):
    day = dt.datetime(2024, 1, 1)
    rows = [(i, None if i % 50 == 0 else day) for i in range(1000)]   # one date for all, some nulls
    df = spark.createDataFrame(rows, "id long, d timestamp_ntz")
    got = {r["id"]: r["i"] for r in dense_index(df, ["d", "id"], "i", buckets=8).collect()}
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or day, r[0]))   # nulls first, then id
    assert [got[r[0]] for r in order] == list(range(1000))
    buckets = (dense_index(df, ["d", "id"], "i", buckets=8)
               .withColumn("b", F.floor(F.col("i") / 125)).groupBy("b").count().count())
    assert buckets == 8

def test_keyed_index_of_a_hot_key(spark):
    rng = random.Random(3)
    rows = [(None if k == 7 else k, rng.randrange(200), i) for i in range(3000) for k in [rng.choice([0, 0, 0, 0, 1, 2, 7, 8 + i % 90])]]
    df = spark.createDataFrame(rows, "k long, o int, id long").repartition(5)
    got = {r["id"]: r["at"] for r in keyed_index(df, ["k"], ["o", "id"], "at", partitions=9).collect()}
    want, seen = {}, {}
    for k, o, i in sorted(rows, key=lambda r: (r[1], r[2])):
        want[i] = seen.get(k, 0)
        seen[k] = want[i] + 1
    assert got == want
    assert keyed_index(df.limit(0), ["k"], ["o", "id"], "at").count() == 0


def test_primary_until_first_hit(spark):
    rows = [(1, 5, "a", False), (1, 6, "b", True), (1, 6, "c", True), (1, 9, "d", False), (2, 1, "x", False), (2, 2, "y", False), (3, 1, "z", True)]
    out = primary_until_first_hit(spark.createDataFrame(rows, "k long, len int, path string, hit boolean"), "k", ["len", "path"], "hit")
    assert {r["path"] for r in out.collect() if not r["is_primary"]} == {"c", "d"}


def test_suffix_joins_equal_all_pairs(spark):
    rng = random.Random(8)
    part = lambda n: "/".join(rng.choice(["a", "ab", "urls", "x"]) for _ in range(rng.randrange(1, n)))
    left = [(i, rng.randrange(3), part(3) + ".py") for i in range(60)]
    right = [(rng.randrange(3), part(6) + ".py") for _ in range(300)]
    a, b = spark.createDataFrame(left, "id long, repo long, suffix string"), spark.createDataFrame(right, "repo long, path string")
    want = sorted((i, p) for i, g, s in left for h, p in right if g == h and p.endswith(s))
    assert sorted((x["id"], x["path"]) for x in suffix_join(a, b, "repo", "suffix", "path").collect()) == want
    first = {x["id"]: x["found"] for x in first_suffix_match(a, b, "repo", "suffix", "path", "found").collect()}
    assert first == {i: min(p for j, p in want if j == i) for i, _ in want}
