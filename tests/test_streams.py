"""Streaming forms equal their batch twins on the same rows, however the rows fall into batches."""

import datetime as dt
import os
import random
import tempfile

import pytest

from opsframe.plans import jobs
from opsframe.streaming import streams as S
from tests.test_windows import control_rows


def table_of_files(spark, rows, schema, n):
    """A folder table of n files, written in the order of the rows, and its stream of one file a batch."""
    d = tempfile.mkdtemp(prefix="opsframe-stream-")
    size = -(-len(rows) // n)
    for i in range(n):
        spark.createDataFrame(rows[i * size : (i + 1) * size], schema).coalesce(1).write.mode("append").parquet(os.path.join(d, "t.parquet"))
    return S.stream_table(spark, d, "t", max_files_per_trigger=1), os.path.join(d, "sink"), os.path.join(d, "ckpt")


@pytest.mark.parametrize("n", [1, 2, 10])
def test_port_registry_stream_equals_batch(spark, n):
    rows = sorted(control_rows(300, seed=11), key=lambda r: (r[1], r[0]))
    schema = "id long, ts timestamp_ntz, port int, cmd string, bundle_name string"
    got = {r["id"]: r["outcome"] for r in S.port_registry_stream(*table_of_files(spark, rows, schema, n)).collect()}
    want = {r["id"]: r["outcome"] for r in jobs.port_outcomes(spark.createDataFrame(rows, schema)).collect()}
    assert got == want


def test_rolling_tail_across_batches(spark):
    lines = [(1, i, f"l{i}") for i in range(30)] + [(2, i, f"m{i}") for i in range(5)]
    random.Random(1).shuffle(lines)
    tail = S.rolling_tail(*table_of_files(spark, lines, "log_id long, line_no int, line string", 4), 10)
    assert sorted((r["log_id"], r["line_no"]) for r in tail.collect()) == [(1, i) for i in range(20, 30)] + [(2, i) for i in range(5)]


STEP_ROWS_SCHEMA = "id long, job_id long, ts timestamp_ntz, message string, logtype string"


def pairs_by_replay(rows, hours=1):
    """Sequential replay; rows in (ts, id) order."""
    wait, top, open_, out = dt.timedelta(hours=hours), max(r[2] for r in rows), {}, set()
    for i, job, ts, title, kind in sorted(rows, key=lambda r: (r[2], r[0])):
        held = open_.pop((job, title), None)
        if kind == "sb":
            if held:
                out.add((held[0], None, "unfinished"))
            open_[job, title] = (i, ts)
        elif held and ts <= held[1] + wait:
            out.add((held[0], i, "done"))
        else:
            out |= {(None, i, "late_end")} | ({(held[0], None, "unfinished")} if held else set())
    return out | {(i, None, "unfinished") for i, ts in open_.values() if ts + wait < top}


@pytest.mark.parametrize("n", [1, 2, 10])
def test_step_pairs_replay_with_timeout(spark, n):
    rng, t0 = random.Random(5), dt.datetime(2024, 1, 1, 8)
    rows = [(i, rng.randrange(3), t0 + dt.timedelta(minutes=rng.randrange(1500)), rng.choice(["Build", "Deploy"]), rng.choice(["sb", "se", "sb", "se", "i"])) for i in range(160)]
    # an end five hours after its begin is late, in whatever batches the two are
    rows += [(900, 7, t0, "Long", "sb"), (901, 7, t0 + dt.timedelta(hours=5), "Long", "se"), (902, 8, t0 + dt.timedelta(minutes=1499), "Open", "sb")]
    rows.sort(key=lambda r: (r[2], r[0]))
    got = {(r["begin_id"], r["end_id"], r["status"]) for r in S.step_pairs(*table_of_files(spark, rows, STEP_ROWS_SCHEMA, n)).collect()}
    want = pairs_by_replay([r for r in rows if r[4] != "i"])
    assert got == want and (900, None, "unfinished") in got and (None, 901, "late_end") in got


def test_late_rows_are_kept_aside(spark):
    t0 = dt.datetime(2024, 1, 1, 8)
    rows = [(1, t0 + dt.timedelta(hours=9), 1, "serve", "a"), (2, t0, 1, "serve", "b")]
    src, sink, ckpt = table_of_files(spark, rows, "id long, ts timestamp_ntz, port int, cmd string, bundle_name string", 2)
    out = S.port_registry_stream(src, sink, ckpt)
    assert [r["id"] for r in out.collect()] == [1] and [r["id"] for r in spark.read.parquet(f"{sink}/late").collect()] == [2]

def test_ingest_keeps_every_row_in_one_output(spark):
    """Rows behind the watermark come out as late, repeated deliveries once, all others by type."""
    rng, t0 = random.Random(9), dt.datetime(2024, 1, 1, 8)
    rows = [(i, i % 7, t0 + dt.timedelta(minutes=6 * i + rng.randrange(-150, 30)), f"m{i}", rng.choice(["i", "w", "zz", None, "sb"])) for i in range(200)]
    repeated = [r for r in rows[:190] if r[0] % 9 == 0]
    feed = sorted(rows + repeated, key=lambda r: (r[0], rng.random()))
    schema = "id long, job_id long, ts timestamp_ntz, message string, logtype string"
    src, sink, ckpt = table_of_files(spark, feed, schema, 10)
    S.ingest_job_log(src, sink, ckpt)
    out = {k: spark.read.schema(schema).parquet(f"{sink}/{k}").collect() for k in ("append", "reject", "late")}
    assert {r["id"] for v in out.values() for r in v} == set(range(200))
    assert {r["id"] for r in out["append"]} <= {r[0] for r in rows if r[4] in ("i", "w", "sb")} and len(out["late"]) > 0
    ids = [r["id"] for k in ("append", "reject") for r in out[k]]
    assert len(ids) == len(set(ids))
    # batch by batch: late is what lies an hour and more behind the greatest time of earlier files
    size, top, late = -(-len(feed) // 10), None, []
    for b in range(10):
        part = feed[b * size : (b + 1) * size]
        late += [r[0] for r in part if top and r[2] <= top - dt.timedelta(hours=1)]
        top = max([r[2] for r in part] + ([top] if top else []))
    assert sorted(r["id"] for r in out["late"]) == sorted(late)


def test_state_on_disk_is_bounded(spark):
    lines = [(i % 3, i, f"l{i}") for i in range(50)]
    src, sink, ckpt = table_of_files(spark, lines, "log_id long, line_no int, line string", 50)
    tail = S.rolling_tail(src, sink, ckpt, 4)
    assert sorted((r["log_id"], r["line_no"]) for r in tail.collect()) == sorted((i % 3, i) for i in range(38, 50))
    assert sorted(os.listdir(os.path.join(sink, "state", "tail"))) == ["turn=0", "turn=1"] and os.listdir(sink) == ["state"]
