"""File sources: ordered line reads across splits, metadata listing, whole files."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from opsframe.operators.windows import tail_lines
from opsframe.plans.inventory import free_ports
from opsframe.sources import append as A
from opsframe.sources import files


def test_read_lines_keeps_file_order_across_splits(spark):
    d = tempfile.mkdtemp(prefix="opsframe-lines-")
    path = os.path.join(d, "app.log")
    with open(path, "w") as fh:
        for i in range(60000):
            fh.write(f"line {i} {'x' * (i % 17)}\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 * 1024))
    try:
        df = files.read_lines(spark, path)
        assert df.rdd.getNumPartitions() > 5
        ordered = [r["line"] for r in df.orderBy("block_start", "seq").collect()]
        assert ordered == [f"line {i} {'x' * (i % 17)}" for i in range(60000)]
        last = tail_lines(df, ["path"], [F.col("block_start"), F.col("seq")], 100)
        got = [r["line"] for r in last.orderBy(F.desc("from_end")).collect()]
        assert got == ordered[-100:]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_listing_and_whole_files(spark):
    d = tempfile.mkdtemp(prefix="opsframe-list-")
    for name, text in [("p1.bundle_a.port.10001.conf", "[program]\n"), ("notes.txt", "  myname\n")]:
        with open(os.path.join(d, name), "w") as fh:
            fh.write(text)
    listing = {r["name"]: r for r in files.list_files(spark, d).collect()}
    assert listing["notes.txt"]["length"] == 9 and listing["notes.txt"]["mod_time"] > 0
    whole = {r["name"]: r["text"] for r in files.read_whole(spark, d).collect()}
    assert whole["notes.txt"] == "  myname\n"


def test_site_files_of_a_hot_app_are_written_by_several_tasks(spark):
    from opsframe.plans import routing
    d = os.path.join(tempfile.mkdtemp(prefix="opsframe-sites-"), "sites")
    rows = [("p1", 0, 0, "upstream app_server_p1 {")] + [("p1", 1, i, f"    server 10.0.0.1:{i};") for i in range(5000, 9000)] + [
        ("p1", 2, 0, "}\nserver {"), ("p1", 9, 0, "}"), ("p2", 0, 0, "upstream app_server_p2 {"), ("p2", 9, 0, "")]
    lines = spark.createDataFrame(rows, "app_id string, section int, ord long, line string").repartition(5)
    routing.write_site_files(lines, d, partitions=6)
    parts = {r["path"] for r in files.list_files(spark, d, recursive=True).filter("parent = 'app_id=p1'").collect()}
    assert len(parts) > 3
    back = routing.read_site_files(spark, d).orderBy("app_id", "line_no").collect()
    assert [r["line"] for r in back if r["app_id"] == "p1"] == "\n".join(r[3] for r in rows if r[0] == "p1").split("\n")
    assert [(r["line_no"], r["line"]) for r in back if r["app_id"] == "p2"] == [(0, "upstream app_server_p2 {"), (1, "")]
    listed = {r["app_id"]: r["filesize"] for r in files.list_ordered_text(spark, d, ["app_id"]).collect()}
    assert listed["p1"] == sum(len(r[3]) + 1 for r in rows if r[0] == "p1")


def test_ordered_text_in_many_splits(spark):
    d = os.path.join(tempfile.mkdtemp(prefix="opsframe-logs-"), "logs")
    rows = [("h 1+%", "a:b.log", i, f"line {i} {'x' * (i % 17)}") for i in range(20000)] + [("h2", "a:b.log", i, f"m{i}") for i in range(3)]
    df = spark.createDataFrame(rows, "hostname string, log_id string, no int, line string").repartition(7)
    files.write_ordered_text(df, d, ["hostname", "log_id"], ["no"], partitions=3)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(16 * 1024))
    try:
        lines = files.read_ordered_text(spark, d, ["hostname", "log_id"])
        assert lines.rdd.getNumPartitions() > 8
        got = [r["line"] for r in lines.filter("hostname = 'h 1+%'").orderBy(*files.FILE_ORDER).collect()]
        assert got == [r[3] for r in rows[:20000]]
        tail = tail_lines(lines, ["hostname", "log_id"], [F.col(c) for c in files.FILE_ORDER], 50)
        assert [r["line"] for r in tail.filter("hostname = 'h 1+%'").orderBy(F.desc("from_end")).collect()] == got[-50:]
        assert tail.filter("hostname = 'h2'").count() == 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    listing = files.list_ordered_text(spark, d, ["hostname", "log_id"])
    assert {(r["hostname"], r["log_id"]) for r in listing.collect()} == {("h 1+%", "a:b.log"), ("h2", "a:b.log")}
    assert "content" not in listing._jdf.queryExecution().executedPlan().toString()


def folders(top):
    """(folder, part number): content of the text files under a folder, also hidden ones."""
    out = {}
    for at, _, names in os.walk(top):
        for name in names:
            if name != "_SUCCESS" and name != "._SUCCESS.crc":
                with open(os.path.join(at, name), "rb") as fh:
                    out[os.path.relpath(at, top), name[:10]] = fh.read()
    return out


def test_very_many_folders_are_written_and_read_by_tasks(spark):
    top = tempfile.mkdtemp(prefix="opsframe-folders-")
    odd = ["a", "a=b/c:d %25+'\"#*?\\{}[]^\t", "A", "a b", None]
    rows = [(k, f"x{i % 3}", i, [f"line {i}", "", None, f"two{i}\nlines\r", "é\x0b", " "][i % 6]) for i in range(3000) for k in odd]
    rows += [(f"app{i}", "x", 0, "one\n") for i in range(500)] + [("hot", "x", i, f"h{i} {'y' * (i % 40)}") for i in range(20000)]
    df = spark.createDataFrame(rows, "app string, kind string, ord long, line string").repartition(5)
    keys = ["app", "kind"]
    files.write_text_folders(df, f"file:{top}/new", keys, ["ord"], partitions=6)
    files.write_ordered_text(df, f"file:{top}/spark", keys, ["ord"], partitions=6)
    new, by_spark = folders(f"{top}/new"), folders(f"{top}/spark")
    assert not [k for k in new if not k[1].startswith("part-")]  # no file besides the part files
    whole = lambda parts: {at: b"".join(parts[k] for k in sorted(parts) if k[0] == at and k[1].startswith("part-")) for at in {k[0] for k in parts}}
    assert whole(new) == whole(by_spark)
    assert len([k for k in new if k[0] == "app=hot/kind=x"]) > 3
    assert os.path.exists(f"{top}/new/_SUCCESS") and sorted(os.listdir(top)) == ["new", "spark"]
    back = files.read_text_folders(spark, f"file:{top}/new", keys)
    assert "FileScan" not in back._jdf.queryExecution().executedPlan().toString()
    order = [*keys, *files.FILE_ORDER]
    want = files.read_ordered_text(spark, f"file:{top}/spark", keys)
    lines = lambda d: [(r["app"], r["kind"], r["line"]) for r in d.orderBy(*order).collect()]
    assert lines(back) == lines(want)


def test_folders_of_null_empty_and_accented_names(spark):
    top = tempfile.mkdtemp(prefix="opsframe-names-")
    names = [None, "", files.NO_VALUE, "é 中"]
    rows = [(a, b, i, f"{a} {b} {i}") for a in names for b in names for i in range(50)]
    df = spark.createDataFrame(rows, "app string, kind string, ord long, line string").repartition(3)
    files.write_text_folders(df, f"file:{top}/out", ["app", "kind"], ["ord"], partitions=3)
    got = files.read_text_folders(spark, f"file:{top}/out", ["app", "kind"]).collect()
    value = lambda x: x if x == "é 中" else None
    assert sorted((repr((r["app"], r["kind"])), r["line"]) for r in got) == sorted((repr((value(a), value(b))), x) for a, b, _, x in rows)


def test_folders_of_pieces(spark, monkeypatch):
    """A file of several pieces, one without a last line feed, an empty one, and a folder without files."""
    monkeypatch.setattr(files, "READ_BYTES", 100)
    monkeypatch.setattr(files, "BATCH_LINES", 7)
    top = tempfile.mkdtemp(prefix="opsframe-pieces-")
    texts = {"a": "\n".join(f"{i} {'x' * (i * 7 % 300)}" for i in range(200)) + "\n", "b": "no end\n\nof line", "c": "", "d": None}
    for k, text in texts.items():
        os.makedirs(f"{top}/k={k}")
        if text is not None:
            with open(f"{top}/k={k}/part-00002.txt", "w") as fh:
                fh.write(text)
    got = files.read_text_folders(spark, f"file:{top}", ["k"]).orderBy("k", *files.FILE_ORDER).collect()
    for k, text in texts.items():
        assert [r["line"] for r in got if r["k"] == k] == (text or "").splitlines()
    assert {r["part"] for r in got} == {2}


def test_folders_of_nothing_and_of_a_failed_write(spark):
    top = tempfile.mkdtemp(prefix="opsframe-none-")
    none = spark.createDataFrame([], "k string, ord long, line string")
    files.write_text_folders(none, f"file:{top}/none", ["k"], ["ord"])
    assert files.read_text_folders(spark, f"file:{top}/none", ["k"]).collect() == []
    with pytest.raises(FileExistsError):
        files.write_text_folders(none, f"file:{top}/none", ["k"], ["ord"])
    bad = spark.range(10).select(F.col("id").cast("string").alias("k"), F.col("id").alias("ord"), F.expr("if(id < 9, 'a', raise_error('no'))").alias("line"))
    with pytest.raises(Exception, match="no"):
        files.write_text_folders(bad, f"file:{top}/bad", ["k"], ["ord"])
    assert os.listdir(top) == ["none"]


def test_site_files_parse(spark):
    from opsframe.plans import inventory
    site = ("upstream app_server_p1 {\n    server 10.0.0.1:10001 max_fails=2  fail_timeout=10s;\n"
            "    server 10.0.0.2:10002 max_fails=2  fail_timeout=10s;\n}\nserver {\n    listen 80;\n"
            "    server_name old.example.net ;\n    server_name p1.example.net www.example.com ;\n"
            "    location /static/ {\n        alias /cust/p1/bundle_p1_x/user-repo/static/;\n    }\n}\n")
    rows = spark.createDataFrame([("p1", 0, site), (".hidden", 0, site), ("p2", 0, "    alias /short;\n")],
                                 "site string, ord int, text string")
    got = {r["site"]: r for r in inventory.site_files(rows).collect()}
    assert set(got) == {"p1", "p2"}
    p1 = got["p1"]
    assert (p1["server"], p1["server_name"], p1["bundle_name"]) == ("10.0.0.2:10002", ["p1.example.net", "www.example.com"],
                                                                      "bundle_p1_x")
    assert got["p2"]["n_bad_alias"] == 1


def test_log_catalog_with_access_log(spark):
    from opsframe.plans import logs
    listing = spark.createDataFrame([
        ("h1", "bundle_shop7_2013-02-04-11.20.05-stderr---supervisor-q1.log", 10, 1.5),
        ("h1", "bundle_shop7_2013-02-05-11.20.05-stderr---supervisor-q2.log", 20, 2.5),   # newer name wins
        ("h1", "bundle_shop7_2013-02-04-11.20.05-stdout---supervisor-q3.log", 30, 3.5),
        ("h2", "other.txt", 1, 1.0)], "hostname string, name string, filesize long, mod_time double")
    access = spark.createDataFrame([("h1", "shop7", "shop7.access.log", 5, 4.0)],
                                   "hostname string, app_id string, name string, filesize long, mod_time double")
    cat = {(r["stream"]): r for r in logs.log_catalog(listing, access).collect()}
    assert set(cat) == {"stderr", "stdout", "access"}
    assert cat["stderr"]["log_id"].startswith("bundle_shop7_2013-02-05")
    assert cat["stderr"]["caption"] == "Application Standard Error"
    assert cat["access"]["caption"] == "Web Server Access Log"
    assert str(cat["stdout"]["mod_dt"]) == "1970-01-01 00:00:03.500000"


def test_log_service_status(spark):
    from opsframe.plans import logs
    schema = "hostname string, name string, filesize long, mod_time double"
    apps = spark.createDataFrame([("shop7",), ("shop8",)], "app_id string")
    listing = spark.createDataFrame([("h1", "bundle_shop7_2013-02-04-11.20.05-stderr---supervisor-x.log", 1, 1.0)], schema)
    got = {r["app_id"]: r["status"] for r in logs.log_service_status(listing, apps).collect()}
    assert got == {"shop7": "ok", "shop8": "no_logs"}
    empty = spark.createDataFrame([], schema)
    got = {r["app_id"]: r["status"] for r in logs.log_service_status(empty, apps).collect()}
    assert got == {"shop7": "service_not_available", "shop8": "service_not_available"}

def test_appends_count_once(spark):
    table = os.path.join(tempfile.mkdtemp(prefix="opsframe-append-"), "t")
    schema = "id long, v string"
    rows = lambda *x: spark.createDataFrame(list(x), schema)
    read = lambda: sorted(tuple(r) for r in A.read_table(spark, table, schema).collect())
    A.create_table(rows((1, "a")), table)
    assert A.append_once(rows((2, "b")), table, "r1") and not A.append_once(rows((2, "b")), table, "r1")
    lost = A.stage(rows((9, "never committed")), table, "r2")
    assert read() == [(1, "a"), (2, "b")]
    assert A.append_once(rows((3, "c")), table, "r2") and read() == [(1, "a"), (2, "b"), (3, "c")]
    A.commit(spark, table, "r2", lost)  # a second attempt of a run that is there: the first one still counts
    assert read() == [(1, "a"), (2, "b"), (3, "c")]
    new = spark.createDataFrame([("y", 2), ("x", 1)], "v string, at int")
    for done in (True, False):
        assert A.append_numbered(new, table, "r3", schema, ["at"]) is done
    assert read()[3:] == [(4, "x"), (5, "y")]
    bad = spark.createDataFrame([(1,)], "n long").selectExpr("cast(1 as long) as id", "string(assert_true(n > 1)) as v")
    with pytest.raises(Exception):
        A.append_once(bad, table, "r4")
    assert len(read()) == 5 and A.append_once(rows((6, "d")), table, "r4") and len(read()) == 6


def ports_one_by_one(used, blocked, n, floor):
    out, port = [], max([floor, 1024, *used])
    for _ in range(n):
        port += 1
        while port in blocked:
            port += 1
        out.append((port, "ok") if port <= 25000 else (None, "out_of_ports"))
    return out


def test_free_ports_are_the_next_unblocked_ones(spark):
    rng = random.Random(6)
    hosts = {f"h{i}": ([rng.randrange(9000, 10400) for _ in range(rng.randrange(4))], {rng.randrange(9990, 10450) for _ in range(rng.randrange(60))}, rng.randrange(0, 90))
             for i in range(25)}
    hosts |= {"full": ([24990], {24992, 24993, 24999, 25000, 25003}, 12), "huge": ([], {10001, 17000}, 20000), "over": ([26000], set(), 3), "none": ([], set(), 1)}
    table = lambda k: spark.createDataFrame([(h, p) for h, v in hosts.items() for p in v[k]], "host string, port int")
    req = spark.createDataFrame([(h, v[2]) for h, v in hosts.items()], "host string, n_req int")
    for floor in (10000, 1000):
        got = {(r["host"], r["request_no"]): (r["port"], r["status"]) for r in free_ports(table(0), table(1), req, floor).collect()}
        want = {(h, i): x for h, (u, b, n) in hosts.items() for i, x in enumerate(ports_one_by_one(u, b, n, floor))}
        assert got == want
    assert got["none", 0] == (1025, "ok")
