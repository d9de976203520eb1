"""Column functions against the exact values of the reference's tests and Python semantics."""

from pyspark.sql import functions as F

from opsframe.functions.naming import ROOT_DOMAIN as ROOT

from opsframe.functions import naming, text as T
from opsframe.operators import filters as Fl


def one(spark, expr, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(expr(F.col("v")).alias("o")).first()["o"]


def test_sysid_keeps_wide_ids(spark):
    assert one(spark, naming.sysid, 2, "bigint") == "p00000002"
    assert one(spark, naming.sysid, 1234567890, "bigint") == "p1234567890"  # lpad would cut this
    assert one(spark, naming.canonical_host, 2, "bigint") == f"p00000002.{ROOT}"


def test_truncate_revision_5000_chars(spark):
    out = one(spark, naming.truncate_revision, "x" * 5000)
    assert len(out) == 512 and out.endswith("...")
    assert one(spark, naming.truncate_revision, None) == ""
    assert one(spark, naming.truncate_revision, "abc") == "abc"


def test_bundle_name_roundtrip(spark):
    df = spark.createDataFrame([("bundle_p00000002_2011-05-11-02.50.14",)], "n string")
    r = df.select(naming.bundle_name_app("n").alias("a"), naming.bundle_name_time("n").alias("t")).first()
    assert r["a"] == "p00000002" and str(r["t"]) == "2011-05-11 02:50:14"


def test_worker_conf_name_last_port_marker(spark):
    rows = [("p1.bundle_x.port.10001.conf",), ("p1.b.port.1.port.x.conf",), ("p1.b.port.2.port.3.conf",), ("noport.conf",)]
    out = [r["w"] for r in spark.createDataFrame(rows, "f string").select(naming.worker_conf_parts("f").alias("w")).collect()]
    assert (out[0]["app_id"], out[0]["bundle_name"], out[0]["port"]) == ("p1", "bundle_x", 10001)
    assert out[1] is None                       # last ".port." part is "x": skipped
    assert (out[2]["bundle_name"], out[2]["port"]) == ("b.port.2", 3)
    assert out[3] is None


def test_supervisor_log_names(spark):
    f = "bundle_shop_7_2013-02-04-11.20.05-stderr---supervisor-q1.log"
    assert one(spark, naming.supervisor_log_app, f) == "shop_7"
    assert one(spark, naming.supervisor_log_stream, f) == "stderr"


def test_python_title_case(spark):
    for s in ["o'neil 3d my_app", "hello world", "x", "", "ABC def"]:
        assert one(spark, T.py_title, s) == s.title()


def test_title_from_url(spark):
    assert one(spark, T.title_from_url, "git://git.example.com/teams/flowerShop.git") == "Flowershop"
    assert one(spark, T.title_from_url, "http://example.com/my_project/") == ""   # trailing slash quirk
    assert one(spark, T.title_from_url, "git.git") == "Untitled Project"


def test_url_paths_and_canonical(spark):
    assert one(spark, T.normalize_url_path, "static") == "/static/"
    assert one(spark, T.normalize_url_path, "//") == "/"
    assert one(spark, T.canonical_url, "http://a/b///") == "http://a/b"
    assert one(spark, T.canonical_url, None) is None


def test_file_url_path(spark):
    assert one(spark, T.file_url_path, "file:///tmp/a%20b+c") == "/tmp/a b+c"
    assert one(spark, T.file_url_path, "file:C|\\dir\\x.txt") == "C:/dir/x.txt"
    assert one(spark, T.file_url_path, "http://x") is None
    assert one(spark, T.file_url_path, "file:///a%20b/100%x/c%C3%A9%2") == "/a b/100%x/cé%2"
    assert one(spark, T.file_url_path, "file:%%41%zz%") == "%A%zz%"


def test_split_lines_matches_python(spark):
    for s in ["a\nb\n", "a\r\nb", "", "\n", "a\n\nb", "x\ry"]:
        got = one(spark, T.split_lines, s)
        assert list(got) == s.splitlines(), s


def test_reports(spark):
    git = "* remote origin\n  Fetch URL: git://x/y.git \n  Push  URL: git://x/y.git\n"
    assert one(spark, T.git_fetch_url, git) == "git://x/y.git"
    assert one(spark, T.git_fetch_url, "nothing") is None
    svn = '<?xml version="1.0"?>\n<info>\n  <url>svn://x/trunk</url>\n</info>'
    assert one(spark, T.svn_url, svn) == "svn://x/trunk"
    kv = one(spark, T.kv_pair, "Server: nginx: 1.0")
    assert (kv["key"], kv["value"]) == ("Server", "nginx: 1.0")
    assert list(one(spark, T.command_args, "  manage.py   syncdb --noinput ")) == ["manage.py", "syncdb", "--noinput"]
    assert list(one(spark, T.command_args, "   ")) == []


def test_subcommand_section(spark):
    help_text = "Usage\nAvailable subcommands:\n  old\nAvailable subcommands:\n  collectstatic\n  migrate\n"
    assert list(one(spark, T.subcommand_section, help_text)) == ["", "collectstatic", "migrate"]
    assert one(spark, T.subcommand_section, "no marker") is None


def test_predicates(spark):
    assert one(spark, Fl.safe_identifier, "bundle_p1-2") is True
    assert one(spark, Fl.safe_identifier, "bad\n") is False      # Python $ would accept this
    assert one(spark, Fl.safe_identifier, "bad name!") is False
    classes = {p: one(spark, Fl.file_class, p) for p in
               ["proj/settings.py", "settings_dev.py", "urls.py", "requirements.txt", "proj/requirements/base.txt",
                "requirements-dev.txt", "README.txt"]}
    assert classes == {"proj/settings.py": "settings", "settings_dev.py": "settings", "urls.py": "python",
                       "requirements.txt": "requirements", "proj/requirements/base.txt": "requirements",
                       "requirements-dev.txt": "requirements", "README.txt": None}
    assert one(spark, Fl.port_eligible, 1024, "int") is False
    assert one(spark, Fl.port_eligible, 25000, "int") is True
    assert one(spark, Fl.port_eligible, 25001, "int") is False


def test_gunicorn_titles(spark):
    t = one(spark, T.gunicorn_title, "gunicorn: master ['bundle_p00000031_2013-02-04-11.20.05 on :10321']")
    assert (t["kind"], t["bundle_name"], t["port"]) == ("master", "bundle_p00000031_2013-02-04-11.20.05", 10321)
    assert one(spark, T.gunicorn_title, "python manage.py") is None


def test_signal_and_first_reply(spark):
    from opsframe.plans.logs import first_nonempty_reply
    assert one(spark, Fl.signal_allowed, "TTIN") is True
    assert one(spark, Fl.signal_allowed, "KILL") is False
    replies = spark.createDataFrame([(1, 0, ""), (1, 1, "page from b"), (1, 2, "page from c"), (2, 0, None), (2, 1, "")],
                                    "req long, pos int, reply string")
    got = {r["req"]: r["result"] for r in first_nonempty_reply(replies, "req").collect()}
    assert got == {1: "page from b", 2: ""}
