"""Project configuration: guesses, build config, media map, requirements."""

from pyspark.sql import functions as F

from opsframe.plans import projectcfg as P


def test_config_guesses_golden(spark):
    files = spark.createDataFrame([
        (1, "requirements.txt", ""),
        (1, "src/harbour/settings.py", "DEBUG = True\nROOT_URLCONF = 'harbour.urls'\n"),
        (1, "src/harbour/urls.py", "urlpatterns = []\n"),
        (1, "src/harbour/__init__.py", ""),
        (1, "src/harbour/requirements/base.txt", "Django==1.3\n"),
    ], "repo_id long, path string, content string")
    urls = spark.createDataFrame([(1, "git://example.org/someone/harbour.git")], "repo_id long, url string")
    g = [r.asDict() for r in P.config_guesses(files, urls).collect()]
    assert len(g) == 5
    by = {r["field"]: r for r in g}
    assert by["additional_python_path_dirs"]["value"] == "src\nsrc/harbour"
    assert by["requirements_file_names"]["value"] == "requirements.txt\nsrc/harbour/requirements/base.txt"
    assert by["django_settings_module"]["value"] == "harbour.settings"
    assert by["base_python_package"]["value"] == ""
    assert by["title"]["value"] == "Harbour" and by["title"]["basis"] == ""
    assert all(r["is_primary"] for r in g)


def test_config_guesses_strategy_two_and_primary(spark):
    files = spark.createDataFrame([
        (1, "settings.py", "ROOT_URLCONF = 'mysite.urls'"),
        (1, "urls.py", ""),
        (1, "conf/settings_dev.py", "X = 1"),
    ], "repo_id long, path string, content string")
    urls = spark.createDataFrame([(1, "http://example.com/mysite")], "repo_id long, url string")
    g = {(r["field"], r["basis"]): (r["value"], r["is_primary"]) for r in P.config_guesses(files, urls).collect()}
    assert g[("base_python_package", "settings.py")] == ("mysite", True)
    assert g[("django_settings_module", "settings.py")] == ("mysite.settings", True)
    assert not any(b == "conf/settings_dev.py" for _, b in g)   # no ROOT_URLCONF → no guesses


BUILD_CFG = """[DEFAULT]
django_version = 1.2
[project]
Title = Harbour
database_type = sqlite ; the small one
base_python_package =
django_settings_module = harbour.conf.live
site_media_map = pics var/pics
\tdocs {SITE_PACKAGES}/docs
    pics other/pics
additional_python_path_dirs = lib_extra
requirements_files = ""
extra_requirements =
"""


def test_build_config_and_media_map(spark):
    texts = spark.createDataFrame([(1, BUILD_CFG), (2, BUILD_CFG.replace("database_type", "x_type")), (3, BUILD_CFG + "no separator here\n"), (4, "a = 1\n[project]\n"), (5, None)],
                                  "id long, text string")
    cfg = {r["id"]: r for r in P.build_config(texts, "id").collect()}
    assert cfg[1]["status"] == "ok" and cfg[1]["django_version"] == "1.2"      # inherited from [DEFAULT]
    assert cfg[1]["database_type"] == "sqlite" and cfg[1]["requirements_files"] == "" and cfg[1]["base_python_package"] == ""
    assert cfg[1]["site_media_map"] == "pics var/pics\ndocs {SITE_PACKAGES}/docs\npics other/pics"
    assert cfg[2]["status"] == "error" and cfg[2]["missing"] == "database_type"
    assert cfg[3]["status"] == "unparsable" and cfg[4]["status"] == "unparsable" and cfg[5]["status"] == "error"
    media = P.site_media_entries(texts.filter("id = 1").select(F.col("id").alias("project_id"),
                                                              F.lit(cfg[1]["site_media_map"]).alias("m")), "m")
    got = {r["url_path"]: r["file_path"] for r in media.collect()}
    assert got == {"/pics/": "other/pics", "/docs/": "{SITE_PACKAGES}/docs"}


def reqs(spark, files, extra=None, ignore=()):
    f = spark.createDataFrame([(1, name, i, line) for name, lines in files.items() for i, line in enumerate(lines)],
                              "project_id long, file string, line_no int, line string")
    top = spark.createDataFrame([(1, name, k) for k, name in enumerate(files) if not name.startswith("_")],
                                "project_id long, file string, file_order int")
    ex = None
    if extra is not None:
        ex = spark.createDataFrame([(1, i, line) for i, line in enumerate(extra)], "project_id long, line_no int, line string")
    out = P.assemble_requirements(P.requirement_lines(f, top), ex, list(ignore))
    return [r.asDict() for r in out.orderBy("section", "ord_key").collect()]


def test_requirement_forms(spark):
    rows = reqs(spark, {"forms.txt": [
        "# every kind of line", "--index-url=http://index.example.org/", "-e hg+http://example.org/tool#egg=tool_kit",
        "http://example.org/pack.zip#egg=pack_er", "-f http://files.example.org", "plain", "Some_Name [fast, tls] >= 1.0, != 1.3  # why",
        "http://example.org/nameless.zip"]})
    assert [r["line"] for r in rows] == [
        "--find-links=http://files.example.org", "--extra-index-url=http://index.example.org/",
        "-e hg+http://example.org/tool#egg=tool_kit", "pack-er", "plain", "Some-Name[fast,tls]>=1.0,!=1.3", "http://example.org/nameless.zip"]


def test_requirements_include_ignore_duplicate_errors(spark):
    files = {"main.txt": ["-r _sub/base.txt", "alpha==2", "Beta_pkg==1.3"], "_sub/base.txt": ["-r ../_common.txt", "gamma==0.7"],
             "_common.txt": ["delta.x==0.2"]}
    plain = reqs(spark, files, ["omega", " "])
    lines = [r["line"] for r in plain if r["status"] == "ok"]
    assert lines == ["delta.x==0.2", "gamma==0.7", "alpha==2", "Beta-pkg==1.3", "omega"]
    assert [r["line"] for r in reqs(spark, files, ["omega"], ignore=["BETA-PKG"]) if r["status"] == "ok"] == [x for x in lines if "Beta" not in x]
    assert [r["line"] for r in reqs(spark, files, ["beta-PKG==9", "BETA_pkg"]) if r["status"] == "duplicate"] == ["beta-pkg"]
    for line, status in (("<>", "bad_syntax"), ("-r nothere.txt", "unreadable"), ("-r ../a.txt", "unreadable"), ("-r http://example.org/r.txt", "remote_include")):
        assert [r["status"] for r in reqs(spark, {"a.txt": [line]})] == [status]


def test_requirement_cycles_end_and_chains_are_whole(spark):
    cyc = reqs(spark, {"a.txt": ["-r _b.txt", "x==1"], "_b.txt": ["-r a.txt", "-r _b.txt", "y==1"]})
    assert sorted(r["line"] for r in cyc if r["status"] == "include_cycle") == ["_b.txt", "a.txt"]
    twice = reqs(spark, {"a.txt": ["-r a.txt", "-r a.txt", "z"]})
    assert [r["status"] for r in twice].count("include_cycle") == 2 and len(twice) == 3
    chain = {"f0.txt": ["-r _f1.txt", "p0"], **{f"_f{i}.txt": [f"-r _f{i + 1}.txt", f"p{i}"] for i in range(1, 12)}, "_f12.txt": ["p12"]}
    assert [r["line"] for r in reqs(spark, chain)] == [f"p{i}" for i in range(12, -1, -1)]


def test_files_that_include_each_other_end_with_one_row_an_include(spark):
    names = ["f0.txt", *(f"_f{i}.txt" for i in range(1, 12))]
    out = reqs(spark, {n: [*(f"-r {m}" for m in names if m != n), f"p{i}"] for i, n in enumerate(names)})
    assert [r["status"] for r in out].count("include_cycle") == 11 * 11  # all but the includes that lead to a file first
    assert sorted(r["line"] for r in out if r["status"] == "ok") == sorted(f"p{i}" for i in range(12))


def test_two_cycles_and_a_way_between(spark):
    out = reqs(spark, {"a.txt": ["-r _b.txt", "-r _m.txt", "-r _c.txt"], "_b.txt": ["-r a.txt", "pb"], "_m.txt": ["-r _c.txt", "pm"],
                       "_c.txt": ["-r _d.txt", "pc"], "_d.txt": ["-r _c.txt", "-r _b2.txt", "pd"], "_b2.txt": ["p2"]})
    assert sorted(r["line"] for r in out if r["status"] == "include_cycle") == ["_c.txt", "a.txt"]
    # c is included by a and by m: its lines come twice, with their duplicates told
    lines = [r["line"] for r in out if r["status"] == "ok"]
    assert lines == ["pb", "p2", "pd", "pc", "pm", "p2", "pd", "pc"]
    assert sorted(r["line"] for r in out if r["status"] == "duplicate") == ["p2", "pc", "pd"]


def test_an_include_of_a_file_on_the_same_level_is_no_cycle(spark):
    out = reqs(spark, {"a.txt": ["-r _b.txt", "-r _c.txt"], "_b.txt": ["pb"], "_c.txt": ["-r _b.txt", "-r _none.txt", "pc"]})
    assert [(r["line"], r["status"]) for r in out if r["status"] != "duplicate"] == [("_none.txt", "unreadable"), ("pb", "ok"), ("pb", "ok"), ("pc", "ok")]


def test_requirement_order_of_long_files(spark):
    f = spark.createDataFrame([(1, "a.txt", n, f"p{n}") for n in (999_999, 1_000_000, 1_000_001, 10_000_000_000, 5)], "project_id long, file string, line_no long, line string")
    top = spark.createDataFrame([(1, "a.txt", 0)], "project_id long, file string, file_order int")
    ex = spark.createDataFrame([(1, 0, "last")], "project_id long, line_no int, line string")
    out = P.assemble_requirements(P.requirement_lines(f, top), ex, []).orderBy("section", "ord_key").collect()
    assert [r["line"] for r in out] == ["p5", "p999999", "p1000000", "p1000001", "p10000000000", "last"]


def test_setting_value(spark):
    src = [("ROOT_URLCONF = 'a.urls'\n",), ("X = f()\nROOT_URLCONF = other_name\n",), ("def (:\n",), ("if True:\n    ROOT_URLCONF = 'x'\n",),
           ("'''a docstring\nROOT_URLCONF = 'no'\n'''\nROOT_URLCONF = u'b.urls'\nROOT_URLCONF = 'c.urls'\n",)]
    df = spark.createDataFrame(src, "c string")
    exact = [tuple(r["e"]) for r in df.select(P.setting_value_exact("c", "ROOT_URLCONF").alias("e")).collect()]
    # unparsable files are skipped; the first top-level assignment counts
    assert exact == [("a.urls", True), ("other_name", True), (None, False), (None, True), ("b.urls", True)]


def test_ini_edge_cases(spark):
    text = "# comment\n[project]\nTitle: first\n; another comment\ntitle = second\nmap: a b\n   c d\n\n   e f\n[other]\ntitle: x\n"
    ini = spark.createDataFrame([(1, text)], "id long, text string").select(P.ini_items("text").alias("i")).first()["i"]
    assert not ini["bad"] and ini["sections"] == ["project", "other"]
    assert [tuple(x) for x in ini["items"]] == [  # option names lower-cased, continuation lines folded, blank lines skipped
        ("project", "title", "first"), ("project", "title", "second"), ("project", "map", "a b\nc d\ne f"), ("other", "title", "x")]
