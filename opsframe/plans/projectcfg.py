"""Project configuration: site media maps, build configs, requirements, repo guesses.

Text arrives as a column (one row per project / file). Lines are exploded with
their position, parsed with column expressions, and folded back per key with
``max_by``/``min_by`` (last / first wins) — never collected to the driver.
"""

from __future__ import annotations

import ast

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsframe.functions import text as T
from opsframe.session import cut_lineage


def site_media_entries(df: DataFrame, text_col: str, key: str = "project_id") -> DataFrame:
    """X-10 / X-11 / A-9: site media map text → one row per (key, url_path).

    Blank lines are skipped; a one-token line is an ``error`` row (the
    reference raises on it). A url path given twice keeps the last file path
    (dict assignment) at the position of its first appearance.
    Output: (key, url_path, file_path, pos, status).
    """
    lines = (df.select(key, F.posexplode(T.split_lines(F.col(text_col))).alias("pos", "line"))
             .filter(T.strip_ws("line") != ""))
    parsed = lines.select(key, "pos", "line", T.media_entry("line").alias("e"))
    from opsframe.operators.aggregates import last_wins_map

    entries = parsed.filter(F.col("e").isNotNull()).select(key, "pos", "e.url_path", "e.file_path")
    ok = last_wins_map(entries, [key], "url_path", "file_path", "pos").withColumn("status", F.lit("ok"))
    bad = parsed.filter(F.col("e").isNull()).select(
        key, F.lit(None).cast("string").alias("url_path"), F.col("line").alias("file_path"), "pos",
        F.lit("error").alias("status"))
    return ok.unionByName(bad)


def _pjoin(a, b):
    """``os.path.join(a, b)`` for a relative ``b``."""
    return F.when(a == "", b).when(a.endswith("/"), F.concat(a, b)).otherwise(F.concat(a, F.lit("/"), b))


def config_guesses(files: DataFrame, src_url: DataFrame) -> DataFrame:
    """C-5: configuration guesses for every repository at once.

    ``files``: (repo_id, path, content) — every file of every checkout;
    ``src_url``: (repo_id, url). Walk order is path ascending. Output rows:
    (repo_id, field, value, is_primary, basis).

    One row per settings file carries everything needed: its ROOT_URLCONF
    (X-26), the strategy-1 match (J-9 suffix join, first in walk order), the
    strategy-2 divide point (X-18, exact-path equi-join) and the root-file
    flags of the base case — each computed once and left-joined on
    (repo, path). The guesses are then an ``explode`` of that row, so no
    sub-result is recomputed per branch. Every settings file with a
    non-empty ROOT_URLCONF yields at least the base-case guess, so W-1's
    "has guesses" is simply ``urlconf != ''``.
    """
    from opsframe.functions.text import title_from_url
    from opsframe.operators.filters import file_class
    from opsframe.operators.joins import first_suffix_match
    from opsframe.operators.windows import primary_until_first_hit

    keys = ["repo_id", "path"]
    paths = files.select("repo_id", "path")
    py = paths.filter(F.col("path").endswith(".py")).withColumnRenamed("path", "py_path")
    # Python's own parser, on settings files only; files it can't parse are left out of everything
    parsed = cut_lineage(files.filter(file_class("path") == "settings").select(*keys, setting_value_exact("content", "ROOT_URLCONF").alias("v")))
    skipped = parsed.filter(~F.col("v.parsed")).select(*keys)
    py = py.join(skipped.withColumnRenamed("path", "py_path"), ["repo_id", "py_path"], "left_anti")
    st = (parsed.filter("v.parsed").select(*keys, F.col("v.value").alias("urlconf"))
          .withColumn("hit", F.coalesce(F.col("urlconf"), F.lit("")) != "")
          .withColumn("len", F.length("path")))
    st = primary_until_first_hit(st, "repo_id", ["len", "path"], "hit")
    stp = (st.filter("hit").select(*keys, "urlconf", "is_primary")
           .withColumn("parts", F.split("urlconf", r"\."))
           .withColumn("n", F.size("parts"))
           .withColumn("suffix", F.concat(F.regexp_replace("urlconf", r"\.", "/"), F.lit(".py"))))

    # strategy 1 candidate: first python file ending with the urlconf path
    m1 = first_suffix_match(stp.select(*keys, "suffix"), py, "repo_id", "suffix", "py_path", "found").select(*keys, "found")
    # strategy 2 candidate: smallest divide point whose rest is a python file
    cand = stp.select(*keys, "parts", "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("d"))
    cand = cand.select(*keys, "d", F.concat(F.array_join(F.slice("parts", F.col("d") + 1, F.col("n")), "/"),
                                            F.lit(".py")).alias("py_path"))
    m2 = cand.join(py, ["repo_id", "py_path"]).groupBy(*keys).agg(F.min("d").alias("d"))
    # base case: which candidate files exist at the repository root
    as_path = F.regexp_replace("urlconf", r"\.", "/")
    last = F.regexp_extract("urlconf", r"[^.]*$", 0)
    probes = stp.select(*keys, F.explode(F.array(
        F.struct(F.lit(1).alias("k"), F.concat(as_path, F.lit(".py")).alias("p")),
        F.struct(F.lit(1).alias("k"), F.concat(as_path, F.lit("/__init__.py")).alias("p")),
        F.struct(F.lit(2).alias("k"), F.concat(last, F.lit(".py")).alias("p")))).alias("x")).select(*keys, "x.k", "x.p")
    found = (probes.join(paths.withColumnRenamed("path", "p"), ["repo_id", "p"], "left_semi")
             .groupBy(*keys).agg(F.max(F.col("k") == 1).alias("e1"), F.max(F.col("k") == 2).alias("e2")))

    r = (stp.join(m1, keys, "left").join(m2, keys, "left").join(found, keys, "left")
         .withColumn("pydir", F.regexp_replace(F.expr("substring(found, 1, length(found) - length(suffix))"), "/+$", "")))
    pydir, path, n = F.col("pydir"), F.col("path"), F.col("n")
    s1, s2 = F.col("found").isNotNull(), F.col("found").isNull() & F.col("d").isNotNull()
    s3 = F.col("found").isNull() & F.col("d").isNull()
    addl = F.when(n > 1, F.concat(pydir, F.lit("\n"), _pjoin(pydir, F.array_join(F.slice("parts", 1, n - 1), "/")))).otherwise(pydir)
    short = F.regexp_replace(F.expr("substring(path, length(pydir) + 1, length(path) - length(pydir) - 3)"), "^/+", "")
    dsm1 = F.when(path.startswith(pydir), F.regexp_replace(short, "/", ".")).otherwise(_pjoin(pydir, F.lit("settings.py")))
    base2 = F.array_join(F.slice("parts", 1, F.coalesce(F.col("d"), F.lit(0))), ".")
    dsm2 = F.concat(base2, F.lit("."), F.expr("substring(replace(path, '/', '.'), 1, length(path) - 3)"))
    fname = F.element_at(F.split("path", "/"), -1)
    dsm3 = F.expr("substring(element_at(split(path, '/'), -1), 1, length(element_at(split(path, '/'), -1)) - 3)")
    head = F.when(F.col("urlconf").contains("."), F.regexp_extract("urlconf", r"^(.*)\.[^.]*$", 1)).otherwise(F.col("urlconf"))
    e1, e2 = F.coalesce(F.col("e1"), F.lit(False)), F.coalesce(F.col("e2"), F.lit(False))
    bpp3 = F.when(e1, F.lit("")).when(e2, head)

    def g(cond, field, value):
        return F.when(cond, F.struct(F.lit(field).alias("field"), value.alias("value")))

    guesses = F.array_compact(F.array(
        g(s1, "base_python_package", F.lit("")),
        g(s1, "additional_python_path_dirs", addl),
        g(s1, "django_settings_module", dsm1),
        g(s2, "base_python_package", base2),
        g(s2, "django_settings_module", dsm2),
        g(s3, "django_settings_module", dsm3),
        g(s3 & (e1 | e2), "base_python_package", bpp3)))
    out = (r.select("repo_id", "path", "is_primary", F.explode(guesses).alias("g"))
           .select("repo_id", "g.field", "g.value", "is_primary", F.col("path").alias("basis")))

    reqs = (files.filter(file_class("path") == "requirements").groupBy("repo_id")
            .agg(F.array_join(F.sort_array(F.collect_list("path")), "\n").alias("names")))
    greq = (stp.join(reqs, "repo_id", "left")
            .select("repo_id", F.lit("requirements_file_names").alias("field"), F.coalesce("names", F.lit("")).alias("value"),
                    "is_primary", F.col("path").alias("basis")))
    title = (stp.select("repo_id").distinct().join(src_url, "repo_id")
             .select("repo_id", F.lit("title").alias("field"), title_from_url(F.col("url")).alias("value"),
                     F.lit(True).alias("is_primary"), F.lit("").alias("basis")))
    return out.unionByName(greq).unionByName(title)


# ---- S-13: build config (INI) ----------------------------------------------

# The keys every build config must define in its [project] section (fixed values).
BUILD_KEYS = ("base_python_package", "django_settings_module", "site_media_map", "additional_python_path_dirs",
              "requirements_files", "extra_requirements", "django_version", "database_type")

INI_SECTION_RE = r"^\[([^\]]+)\]"
INI_OPTION_RE = r"^([^:=\s][^:=]*?)\s*[:=]\s*(.*)$"
INI_DEFAULT = "DEFAULT"


def ini_items(text):
    """S-13: one INI text folded inside its row (no shuffle) into
    struct(bad, sections, items: (section, option, value) in file order).

    RawConfigParser's rules: blank lines, lines that begin with ``#`` or ``;``
    or the word ``rem`` are skipped; an indented line continues the option
    before it; option names are lower-cased; a value ends before `` ;`` and
    ``""`` is empty. A line that is none of these, or an option before any
    section, makes the text ``bad``.
    """
    line = lambda x: F.regexp_extract(x, INI_OPTION_RE, 2)
    value = lambda x: F.regexp_replace(T.strip_ws(F.regexp_replace(line(x), r"^(.*?)\s;.*$", "$1")), '^""$', "")
    item = "struct<section:string,option:string,value:string>"
    start = F.struct(F.lit(None).cast("string").alias("section"), F.lit(False).alias("open"), F.lit(False).alias("bad"),
                     F.array().cast("array<string>").alias("sections"), F.array().cast(f"array<{item}>").alias("items"))

    def state(acc, **changed):
        return F.struct(*[changed.get(c, acc[c]).alias(c) for c in ("section", "open", "bad", "sections", "items")])

    def step(acc, x):
        last = F.try_element_at(acc["items"], F.lit(-1))
        longer = F.concat(F.slice(acc["items"], 1, F.greatest(F.size(acc["items"]) - 1, F.lit(0))), F.array(F.struct(
            last["section"].alias("section"), last["option"].alias("option"), F.concat_ws("\n", last["value"], T.strip_ws(x)).alias("value"))))
        section = F.regexp_extract(x, INI_SECTION_RE, 1)
        more = F.concat(acc["items"], F.array(F.struct(
            acc["section"].alias("section"), F.lower(T.strip_ws(F.regexp_extract(x, INI_OPTION_RE, 1))).alias("option"), value(x).alias("value"))))
        return (F.when((T.strip_ws(x) == "") | x.rlike(r"^[#;]") | x.rlike(r"^(?i)rem(\s|$)"), state(acc))
                .when(x.rlike(r"^\s") & acc["open"], state(acc, items=longer))
                .when(x.rlike(INI_SECTION_RE), state(acc, section=section, open=F.lit(False), sections=F.concat(acc["sections"], F.array(section))))
                .when(x.rlike(INI_OPTION_RE) & acc["section"].isNotNull(), state(acc, open=F.lit(True), items=more))
                .otherwise(state(acc, bad=F.lit(True))))

    return F.aggregate(F.coalesce(T.split_lines(F.col(text)), F.array().cast("array<string>")), start, step)


def build_config(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """S-13 + F-9: one row per config with the 8 required ``[project]`` keys,
    each the section's last value, else the one of ``[DEFAULT]``; ``missing``
    lists absent keys (all, without the section). ``status``: ``ok``,
    ``error`` (keys missing) or ``unparsable``."""
    d = texts.select(key, ini_items(text).alias("ini"))
    of = lambda section, k: F.try_element_at(F.filter("ini.items", lambda x: (x["section"] == section) & (x["option"] == k)), F.lit(-1))["value"]
    known = ~F.col("ini.bad") & F.array_contains("ini.sections", "project")
    out = d.select(key, "ini", *[F.when(known, F.coalesce(of("project", k), of(INI_DEFAULT, k))).alias(k) for k in BUILD_KEYS])
    miss = F.array_compact(F.array(*[F.when(F.col(k).isNull(), F.lit(k)) for k in BUILD_KEYS]))
    return (out.withColumn("missing", F.array_join(miss, ","))
            .withColumn("status", F.when(F.col("ini.bad"), F.lit("unparsable")).when(F.col("missing") == "", F.lit("ok")).otherwise(F.lit("error")))
            .drop("ini"))


# ---- C-6 / S-14 / X-25 / X-29 / A-8 / U-3: requirements assembly ------------

REQ_INCLUDE_RE = r"^(?:-r|--requirement)(?:\s+|=)(\S+)$"
REQ_FIND_LINKS_RE = r"^(?:-f|--find-links)(?:\s+|=)(\S+)$"
REQ_INDEX_RE = r"^(?:-i|--index-url|--extra-index-url)(?:\s+|=)(\S+)$"
REQ_EDITABLE_RE = r"^(?:-e|--editable)(?:\s+|=)(\S+)$"
REQ_URL_RE = r"^[A-Za-z][A-Za-z0-9+.-]*:\S+$"
REQ_EGG_RE = r"#egg=([^&\s]+)"
_OP = r"(?:==|>=|<=|!=|~=|>|<)\s*[A-Za-z0-9.*+!_-]+"
REQ_SPEC_RE = r"^([A-Za-z0-9][A-Za-z0-9._-]*)\s*(\[[A-Za-z0-9._, -]*\])?\s*(" + _OP + r"(?:\s*,\s*" + _OP + r")*)?$"
REQ_COMMENT_RE = r"(^|\s)+#.*$"
REQ_ADDRESS_RE = r"^[A-Za-z][A-Za-z0-9+.-]*://"


def safe_name(c):
    """A distribution name as it is printed: runs outside letters, digits and dots become one dash."""
    return F.regexp_replace(c, r"[^A-Za-z0-9.]+", "-")


def _ord_key(part, c):
    """Sortable text of (part, line numbers down the include chain), whatever their size."""
    return F.concat_ws(".", part.cast("string"), F.array_join(F.transform(c, lambda x: F.lpad(x.cast("string"), 19, "0")), "."))


def included_path(parent, target):
    """The path a ``-r`` line names: relative to the folder of the file it stands in, ``.`` and ``..`` resolved."""
    folder = F.regexp_extract(parent, r"^(.*/)?[^/]*$", 1)
    whole = F.when(target.startswith("/"), target).otherwise(F.concat(folder, target))
    up = lambda acc: (F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1)) != "..")
    parts = F.aggregate(
        F.split(whole, "/"), F.array().cast("array<string>"),
        lambda acc, x: F.when(x.isin("", "."), acc).when((x == "..") & F.coalesce(up(acc), F.lit(False)), F.slice(acc, 1, F.size(acc) - 1))
        .otherwise(F.concat(acc, F.array(x))))
    return F.concat(F.when(whole.startswith("/"), "/").otherwise(""), F.array_join(parts, "/"))


FILE = ["project_id", "file"]


def shuffled(df: DataFrame) -> DataFrame:
    """The side of a join that must not be broadcast: how many files and lines a project has is not in
    the estimate of its size, which is that of the projects' compressed columns."""
    return df.hint("merge")


def include_levels(top: DataFrame, edges: DataFrame) -> DataFrame:
    """(project_id, file, level): the files reachable from the top files, each at
    its least number of includes. Semi-naive: a round joins only the files that
    the round before found, and a file is found once however many chains lead to it."""
    found = frontier = cut_lineage(top.select(*FILE).distinct().withColumn("level", F.lit(0)))
    level = 0
    while True:
        level += 1
        frontier = cut_lineage(frontier.join(shuffled(edges), FILE).select("project_id", F.col("target").alias("file")).distinct()
                               .join(shuffled(found), FILE, "left_anti").withColumn("level", F.lit(level)))
        if frontier.isEmpty():
            return found
        found = found.unionByName(frontier)
        if level % 16 == 0:  # keep the plan of very deep includes small
            found = cut_lineage(found)


def cyclic_files(edges: DataFrame) -> DataFrame:
    """(project_id, file, cycle) of the files that lie on an include cycle; files that
    include each other, directly or not, have the same ``cycle``.

    Files that nothing includes, or that include nothing, are peeled off until none is
    left. In what remains a file takes the greatest name that leads to it; the files of
    that name from which it can be reached back are one cycle. They are taken out and
    the rest, if any, goes round again."""
    def settled(df, step):
        while True:
            new = cut_lineage(step(df))
            if new.count() == df.count():
                return new
            df = new

    def peeled(e):
        return settled(e, lambda x: x.join(shuffled(x.select("project_id", F.col("file").alias("target")).distinct()), ["project_id", "target"], "left_semi")
                       .join(shuffled(x.select("project_id", F.col("target").alias("file")).distinct()), FILE, "left_semi").select(*FILE, "target"))

    rest = peeled(cut_lineage(edges.select(*FILE, "target").distinct()))
    done = None
    while not rest.isEmpty():
        color = rest.select(*FILE).distinct().withColumn("cycle", F.col("file"))
        before = None
        while True:
            into = rest.join(shuffled(color), FILE).select("project_id", F.col("target").alias("file"), "cycle")
            color = cut_lineage(color.unionByName(into).groupBy(*FILE).agg(F.max("cycle").alias("cycle")))
            now = color.agg(F.sum(F.xxhash64(*FILE, "cycle").cast("decimal(38,0)"))).first()[0]
            if now == before:
                break
            before = now
        same = (rest.join(shuffled(color), FILE).join(shuffled(color.select("project_id", F.col("file").alias("target"), F.col("cycle").alias("other"))), ["project_id", "target"])
                .filter("cycle = other").select(*FILE, "target", "cycle"))
        found = color.filter("file = cycle")
        found = settled(cut_lineage(found), lambda x: x.unionByName(
            same.join(shuffled(x.select("project_id", F.col("file").alias("target"), "cycle")), ["project_id", "target", "cycle"]).select(*FILE, "cycle")).distinct())
        done = found if done is None else cut_lineage(done.unionByName(found))
        out = found.select("project_id", F.col("file").alias("target"))
        rest = peeled(cut_lineage(rest.join(shuffled(found), FILE, "left_anti").join(shuffled(out), ["project_id", "target"], "left_anti")))
    return done if done is not None else edges.limit(0).select(*FILE, F.col("file").alias("cycle"))


def requirement_lines(files: DataFrame, top: DataFrame) -> DataFrame:
    """S-14 + include closure: every line reachable from the top files, with an
    order key = array of line numbers down the include chain (arrays compare
    lexicographically, so included lines land at their include line).

    The closure is over the graph of files, with one row per ``-r`` line, and
    lines are joined once, at the end. A file lies at its least number of
    includes from a top file. An include that closes a cycle - of a file that
    leads back to the including one and lies no deeper - is one
    ``include_cycle`` row, at the place of the first chain to the line; the
    other includes form a graph without cycles, along which the order keys are
    carried, one row per file and chain. A file that isn't there is
    ``unreadable``, an address is ``remote_include`` (nothing is fetched).
    ``files``: (project_id, file, line_no, line); ``top``: (project_id, file, file_order).
    Output: (project_id, ord, line, status) — status ``ok`` or an include error.
    """
    f = cut_lineage(files.select(*FILE, F.col("line_no").cast("bigint").alias("line_no"), "line")
                    .withColumn("include", F.regexp_extract(T.strip_ws(F.regexp_replace("line", REQ_COMMENT_RE, "")), REQ_INCLUDE_RE, 1)))
    known = f.select(*FILE).distinct()
    address = F.col("include").rlike(REQ_ADDRESS_RE)
    includes = (f.filter("include <> ''")
                .withColumn("target", F.when(address, F.col("include")).otherwise(included_path(F.col("file"), F.col("include"))))
                .join(shuffled(known.select("project_id", F.col("file").alias("target"), F.lit(True).alias("known"))), ["project_id", "target"], "left")
                .select(*FILE, "line_no", "target", F.when(address, "remote_include").when(F.col("known").isNull(), "unreadable").alias("problem")))
    includes = cut_lineage(includes)
    edges = includes.filter("problem is null").select(*FILE, "line_no", "target")
    top = top.join(shuffled(known), FILE, "left_semi")
    levels = include_levels(top, edges)
    at = (edges.join(shuffled(levels), FILE)
          .join(shuffled(levels.select("project_id", F.col("file").alias("target"), F.col("level").alias("deep"))), ["project_id", "target"]))
    # a cycle needs an include that leads no deeper; mostly there is none
    back = cut_lineage(at.filter("deep <= level").select(*FILE, "line_no", "target"))
    if back.isEmpty():
        closing = back
    else:
        cycle = cyclic_files(at.join(shuffled(back.select("project_id").distinct()), "project_id", "left_semi"))
        ends = cycle.select("project_id", F.col("file").alias("target"), F.col("cycle").alias("other"))
        closing = cut_lineage(back.join(shuffled(cycle), FILE).join(shuffled(ends), ["project_id", "target"])
                              .filter("cycle = other").select(*FILE, "line_no", "target"))
    edges = cut_lineage(edges.join(shuffled(closing.select(*FILE, "line_no")), [*FILE, "line_no"], "left_anti"))
    chains = step = cut_lineage(top.select(*FILE, F.array(F.col("file_order").cast("bigint")).alias("ord")))
    while True:
        step = cut_lineage(step.join(shuffled(edges), FILE).select("project_id", F.col("target").alias("file"), F.concat("ord", F.array("line_no")).alias("ord")))
        if step.isEmpty():
            break
        chains = chains.unionByName(step)
    place = F.concat("ord", F.array("line_no")).alias("ord")
    plain = f.filter("include = ''").join(shuffled(chains), FILE).select("project_id", place, "line", F.lit("ok").alias("status"))
    problems = includes.filter("problem is not null").join(shuffled(chains), FILE).select("project_id", place, F.col("target").alias("line"), F.col("problem").alias("status"))
    firsts = chains.join(shuffled(closing.select(*FILE).distinct()), FILE, "left_semi").groupBy(*FILE).agg(F.min("ord").alias("ord"))
    cycles = closing.join(shuffled(firsts), FILE).select("project_id", place, F.col("target").alias("line"), F.lit("include_cycle").alias("status"))
    return plain.unionByName(problems).unionByName(cycles)


def assemble_requirements(lines: DataFrame, extra: DataFrame | None, ignore_keys: list[str]) -> DataFrame:
    """C-6 / X-25 / X-29 / A-8 / U-3: parse, exclude, check and order.

    ``lines``: output of ``requirement_lines``; ``extra``: (project_id,
    line_no, line) appended after all files (blank ones skipped). Output:
    (project_id, section, ord_key, line, status): section 0 find-links,
    1 index options (``-i`` becomes ``--extra-index-url=``), 2 requirement
    lines, -1 errors (bad_syntax, duplicate, unreadable, include_cycle, remote_include).
    Names are printed with other characters as dashes, extras stay; the key is
    the name in lower case, so ``foo_bar`` and ``Foo-Bar`` are duplicates.
    Excluded keys (case-insensitive) are dropped before duplicate detection;
    lines without a key (options, errors, URLs without an egg name) take no
    part in it and don't meet in one window.

    One pass: each input row yields its output row, and the first row of a
    key seen more than once also yields the ``duplicate`` row (a window over
    the (project, key) group — a handful of rows — instead of a second scan).
    """
    from pyspark.sql import Window

    all_lines = lines.withColumn("part", F.lit(0))
    if extra is not None:  # extra lines are a part of their own, after every file
        ex = extra.filter(T.strip_ws("line") != "").select(
            "project_id", F.array(F.col("line_no").cast("bigint")).alias("ord"), "line", F.lit("ok").alias("status"), F.lit(1).alias("part"))
        all_lines = all_lines.unionByName(ex)
    d = all_lines.withColumn("s", T.strip_ws(F.regexp_replace("line", REQ_COMMENT_RE, "")))
    d = d.filter((F.col("status") != "ok") | (F.col("s") != ""))
    s = F.col("s")
    is_fl, is_ix, is_ed = s.rlike(REQ_FIND_LINKS_RE), s.rlike(REQ_INDEX_RE), s.rlike(REQ_EDITABLE_RE)
    is_url, is_spec = s.rlike(REQ_URL_RE), s.rlike(REQ_SPEC_RE)
    egg = safe_name(F.regexp_extract(s, REQ_EGG_RE, 1))
    name = safe_name(F.regexp_extract(s, REQ_SPEC_RE, 1))
    spec = F.concat(name, F.regexp_replace(F.concat(F.regexp_extract(s, REQ_SPEC_RE, 2), F.regexp_extract(s, REQ_SPEC_RE, 3)), r"\s+", ""))
    d = d.select(
        "project_id", "part", "ord", "line", "status",
        F.when(is_fl, 0).when(is_ix, 1).when(is_ed | is_url | is_spec, 2).alias("section"),
        F.when(is_fl, F.concat(F.lit("--find-links="), F.regexp_extract(s, REQ_FIND_LINKS_RE, 1)))
         .when(is_ix, F.concat(F.lit("--extra-index-url="), F.regexp_extract(s, REQ_INDEX_RE, 1)))
         .when(is_ed, F.concat(F.lit("-e "), F.regexp_extract(s, REQ_EDITABLE_RE, 1)))
         .when(is_url, F.when(egg != "", egg).otherwise(F.regexp_extract(s, REQ_URL_RE, 0)))
         .when(is_spec, spec).alias("out"),
        F.when(is_fl | is_ix, F.lit(None).cast("string"))
         .when(is_ed | is_url, F.when(egg != "", F.lower(egg)))
         .when(is_spec, F.lower(name)).alias("key"))
    ok = (F.col("status") == "ok") & F.col("section").isNotNull()
    ignore = [k.lower() for k in ignore_keys]
    if ignore:
        d = d.filter(~(ok & F.coalesce(F.col("key").isin(ignore), F.lit(False))))
    counted = ok & F.col("key").isNotNull()
    place = F.struct("part", "ord")
    # rows without a key get one from their place, so that they spread over partitions
    w = Window.partitionBy("project_id", F.coalesce("key", _ord_key(F.col("part"), F.col("ord"))), counted)
    d = (d.withColumn("__n", F.when(counted, F.count(F.lit(1)).over(w)))
         .withColumn("__first", F.when(counted, F.min(place).over(w))))
    key_ord = _ord_key(F.col("part"), F.col("ord"))
    main = F.struct(
        F.when(ok, F.col("section")).otherwise(F.lit(-1)).alias("section"), key_ord.alias("ord_key"),
        F.when(ok, F.col("out")).otherwise(F.col("line")).alias("line"),
        F.when(F.col("status") != "ok", F.col("status")).when(ok, F.lit("ok")).otherwise(F.lit("bad_syntax")).alias("status"))
    dup = F.when((F.col("__n") > 1) & (place == F.col("__first")), F.struct(
        F.lit(-1).alias("section"), F.lit("").alias("ord_key"), F.col("key").alias("line"), F.lit("duplicate").alias("status")))
    return (d.select("project_id", F.explode(F.array_compact(F.array(main, dup))).alias("r"))
            .select("project_id", "r.section", "r.ord_key", "r.line", "r.status"))


# ---- X-26 exact mode: Python's own parser in an Arrow-batched UDF ----------

def _settings_exact(name: str):
    def first_value(src):
        if src is None:
            return None, False
        try:
            tree = ast.parse(src)
        except (SyntaxError, ValueError):
            return None, False      # unparsable: skipped with a note, as the reference does
        for part in tree.body:
            if not isinstance(part, ast.Assign) or not isinstance(part.targets[0], ast.Name):
                continue
            v = part.value
            if isinstance(v, ast.Name):
                val = v.id
            elif isinstance(v, ast.Constant) and isinstance(v.value, str):
                val = v.value
            else:
                continue
            if part.targets[0].id == name:
                return val, True
        return None, True

    def fn(s: pd.Series) -> pd.DataFrame:
        out = [first_value(x) for x in s]
        return pd.DataFrame({"value": [o[0] for o in out], "parsed": [o[1] for o in out]})

    return fn


def setting_value_exact(content, name: str):
    """X-26 exact mode: struct(value, parsed) from Python's ``ast`` — the first
    top-level ``NAME = 'str'`` / ``NAME = name`` assignment; ``parsed`` is
    false for sources Python cannot parse. An Arrow-batched pandas UDF: a
    small per-row helper, used only where the regex mode is not enough."""
    udf = F.pandas_udf(_settings_exact(name), "value string, parsed boolean")
    return udf(F.col(content) if isinstance(content, str) else content)
