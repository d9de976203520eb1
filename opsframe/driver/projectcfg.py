"""Driver queries: URLs, source-control reports, repository files and guesses, build configs."""

from __future__ import annotations

from pyspark.sql import functions as F

from opsframe.functions import naming
from opsframe.functions import text as T
from opsframe.operators import filters as Fl
from opsframe.operators import joins as J
from opsframe.operators.windows import keyed_index
from opsframe.plans import projectcfg as P
from opsframe.registry import query
from opsframe.session import new_folder
from opsframe.sources import append
from opsframe.sources.handlers import handlers, source_url_of
from opsframe.sources.roles import Roles, with_roles


def dk_title(x: str) -> str:
    """DuckDB twin of ``text.py_title``."""
    return (f"array_to_string(list_transform(regexp_extract_all({x}, '([A-Za-z]+|[^A-Za-z]+)'), "
            "lambda r: CASE WHEN regexp_matches(r, '^[A-Za-z]') THEN upper(r[1]) || lower(r[2:]) ELSE r END), '')")


def dk_title_from_url(u: str) -> str:
    first = f"list_filter(list_reverse(string_split_regex({u}, '[/.]')), lambda p: NOT starts_with(p, 'git'))[1]"
    return (f"CASE WHEN {u} IS NULL THEN NULL WHEN {first} IS NULL THEN 'Untitled Project' "
            f"ELSE {dk_title(f"replace({first}, '_', ' ')")} END")


@query("url_canonical", oracle=with_roles(
    "SELECT id, rtrim(url, '/') AS canonical_url, rtrim(current_url, '/') AS canonical_current FROM page", "page"))
def q_url_canonical(spark, sf):
    """X-13: URLs without trailing slashes (null stays null)."""
    p = Roles(spark, sf).page
    return p.select("id", T.canonical_url("url").alias("canonical_url"), T.canonical_url("current_url").alias("canonical_current"))


@query("checkout_decision", oracle=with_roles(
    """SELECT id, CASE WHEN current_url IS NULL THEN 'clone' WHEN rtrim(current_url, '/') <> rtrim(url, '/') THEN 'reclone'
                       ELSE 'update' END AS decision FROM page""", "page"))
def q_checkout_decision(spark, sf):
    """X-14: clone / reclone / update for every checkout."""
    p = Roles(spark, sf).page
    return p.select("id", T.checkout_decision("current_url", "url").alias("decision"))


@query("title_from_url", oracle=with_roles(f"SELECT id, {dk_title_from_url('url')} AS title FROM page", "page"))
def q_title_from_url(spark, sf):
    """X-17 / X-19: project title guessed from every repository URL."""
    return Roles(spark, sf).page.select("id", T.title_from_url("url").alias("title"))


def _reports(p):
    kind = F.element_at(F.array(F.lit("git"), F.lit("hg"), F.lit("svn"), F.lit("bzr")), (F.col("id") % 4 + 1).cast("int"))
    report = (F.when(kind == "git", F.concat(F.lit("* remote origin\n  Fetch URL: "), F.col("url"), F.lit(" \n  Push  URL: "),
                                             F.col("url"), F.lit("\n")))
              .when(kind == "hg", F.concat(F.col("url"), F.lit("\n")))
              .when(kind == "svn", F.concat(F.lit("<?xml version=\"1.0\"?>\n<info>\n<entry>\n  <url>"), F.col("url"),
                                            F.lit("</url>\n</entry>\n</info>")))
              .otherwise(F.col("url")))
    return p.select("id", kind.alias("kind"), report.alias("report"))


@query("source_url", oracle=with_roles(
    """SELECT id, kind, CASE kind WHEN 'git' THEN trim(url) WHEN 'hg' THEN url WHEN 'svn' THEN url END AS source_url,
              CASE WHEN kind IN ('git', 'hg', 'svn') THEN 'ok' ELSE 'unknown_kind' END AS status
       FROM (SELECT id, url, ['git', 'hg', 'svn', 'bzr'][id % 4 + 1] AS kind FROM page)""", "page"))
def q_source_url(spark, sf):
    """X-15 / X-16 / E-1: every checkout's reported source URL, read by the
    handler registered for its kind (git remote report, hg config, svn XML)."""
    r = _reports(Roles(spark, sf).page)
    known = F.col("kind").isin(*handlers())
    return r.select("id", "kind", source_url_of(F.col("kind"), F.col("report")).alias("source_url"),
                    F.when(known, F.lit("ok")).otherwise(F.lit("unknown_kind")).alias("status"))


def _file_urls(p):
    host = F.regexp_extract("url", r"^[a-z]+://([^/?#]*)", 1)
    tail = F.regexp_extract("url", r"^[a-z]+://[^/?#]*(/[^?#]*)?", 1)
    form = (F.col("id") % 3).cast("int")
    u = (F.when(form == 0, F.concat(F.lit("file:///srv/"), host, tail))
         .when(form == 1, F.concat(F.lit("file:C|\\repos\\"), host, F.regexp_replace(tail, "/", "\\\\")))
         .otherwise(F.concat(F.lit("file:////share/"), host, F.lit("/a%20b+c/100%x%C3%A9%"), tail)))
    comes = F.when(F.col("id") % 2 == 1, F.col("url"))
    return p.select("id", u.alias("file_url"), comes.alias("comes_from"))


FILE_URL_CTE = """
u AS (SELECT id, CASE id % 3 WHEN 0 THEN 'file:///srv/' || h || t
                             WHEN 1 THEN 'file:C|\\repos\\' || h || replace(t, '/', '\\')
                             ELSE 'file:////share/' || h || '/a%20b+c/100%x%C3%A9%' || t END AS file_url,
             CASE WHEN id % 2 = 1 THEN url END AS comes_from
      FROM (SELECT id, url, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS h,
                   regexp_extract(url, '^[a-z]+://[^/?#]*(/[^?#]*)?', 1) AS t FROM page))"""

FILE_URL_SQL = """
SELECT id, file_url,
       CASE WHEN starts_with(coalesce(comes_from, ''), 'http') THEN 'refused' ELSE 'ok' END AS status,
       CASE WHEN NOT starts_with(coalesce(comes_from, ''), 'http') THEN
         regexp_replace(url_decode(replace(regexp_replace(replace(substr(file_url, 6), '\\', '/'),
                        '^/*([a-zA-Z])\\|', '\\1:'), '+', '%2B')), '^/+', '/') END AS path
FROM u"""


@query("file_url_paths", oracle=with_roles(FILE_URL_SQL, "page", extra=FILE_URL_CTE))
def q_file_url_paths(spark, sf):
    """X-30: ``file:`` requirement URLs → local paths; a ``file:`` URL
    referenced from an http(s) requirements file is refused."""
    u = _file_urls(Roles(spark, sf).page)
    refused = F.coalesce(F.col("comes_from").startswith("http"), F.lit(False))
    return u.select("id", "file_url", F.when(refused, F.lit("refused")).otherwise(F.lit("ok")).alias("status"),
                    F.when(~refused, T.file_url_path("file_url")).alias("path"))


@query("norm_url_paths", oracle=with_roles(
    """SELECT id, CASE WHEN regexp_replace(p, '^/+|/+$', '', 'g') = '' THEN '/'
                       ELSE '/' || regexp_replace(p, '^/+|/+$', '', 'g') || '/' END AS url_path
       FROM (SELECT id, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS p FROM page)""", "page"))
def q_norm_url_paths(spark, sf):
    """X-10: the path of every page URL in site-media form (``/p/`` or ``/``)."""
    p = Roles(spark, sf).page
    return p.select("id", T.normalize_url_path(F.regexp_extract("url", r"^[a-z]+://[^/?#]*([^?#]*)", 1)).alias("url_path"))


MEDIA_TEXT_SQL = """
m AS (SELECT id AS page_id, 'static/ static' || chr(10) || '  ' || p || ' {SITE_PACKAGES}/' || h || chr(10) || chr(10)
             || 'static  static2' || chr(10) || h AS t
      FROM (SELECT id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS h,
                   regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS p FROM page)),
l AS (SELECT page_id, generate_subscripts(a, 1) - 1 AS pos, unnest(a) AS line FROM (SELECT page_id, string_split(t, chr(10)) AS a FROM m)),
e AS (SELECT page_id, pos, line, regexp_replace(line, '^\\s+|\\s+$', '', 'g') AS s FROM l
      WHERE regexp_replace(line, '^\\s+|\\s+$', '', 'g') <> ''),
ok AS (SELECT page_id, CASE WHEN regexp_replace(k, '^/+|/+$', '', 'g') = '' THEN '/'
                            ELSE '/' || regexp_replace(k, '^/+|/+$', '', 'g') || '/' END AS url_path, v, pos
       FROM (SELECT page_id, pos, regexp_extract(s, '^(\\S+)\\s+(.*)$', 1) AS k, regexp_extract(s, '^(\\S+)\\s+(.*)$', 2) AS v
             FROM e WHERE regexp_matches(s, '^(\\S+)\\s+(.*)$')))"""


@query("media_map", oracle=with_roles(
    """SELECT page_id AS project_id, url_path, arg_max(v, pos) AS file_path, min(pos) AS pos, 'ok' AS status
       FROM ok GROUP BY page_id, url_path
       UNION ALL SELECT page_id, NULL, line, pos, 'error' FROM e WHERE NOT regexp_matches(s, '^(\\S+)\\s+(.*)$')""",
    "page", extra=MEDIA_TEXT_SQL))
def q_media_map(spark, sf):
    """X-11 / X-10 / A-9: every page's site (as a project) gets a media map
    text: a repeated url path (last wins), a blank line and a one-token error line."""
    p = Roles(spark, sf).page
    h = F.regexp_extract("url", r"^[a-z]+://([^/?#]*)", 1)
    path = F.regexp_extract("url", r"^[a-z]+://[^/?#]*([^?#]*)", 1)
    text = F.concat(F.lit("static/ static\n  "), path, F.lit(" {SITE_PACKAGES}/"), h, F.lit("\n\nstatic  static2\n"), h)
    m = p.select(F.col("id").alias("project_id"), text.alias("site_media"))
    return P.site_media_entries(m, "site_media").select("project_id", "url_path", "file_path", F.col("pos").cast("bigint").alias("pos"),
                                                        "status")


FILE_CLASS_SQL = """
SELECT id, repo_id, path, cls,
       CAST(CASE WHEN cls = 'settings' THEN row_number() OVER (PARTITION BY repo_id, cls = 'settings' ORDER BY length(path), path, id) END
            AS INTEGER) AS settings_rank
FROM (SELECT id, repo_id, path,
             CASE WHEN ends_with(b, 'settings.py') OR (starts_with(b, 'settings') AND ends_with(b, '.py')) THEN 'settings'
                  WHEN ends_with(b, '.py') THEN 'python'
                  WHEN ends_with(b, 'requirements.txt') OR (starts_with(b, 'requirements') AND ends_with(b, '.txt'))
                       OR (contains(path, 'requirements/') AND ends_with(path, '.txt')) THEN 'requirements' END AS cls
      FROM (SELECT *, regexp_extract(path, '[^/]*$') AS b FROM repofile))"""


@query("bundle_sources", oracle=with_roles(
    "SELECT id, repo_id, path FROM repofile WHERE NOT regexp_matches('/' || path || '/', '/[.](git|svn|hg)/')", "repofile"))
def q_bundle_sources(spark, sf):
    """F-10: the files of every repository that go into a bundle (no source-control metadata)."""
    return Roles(spark, sf).repofile.filter(Fl.copied_source("path")).select("id", "repo_id", "path")


@query("file_classes", oracle=with_roles(FILE_CLASS_SQL, "repofile"))
def q_file_classes(spark, sf):
    """F-11 / S-15 / T-2: every repository file classified; settings files
    ranked shortest path first (ties by path)."""
    rf = Roles(spark, sf).repofile.select("id", "repo_id", "path", Fl.file_class("path").alias("cls"))
    st = keyed_index(rf.filter(F.col("cls") == "settings").withColumn("len", F.length("path")), ["repo_id"], ["len", "path", "id"], "at")
    return (rf.filter(F.coalesce(F.col("cls"), F.lit("")) != "settings").withColumn("settings_rank", F.lit(None).cast("int"))
            .unionByName(st.withColumn("settings_rank", (F.col("at") + 1).cast("int")).drop("len", "at")))


def _ini_text(p):
    """Every project's build config rendered as INI text, in variants: without a database host
    ``extra_requirements`` is left out; the version may come from ``[DEFAULT]``; comments stand behind
    values; some files hold a line that is no INI."""
    sid = naming.sysid("id")
    extra = F.when(F.col("db_host").isNotNull(), F.lit("Extra_Requirements: \n")).otherwise(F.lit(""))
    version = F.when(F.col("owner_id") % 3 == 0, "").otherwise("django_version: 1.3 ; the usual\n")
    broken = F.when(F.col("owner_id") % 7 == 0, "this line is nothing\n").otherwise("")
    return p.select(F.col("id").alias("project_id"), F.concat(
        F.lit("[DEFAULT]\ndjango_version = 1.2\n[project]\nsource: git://example.com/"), sid, F.lit(".git\ntitle: "), F.col("title"),
        F.lit("\n"), version, F.lit("database_type = "), F.col("database_type"),
        F.lit("\nbase_python_package: "), F.coalesce(F.col("hostname_slug"), F.lit('""')),
        F.lit("\ndjango_settings_module: "), sid, F.lit(".live\n; media\nREM folders\nsite_media_map: pics var/pics\n  docs {SITE_PACKAGES}/docs\n\n"
                                                         "  logos pics/logos\nadditional_python_path_dirs: "), sid,
        F.lit("_lib\nrequirements_files = \n"), extra, broken, F.lit("[other]\ndjango_version: 9.9\n")).alias("text"))


BUILD_SQL = """
SELECT project_id, CASE WHEN fine THEN base END AS base_python_package, CASE WHEN fine THEN sid || '.live' END AS django_settings_module,
       CASE WHEN fine THEN 'pics var/pics' || chr(10) || 'docs {SITE_PACKAGES}/docs' || chr(10) || 'logos pics/logos' END AS site_media_map,
       CASE WHEN fine THEN sid || '_lib' END AS additional_python_path_dirs, CASE WHEN fine THEN '' END AS requirements_files,
       CASE WHEN fine AND has_extra THEN '' END AS extra_requirements, CASE WHEN fine THEN version END AS django_version,
       CASE WHEN fine THEN database_type END AS database_type,
       CASE WHEN NOT fine THEN 'base_python_package,django_settings_module,site_media_map,additional_python_path_dirs,requirements_files,extra_requirements,django_version,database_type'
            WHEN has_extra THEN '' ELSE 'extra_requirements' END AS missing,
       CASE WHEN NOT fine THEN 'unparsable' WHEN has_extra THEN 'ok' ELSE 'error' END AS status
FROM (SELECT id AS project_id, printf('p%08d', id) AS sid, coalesce(hostname_slug, '') AS base, db_host IS NOT NULL AS has_extra,
             owner_id % 7 <> 0 AS fine, CASE WHEN owner_id % 3 = 0 THEN '1.2' ELSE '1.3' END AS version, database_type FROM project)"""


@query("build_config", oracle=with_roles(BUILD_SQL, "project"))
def q_build_config(spark, sf):
    """S-13 / F-9: every project's build config text parsed back into its 8
    required ``[project]`` keys (continuation lines folded, other sections
    ignored); a missing key is an error."""
    return P.build_config(_ini_text(Roles(spark, sf).project), "project_id")


# the repositories' settings files assign ROOT_URLCONF on a line of its own, with either quotation mark
_URLCONF_DK = """nullif(regexp_extract(regexp_extract(chr(10) || content, '\\nROOT_URLCONF *= *[^\\n]*'), '[''"]([^''"]*)[''"]', 1), '')"""


def _repo_urls(rf):
    return rf.select("repo_id").distinct().select(
        "repo_id", F.concat(F.lit("git://example.com/repo_"), F.col("repo_id").cast("string"), F.lit(".git")).alias("url"))


GUESS_CTES = f"""
f AS (SELECT repo_id, path, content, regexp_extract(path, '[^/]*$') AS b FROM repofile),
py AS (SELECT repo_id, path AS py_path FROM f WHERE ends_with(path, '.py')),
st AS (SELECT repo_id, path, {_URLCONF_DK} AS urlconf FROM f
       WHERE ends_with(b, 'settings.py') OR (starts_with(b, 'settings') AND ends_with(b, '.py'))),
stp AS (SELECT *, string_split(urlconf, '.') AS parts, len(string_split(urlconf, '.')) AS n,
               replace(urlconf, '.', '/') || '.py' AS suffix FROM st WHERE coalesce(urlconf, '') <> ''),
m1 AS (SELECT s.repo_id, s.path, min(p.py_path) AS found FROM stp s JOIN py p ON p.repo_id = s.repo_id
       AND ends_with(p.py_path, s.suffix) GROUP BY s.repo_id, s.path),
s1 AS (SELECT s.*, rtrim(substr(m1.found, 1, length(m1.found) - length(s.suffix)), '/') AS pydir
       FROM stp s JOIN m1 ON m1.repo_id = s.repo_id AND m1.path = s.path),
g1 AS (SELECT repo_id, path, 'base_python_package' AS field, '' AS value FROM s1
       UNION ALL SELECT repo_id, path, 'additional_python_path_dirs',
              CASE WHEN n > 1 THEN pydir || chr(10) || CASE WHEN pydir = '' THEN array_to_string(parts[1:n-1], '/')
                                                           ELSE pydir || '/' || array_to_string(parts[1:n-1], '/') END
                   ELSE pydir END FROM s1
       UNION ALL SELECT repo_id, path, 'django_settings_module',
              CASE WHEN starts_with(path, pydir)
                   THEN replace(ltrim(substr(path, length(pydir) + 1, length(path) - length(pydir) - 3), '/'), '/', '.')
                   WHEN pydir = '' THEN 'settings.py' ELSE pydir || '/settings.py' END FROM s1),
rest AS (SELECT s.* FROM stp s WHERE NOT EXISTS (SELECT 1 FROM m1 WHERE m1.repo_id = s.repo_id AND m1.path = s.path)),
m2 AS (SELECT c.repo_id, c.path, c.parts, min(c.d) AS d FROM
         (SELECT r.repo_id, r.path, r.parts, r.n, d.d FROM rest r, LATERAL (SELECT unnest(range(0, r.n)) AS d) d) c
       JOIN py p ON p.repo_id = c.repo_id AND p.py_path = array_to_string(c.parts[c.d + 1:], '/') || '.py'
       GROUP BY c.repo_id, c.path, c.parts),
g2 AS (SELECT repo_id, path, 'base_python_package' AS field, array_to_string(parts[1:d], '.') AS value FROM m2
       UNION ALL SELECT repo_id, path, 'django_settings_module',
              array_to_string(parts[1:d], '.') || '.' || substr(replace(path, '/', '.'), 1, length(path) - 3) FROM m2),
b0 AS (SELECT r.* FROM rest r WHERE NOT EXISTS (SELECT 1 FROM m2 WHERE m2.repo_id = r.repo_id AND m2.path = r.path)),
bx AS (SELECT b0.*,
              EXISTS (SELECT 1 FROM f WHERE f.repo_id = b0.repo_id AND (f.path = replace(b0.urlconf, '.', '/') || '.py'
                                                                       OR f.path = replace(b0.urlconf, '.', '/') || '/__init__.py')) AS e1,
              EXISTS (SELECT 1 FROM f WHERE f.repo_id = b0.repo_id AND f.path = regexp_extract(b0.urlconf, '[^.]*$') || '.py') AS e2
       FROM b0),
g3 AS (SELECT repo_id, path, 'django_settings_module' AS field,
              substr(regexp_extract(path, '[^/]*$'), 1, length(regexp_extract(path, '[^/]*$')) - 3) AS value FROM bx
       UNION ALL SELECT repo_id, path, 'base_python_package',
              CASE WHEN e1 THEN '' WHEN contains(urlconf, '.') THEN regexp_extract(urlconf, '^(.*)\\.[^.]*$', 1) ELSE urlconf END
       FROM bx WHERE e1 OR e2),
g AS (SELECT * FROM g1 UNION ALL SELECT * FROM g2 UNION ALL SELECT * FROM g3),
hits AS (SELECT DISTINCT repo_id, path FROM g),
reqs AS (SELECT repo_id, string_agg(path, chr(10) ORDER BY path) AS names FROM f
         WHERE NOT ends_with(b, '.py') AND (ends_with(b, 'requirements.txt') OR (starts_with(b, 'requirements') AND ends_with(b, '.txt'))
               OR (contains(path, 'requirements/') AND ends_with(path, '.txt'))) GROUP BY repo_id),
greq AS (SELECT h.repo_id, h.path, 'requirements_file_names' AS field, coalesce(r.names, '') AS value
         FROM hits h LEFT JOIN reqs r ON r.repo_id = h.repo_id),
prim AS (SELECT repo_id, path,
                coalesce(max(CAST(hit AS INTEGER)) OVER (PARTITION BY repo_id ORDER BY length(path), path
                                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0 AS is_primary
         FROM (SELECT st.repo_id, st.path, h.path IS NOT NULL AS hit FROM st
               LEFT JOIN hits h ON h.repo_id = st.repo_id AND h.path = st.path)),
guesses AS (
  SELECT x.repo_id, x.field, x.value, p.is_primary, x.path AS basis
  FROM (SELECT * FROM g UNION ALL SELECT * FROM greq) x JOIN prim p ON p.repo_id = x.repo_id AND p.path = x.path
  UNION ALL
  SELECT repo_id, 'title', {dk_title_from_url("'git://example.com/repo_' || CAST(repo_id AS VARCHAR) || '.git'")}, true, ''
  FROM (SELECT DISTINCT repo_id FROM hits))"""


@query("config_guesses", oracle=with_roles("SELECT * FROM guesses", "repofile", extra=GUESS_CTES))
def q_config_guesses(spark, sf):
    """C-5 / J-9 / W-1 / X-18 / X-26 / S-5: configuration guesses for every
    repository (each repository's URL is ``git://example.com/repo_<id>.git``)."""
    rf = Roles(spark, sf).repofile
    return P.config_guesses(rf.select("repo_id", "path", "content"), _repo_urls(rf))


GUESS_SCHEMA = "id bigint, project_id bigint, field string, value string, is_primary boolean, basis string"


@query("append_guesses", oracle=with_roles(
    """SELECT row_number() OVER (ORDER BY repo_id, basis, field) AS id, repo_id AS project_id, field, value, is_primary, basis FROM guesses""",
    "repofile", extra=GUESS_CTES))
def q_append_guesses(spark, sf):
    """S-5: the guesses of C-5 appended exactly once to an empty table, with dense ids; the run is executed twice."""
    table = new_folder(spark, "configguess")
    guesses = q_config_guesses(spark, sf).withColumnRenamed("repo_id", "project_id")
    append.create_table(spark.createDataFrame([], GUESS_SCHEMA), table)
    for _ in range(2):
        append.append_numbered(guesses, table, "check-1", GUESS_SCHEMA, ["project_id", "basis", "field"])
    return append.read_table(spark, table, GUESS_SCHEMA)


@query("dangling_links", oracle=with_roles(
    """SELECT l.repo_id, l.path, l.target FROM
         (SELECT id, repo_id, path, CASE id % 3 WHEN 0 THEN 'docs/' || path WHEN 1 THEN 'proj/models.py' ELSE string_split(path, '/')[-1] END AS target FROM repofile) l
       WHERE NOT EXISTS (SELECT 1 FROM repofile r WHERE r.repo_id = l.repo_id AND r.path = l.target)""", "repofile"))
def q_dangling_links(spark, sf):
    """J-12: symbolic links of every checkout whose target is missing; every file has a link, to a copy
    under docs/, to proj/models.py or to its own name at the root."""
    rf = Roles(spark, sf).repofile
    target = (F.when(F.col("id") % 3 == 0, F.concat(F.lit("docs/"), F.col("path"))).when(F.col("id") % 3 == 1, F.lit("proj/models.py"))
              .otherwise(F.element_at(F.split("path", "/"), -1)))
    return J.dangling_links(rf.select("repo_id", "path", target.alias("target")), rf, "target", "path", "repo_id")


# ---- fixed values: supported framework versions → install line and caption ----
VERSIONS = [
    ("1.2", "Django==1.2.7", "Django-1.2 latest (currently 1.2.7)"),
    ("1.3", "Django==1.3.1", "Django-1.3.1 latest (currently 1.3.1)"),
]
VERSION_DEFAULT = "1.3.1"  # the platform's default; note it is not itself a key
# ------------------------------------------------------------------------------

_VERSION_OF = "CASE owner_id % 3 WHEN 0 THEN '1.2' WHEN 1 THEN '1.3' ELSE '1.3.1' END"
_VALUES = ", ".join(f"('{v}', '{line}', '{cap}')" for v, line, cap in VERSIONS)


def _versions_df(spark):
    return spark.createDataFrame(VERSIONS, "django_version string, install_line string, caption string")


def _project_versions(p):
    v = F.when(F.col("owner_id") % 3 == 0, "1.2").when(F.col("owner_id") % 3 == 1, "1.3").otherwise(VERSION_DEFAULT)
    return p.select("id", v.alias("django_version"))


@query("version_lookup", oracle=with_roles(
    f"""SELECT p.id, p.django_version, v.install_line,
               CASE WHEN v.install_line IS NULL THEN 'unknown_version' ELSE 'ok' END AS status
        FROM (SELECT id, {_VERSION_OF} AS django_version FROM project) p
        LEFT JOIN (VALUES {_VALUES}) v(django_version, install_line, caption) ON v.django_version = p.django_version""",
    "project"))
def q_version_lookup(spark, sf):
    """J-15: every project's framework version → install line (broadcast of a
    fixed dimension); the default ``1.3.1`` is not a key → unknown_version."""
    p = _project_versions(Roles(spark, sf).project)
    return J.version_lookup(p, _versions_df(spark)).select("id", "django_version", "install_line", "status")


@query("version_choices", oracle=with_roles(
    f"""SELECT p.django_version, v.caption, count(*) AS n_projects
        FROM (SELECT {_VERSION_OF} AS django_version FROM project) p
        JOIN (VALUES {_VALUES}) v(django_version, install_line, caption) ON v.django_version = p.django_version
        GROUP BY p.django_version, v.caption ORDER BY p.django_version DESC""", "project"))
def q_version_choices(spark, sf):
    """T-4: version choices in use, newest first (string order), with captions."""
    p = _project_versions(Roles(spark, sf).project)
    used = p.groupBy("django_version").agg(F.count(F.lit(1)).alias("n_projects"))
    return (used.join(F.broadcast(_versions_df(spark)), "django_version")
            .select("django_version", "caption", "n_projects").orderBy(F.desc("django_version")))


# Requirement files of every project, in folders (this library's own fixture text; the
# rules only pick which variant a project gets, from its own columns). The same table feeds
# the oracle, which parses and resolves with patterns and a recursion of its own.
def _req_lines(p):
    sid = naming.sysid("id")
    dbt = F.col("database_type")
    rows = [
        ("requirements.txt", 0, F.concat(F.lit("# requirements for "), sid)),
        ("requirements.txt", 1, F.lit("--requirement=req/base.txt")),
        ("requirements.txt", 2, F.lit("Flask_Thing == 1.3.1")),
        ("requirements.txt", 3, F.lit("json5==2.1.1  # json support")),
        ("requirements.txt", 4, F.concat(F.lit("-e git+git://example.com/"), sid, F.lit(".git#egg="), sid)),
        ("requirements.txt", 5, F.concat(F.lit("http://example.com/tarball/"), sid, F.lit("#egg=extra_"), F.col("id").cast("string"))),
        ("requirements.txt", 6, F.lit("")),
        ("requirements.txt", 7, F.when(dbt == "automobile", F.lit("tag-cloud<>0.3")).otherwise(F.lit("tag-cloud>=0.3, <0.4"))),
        ("requirements.txt", 8, F.lit("images[png, jpeg] >= 2.0")),
        ("req/base.txt", 0, F.lit("-i http://index.example.com/simple/")),
        ("req/base.txt", 1, F.concat(F.lit("--find-links=http://links.example.com/"), F.col("owner_id").cast("string"))),
        ("req/base.txt", 2, F.lit("Migrate==0.7.2")),
        ("req/base.txt", 3, F.when(dbt == "building", F.lit("FLASK-thing==1.2.7")).otherwise(F.lit("zones"))),
        ("req/base.txt", 4, F.lit("-r ./more/deep.txt")),
        ("req/more/deep.txt", 0, F.lit("-r ../../common.txt")),
        ("req/more/deep.txt", 1, F.when(dbt == "household", F.lit("-r missing.txt")).when(dbt == "machinery", F.lit("-r ../base.txt"))
                                  .when(dbt == "furniture", F.lit("-r http://example.com/all.txt")).otherwise(F.lit("deep.pkg"))),
        ("common.txt", 0, F.lit("common_lib~=3.1")),
        ("unused.txt", 0, F.lit("never==1")),
    ]
    arr = F.array(*[F.struct(F.lit(f).alias("file"), F.lit(n).alias("line_no"), v.alias("line")) for f, n, v in rows])
    return p.select(F.col("id").alias("project_id"), F.explode(arr).alias("r")).select("project_id", "r.*")


REQ_IGNORE = ["MIGRATE"]

REQ_SQL = """SELECT * FROM (
WITH RECURSIVE rf AS (
  SELECT id AS project_id, v.file, v.line_no, CASE
      WHEN v.line = '@sid' THEN '# requirements for ' || printf('p%08d', id)
      WHEN v.line = '@edit' THEN '-e git+git://example.com/' || printf('p%08d', id) || '.git#egg=' || printf('p%08d', id)
      WHEN v.line = '@tar' THEN 'http://example.com/tarball/' || printf('p%08d', id) || '#egg=extra_' || id
      WHEN v.line = '@links' THEN '--find-links=http://links.example.com/' || owner_id
      WHEN v.line = '@tag' THEN CASE WHEN database_type = 'automobile' THEN 'tag-cloud<>0.3' ELSE 'tag-cloud>=0.3, <0.4' END
      WHEN v.line = '@zone' THEN CASE WHEN database_type = 'building' THEN 'FLASK-thing==1.2.7' ELSE 'zones' END
      WHEN v.line = '@deep' THEN CASE database_type WHEN 'household' THEN '-r missing.txt' WHEN 'machinery' THEN '-r ../base.txt'
                                 WHEN 'furniture' THEN '-r http://example.com/all.txt' ELSE 'deep.pkg' END
      ELSE v.line END AS line
  FROM project, (VALUES
    ('requirements.txt', 0, '@sid'), ('requirements.txt', 1, '--requirement=req/base.txt'), ('requirements.txt', 2, 'Flask_Thing == 1.3.1'),
    ('requirements.txt', 3, 'json5==2.1.1  # json support'), ('requirements.txt', 4, '@edit'), ('requirements.txt', 5, '@tar'),
    ('requirements.txt', 6, ''), ('requirements.txt', 7, '@tag'), ('requirements.txt', 8, 'images[png, jpeg] >= 2.0'),
    ('req/base.txt', 0, '-i http://index.example.com/simple/'), ('req/base.txt', 1, '@links'), ('req/base.txt', 2, 'Migrate==0.7.2'),
    ('req/base.txt', 3, '@zone'), ('req/base.txt', 4, '-r ./more/deep.txt'), ('req/more/deep.txt', 0, '-r ../../common.txt'),
    ('req/more/deep.txt', 1, '@deep'), ('common.txt', 0, 'common_lib~=3.1'), ('unused.txt', 0, 'never==1')) v(file, line_no, line)),
clean AS (SELECT *, trim(split_part(' ' || line, ' #', 1)) AS s FROM rf),
tok AS (SELECT *, CASE WHEN starts_with(s, '-r ') THEN trim(s[4:]) WHEN starts_with(s, '--requirement=') THEN s[15:] END AS target FROM clean),
aimed AS (SELECT *, CASE WHEN contains(target, '://') THEN target ELSE
    regexp_replace(regexp_replace(replace('/' || array_to_string(string_split(file, '/')[1:len(string_split(file, '/')) - 1], '/') || '/' || target, '/./', '/'),
      '[^/]+/[.][.]/', ''), '[^/]+/[.][.]/', '') END AS raw FROM tok),
item AS (SELECT project_id, file, line_no, line, s, target, CASE WHEN contains(target, '://') THEN raw ELSE ltrim(replace(raw, '//', '/'), '/') END AS goal FROM aimed),
walk AS (
  SELECT project_id, file, line, s, target, goal, [CAST(0 AS BIGINT), line_no] AS ord, [file] AS chain FROM item WHERE file = 'requirements.txt'
  UNION ALL
  SELECT i.project_id, i.file, i.line, i.s, i.target, i.goal, list_append(w.ord, i.line_no), list_append(w.chain, i.file)
  FROM walk w JOIN item i ON i.project_id = w.project_id AND i.file = w.goal WHERE w.target IS NOT NULL AND NOT list_contains(w.chain, w.goal)),
flaws AS (SELECT project_id, ord, goal AS line, CASE WHEN contains(goal, '://') THEN 'remote_include'
            WHEN list_contains(chain, goal) THEN 'include_cycle' ELSE 'unreadable' END AS status
          FROM walk w WHERE target IS NOT NULL AND (contains(goal, '://') OR list_contains(chain, goal)
            OR NOT EXISTS (SELECT 1 FROM rf WHERE rf.project_id = w.project_id AND rf.file = w.goal))),
entry AS (SELECT project_id, 0 AS part, ord, line, s FROM walk WHERE target IS NULL AND s <> ''
          UNION ALL SELECT id, 1, [CAST(0 AS BIGINT)], 'gunicorn==0.12.1', 'gunicorn==0.12.1' FROM project),
kind AS (SELECT *, CASE WHEN starts_with(s, '--find-links=') THEN 'links' WHEN starts_with(s, '-i ') THEN 'index' WHEN starts_with(s, '-e ') THEN 'edit'
                        WHEN contains(s, '://') THEN 'url' WHEN contains(s, '<>') THEN 'bad' ELSE 'spec' END AS k FROM entry),
named AS (SELECT *, CASE k WHEN 'edit' THEN split_part(s, '#egg=', 2) WHEN 'url' THEN replace(split_part(s, '#egg=', 2), '_', '-')
                           WHEN 'spec' THEN replace(regexp_extract(s, '^[A-Za-z0-9._-]+'), '_', '-') END AS dist FROM kind),
good AS (SELECT *, lower(dist) AS key FROM named WHERE k <> 'bad' AND (dist IS NULL OR lower(dist) <> 'migrate')),
keyed AS (SELECT *, part || '.' || array_to_string(list_transform(ord, lambda x: lpad(CAST(x AS VARCHAR), 19, '0')), '.') AS ord_key FROM good)
SELECT project_id, CASE k WHEN 'links' THEN 0 WHEN 'index' THEN 1 ELSE 2 END AS section, ord_key,
       CASE k WHEN 'links' THEN s WHEN 'index' THEN '--extra-index-url=' || trim(s[4:]) WHEN 'edit' THEN s WHEN 'url' THEN dist
              ELSE dist || replace(s[length(dist) + 1:], ' ', '') END AS line, 'ok' AS status FROM keyed
UNION ALL SELECT project_id, -1, part || '.' || array_to_string(list_transform(ord, lambda x: lpad(CAST(x AS VARCHAR), 19, '0')), '.'), line, 'bad_syntax' FROM named WHERE k = 'bad'
UNION ALL SELECT project_id, -1, '', key, 'duplicate' FROM good WHERE key IS NOT NULL GROUP BY project_id, key HAVING count(*) > 1
UNION ALL SELECT project_id, -1, '0.' || array_to_string(list_transform(ord, lambda x: lpad(CAST(x AS VARCHAR), 19, '0')), '.'), line, status FROM flaws)"""


@query("requirements", oracle=with_roles(REQ_SQL, "project"))
def q_requirements(spark, sf):
    """C-6 / S-14 / X-25 / X-29 / A-8 / U-3: requirements of every project:
    ``-r`` includes resolved relative to their file, ``Migrate`` excluded (case-insensitive), duplicate
    keys, bad syntax and missing files reported, output ordered find-links →
    index options → requirement lines (sort by section, ord_key)."""
    p = Roles(spark, sf).project
    files = _req_lines(p)
    top = p.select(F.col("id").alias("project_id"), F.lit("requirements.txt").alias("file"), F.lit(0).alias("file_order"))
    extra = p.select(F.col("id").alias("project_id"), F.explode(F.array(
        F.struct(F.lit(0).alias("line_no"), F.lit("gunicorn==0.12.1").alias("line")),
        F.struct(F.lit(1).alias("line_no"), F.lit("   ").alias("line")))).alias("e")).select("project_id", "e.*")
    return P.assemble_requirements(P.requirement_lines(files, top), extra, REQ_IGNORE)
