"""Hostname table (C-3a), routing table (C-3) and proxy site text (C-4).

Shapes (all set-wide, one plan for every project at once):

* ``hostnames(project, vhost)`` → one row per (project, host name) with the
  order keys ``branch`` (0 canonical, 1 slug host, 2 virtual hosts) and ``pos``
  (vhost id * 2 + 0 for ``*.h`` / + 1 for ``h``). No de-duplication (U-1).
* ``routing_table(...)`` → one row per project: status, served bundle (max
  active bundle id, A-6), multi-bundle warning, counts.
* ``routing_upstreams(...)`` → the served bundle's deployments as rows. The
  upstream list is kept as rows, not collected, so a project that owns a
  large share of all deployments never becomes one in-memory list.
* ``site_config_lines(...)`` → the rendered nginx site file as ordered rows
  (app, section, ord, line), ready for ``write.partitionBy("app_id").text``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsframe.functions import naming
from opsframe.operators.filters import active_filter
from opsframe.operators.windows import keyed_index
from opsframe.sources.files import FILE_ORDER, read_text_folders, write_text_folders

ADMIN_MEDIA_URL_PATH = "/_admin_media/"      # default url path of the admin's media (a parameter)

FILE_ROWS = 50                               # about how many lines the site file of an app has

# ---- fixed values of the proxy site file ----------------------------------
ADMIN_MEDIA_BUNDLE_PATH = "lib/python2.6/site-packages/django/contrib/admin/media"
SITE_PACKAGES_SUBDIR = "lib/python2.6/site-packages"
SRC_PACKAGES_SUBDIR = "src"
USER_REPO_SUBDIR = "user-repo"
CUSTOMER_DIR = "/cust"
UPSTREAM_OPTIONS = "max_fails=2  fail_timeout=10s"
SERVER_OPTIONS = ("listen 80", "client_max_body_size 1G")
CONNECTION_OPTIONS = (
    "keepalive_timeout 5", "gzip on", "gzip_http_version 1.1", "gzip_comp_level 1", "gzip_min_length 1100", "gzip_proxied any",
    "gzip_types text/plain text/html text/css application/json application/x-javascript text/xml application/xml "
    "application/xml+rss text/javascript",
    "gzip_buffers 16 8k", 'gzip_disable "MSIE [1-6].(?!.*SV1)"', "gzip_vary on")
PROXY_OPTIONS = ("proxy_set_header X-Forwarded-For $proxy_add_x_forwarded_for", "proxy_set_header Host $http_host", "proxy_redirect off")
# ---------------------------------------------------------------------------


def hostnames(project: DataFrame, vhost: DataFrame) -> DataFrame:
    """C-3a / J-6 / U-1: every host name of every project, in reference order."""
    canon = project.select(F.col("id").alias("project_id"), F.lit(0).alias("branch"),
                           F.lit(0).cast("bigint").alias("pos"),
                           naming.canonical_host("id").alias("hostname"))
    slug = (project.select(F.col("id").alias("project_id"), F.lit(1).alias("branch"),
                           F.lit(0).cast("bigint").alias("pos"),
                           naming.slug_host("hostname_slug").alias("hostname"))
            .filter(F.col("hostname").isNotNull()))
    # J-6 needs no join: the vhost rows already carry their project id; projects
    # without vhosts simply contribute no branch-2 rows.
    # pos = id * 2 for the ``*.h`` form, id * 2 + 1 for the plain name
    vh = (vhost.select("project_id", "id", "is_wildcard",
                       F.posexplode(naming.wildcard_expansion("hostname", "is_wildcard")).alias("k", "hostname"))
          .select("project_id", F.lit(2).alias("branch"),
                  (F.col("id") * 2 + F.col("k") + F.when(F.col("is_wildcard"), 0).otherwise(1)).cast("bigint").alias("pos"),
                  "hostname"))
    return canon.unionByName(slug).unionByName(vh)


def served_bundles(deployment: DataFrame) -> DataFrame:
    """A-6 / A-12: per project with active deployments: max active bundle id,
    number of distinct active bundles, active and served deployment counts.

    Two partial aggregations: (project, bundle) counts first (map-side
    combined, so a hot project is pre-reduced before any shuffle), then per
    project over the small distinct-pair set.
    """
    pairs = (active_filter(deployment, True)
             .groupBy("project_id", "bundle_id").agg(F.count(F.lit(1)).alias("cnt")))
    return pairs.groupBy("project_id").agg(
        F.max("bundle_id").alias("bundle_id"),
        F.count(F.lit(1)).alias("n_bundles"),
        F.sum("cnt").alias("n_active"),
        F.max_by("cnt", "bundle_id").alias("n_upstreams"))


def routing_table(deployment: DataFrame, bundle: DataFrame, project: DataFrame,
                  vhost: DataFrame, served: DataFrame | None = None) -> DataFrame:
    """C-3: one row per project. ``status`` is ``routed`` or ``not_deployed``.
    ``served``: the ``served_bundles``, if they are there already."""
    served = served_bundles(deployment) if served is None else served
    n_hosts = hostnames(project, vhost).groupBy("project_id").agg(F.count(F.lit(1)).alias("n_hostnames"))
    p = project.select(F.col("id").alias("project_id"))
    out = (p.join(served, "project_id", "left")
           .join(bundle.select(F.col("id").alias("bundle_id"), "bundle_name"), "bundle_id", "left")
           .join(n_hosts, "project_id", "left"))
    return out.select(
        "project_id",
        F.when(F.col("n_active").isNull(), F.lit("not_deployed")).otherwise(F.lit("routed")).alias("status"),
        "bundle_id", "bundle_name",
        F.coalesce(F.col("n_bundles") > 1, F.lit(False)).alias("multi"),
        F.coalesce("n_active", F.lit(0)).cast("bigint").alias("n_active"),
        F.coalesce("n_upstreams", F.lit(0)).cast("bigint").alias("n_upstreams"),
        F.coalesce("n_hostnames", F.lit(0)).cast("bigint").alias("n_hostnames"),
        naming.canonical_host("project_id").alias("canonical_host"))


def routing_upstreams(deployment: DataFrame, served: DataFrame | None = None) -> DataFrame:
    """C-3 / F-18: the served bundle's active deployments as upstream rows
    (instance id, ip, port), ordered by deployment id within a project."""
    served = (served_bundles(deployment) if served is None else served).select("project_id", "bundle_id")
    return (active_filter(deployment, True)
            .join(served, ["project_id", "bundle_id"], "left_semi")
            .select("project_id", "bundle_id", F.col("id").alias("deployment_id"),
                    F.col("server_instance_id").alias("instance_id"),
                    F.col("server_ip").alias("host_ip"), F.col("server_port").alias("host_port")))


def _bundle_dir(app_id: Column, bundle_name: Column) -> Column:
    return F.concat_ws("/", F.lit(CUSTOMER_DIR), app_id, bundle_name)


def media_alias_dest(bundle_dir: Column, file_path: Column) -> Column:
    """X-12: ``{SITE_PACKAGES}`` / ``{SRC_PACKAGES}`` prefix → bundle sub-folder,
    otherwise under ``user-repo``; outer ``/`` of the file path stripped first."""
    fp = F.regexp_replace(file_path, r"^/+|/+$", "")
    site = F.regexp_replace(fp, r"^\{SITE_PACKAGES\}/*", "")
    src = F.regexp_replace(fp, r"^\{SRC_PACKAGES\}/*", "")
    return (F.when(fp.startswith("{SITE_PACKAGES}"),
                   _join_path(F.concat_ws("/", bundle_dir, F.lit(SITE_PACKAGES_SUBDIR)), site))
            .when(fp.startswith("{SRC_PACKAGES}"),
                  _join_path(F.concat_ws("/", bundle_dir, F.lit(SRC_PACKAGES_SUBDIR)), src))
            .otherwise(_join_path(F.concat_ws("/", bundle_dir, F.lit(USER_REPO_SUBDIR)), fp)))


def _join_path(base: Column, rest: Column) -> Column:
    """``os.path.join(base, rest)`` for a relative ``rest``: empty rest keeps a trailing ``/``."""
    return F.concat(base, F.lit("/"), rest)


def site_config_lines(routing: DataFrame, upstreams: DataFrame, hosts: DataFrame, media: DataFrame | None = None,
                      admin_path: str = ADMIN_MEDIA_URL_PATH) -> DataFrame:
    """C-4: the proxy site file of every routed app as ordered line rows.

    ``routing`` rows with status ``routed`` get a file; an app with zero
    upstreams gets an ``error`` row instead (the reference raises).
    ``media`` is (project_id, url_path, file_path, pos) — the site media map.
    Rows: (app_id, section, ord, line); sort by (section, ord) for file order.
    A block (``location``, the options of a section) is one row of several lines;
    ``server_name`` is one line with every host name in order, as it is one line of the file.
    """
    r = (routing.filter(F.col("status") == "routed")
         .select("project_id", naming.sysid("project_id").alias("app_id"), "bundle_name", "n_upstreams"))
    app = r.select("project_id", "app_id")
    bdir = _bundle_dir(F.col("app_id"), F.col("bundle_name"))

    def row(section, line):
        return F.struct(F.lit(section).alias("section"), F.lit(0).cast("bigint").alias("ord"), line.alias("line"))

    def options(lines, indent=4):
        return "\n".join(" " * indent + x + ";" for x in lines)

    # every fixed line of every app in one pass over the routed projects
    fixed = F.array(
        row(0, F.concat(F.lit("upstream app_server_"), F.col("app_id"), F.lit(" {"))),
        row(2, F.lit("}")),
        row(3, F.lit("server {\n" + options(SERVER_OPTIONS))),
        row(5, F.concat(F.lit("    access_log /tmp/"), F.col("app_id"), F.lit(".access.log combined;\n" + options(CONNECTION_OPTIONS)))),
        row(7, F.concat(F.lit("    location " + admin_path + " {\n        alias "), bdir,
                        F.lit("/" + ADMIN_MEDIA_BUNDLE_PATH + "/;\n    }"))),
        row(8, F.concat(F.lit("    location / {\n" + options(PROXY_OPTIONS, 8) + "\n        if (!-f $request_filename) {\n"
                              "            proxy_pass http://app_server_"), F.col("app_id"),
                        F.lit(";\n            break;\n        }\n    }"))),
        row(9, F.lit("}")),
        F.when(F.col("n_upstreams") == 0, row(-1, F.lit("error: no appserver upstreams"))))
    out = (r.select("project_id", "app_id", F.explode(F.array_compact(fixed)).alias("x"))
           .select("project_id", "app_id", "x.section", "x.ord", "x.line"))
    ups = (upstreams.join(app, "project_id")
           .select("project_id", "app_id", F.lit(1).alias("section"), F.col("deployment_id").cast("bigint").alias("ord"),
                   F.concat(F.lit("    server "), F.col("host_ip"), F.lit(":"), F.col("host_port").cast("string"),
                            F.lit(" " + UPSTREAM_OPTIONS + ";")).alias("line")))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("branch", "pos", "hostname"))), lambda x: x["hostname"])
    names = (hosts.join(app, "project_id").groupBy("project_id", "app_id").agg(F.array_join(ordered, " ").alias("names"))
             .select("project_id", "app_id", F.lit(4).alias("section"), F.lit(0).cast("bigint").alias("ord"),
                     F.concat(F.lit("    server_name "), F.col("names"), F.lit(" ;")).alias("line")))
    out = out.unionByName(ups).unionByName(names)
    if media is not None:
        m = (media.join(r.select("project_id", "app_id", "bundle_name"), "project_id")
             .select("project_id", "app_id", F.lit(6).alias("section"), F.col("pos").cast("bigint").alias("ord"),
                     F.concat(F.lit("    location "), F.col("url_path"), F.lit(" {\n        alias "),
                              media_alias_dest(_bundle_dir(F.col("app_id"), F.col("bundle_name")), F.col("file_path")),
                              F.lit("/;\n    }")).alias("line")))
        out = out.unionByName(m)
    return out


def write_site_files(lines: DataFrame, path: str, partitions: int | None = None) -> None:
    """S-18: one folder of text per app; its part files by number are the site file,
    and an app with very many lines is written by several tasks."""
    write_text_folders(lines, path, ["app_id"], ["section", "ord"], partitions=partitions)


def read_site_files(spark: SparkSession, path: str) -> DataFrame:
    """The written site files: app_id, line_no, line."""
    lines = read_text_folders(spark, path, ["app_id"])
    return keyed_index(lines, ["app_id"], FILE_ORDER, "line_no").select("app_id", "line_no", "line")
