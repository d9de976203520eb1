"""Driver queries: hostnames, routing table, upstreams, proxy site text."""

from __future__ import annotations

from pyspark.sql import functions as F

from opsframe.functions.naming import ROOT_DOMAIN as ROOT
from opsframe.plans import routing
from opsframe.plans.projectcfg import site_media_entries
from opsframe.registry import query
from opsframe.session import cut_lineage, new_folder, spread
from opsframe.sources.roles import Roles, with_roles

# The site media map every project is given in these queries (this library's own entries).
MEDIA_MAP_TEXT = "\n".join([
    "/pics/ /var/pics",
    "/docs/ var/docs/",
    "/media/widgets {SITE_PACKAGES}/widgets/media",
    "/media/maps {SRC_PACKAGES}//maps",
])

HOSTNAMES_SQL = f"""
SELECT id AS project_id, 0 AS branch, CAST(0 AS BIGINT) AS pos, printf('p%08d', id) || '.{ROOT}' AS hostname FROM project
UNION ALL
SELECT id, 1, CAST(0 AS BIGINT), hostname_slug || '.{ROOT}' FROM project WHERE coalesce(hostname_slug, '') <> ''
UNION ALL
SELECT project_id, 2, id * 2, '*.' || hostname FROM vhost WHERE is_wildcard
UNION ALL
SELECT project_id, 2, id * 2 + 1, hostname FROM vhost"""

SERVED_CTES = """
active AS (SELECT * FROM deployment WHERE deactivation_date IS NULL),
pairs AS (SELECT project_id, bundle_id, count(*) AS cnt FROM active GROUP BY project_id, bundle_id),
served AS (SELECT project_id, max(bundle_id) AS bundle_id, count(*) AS n_bundles,
                  CAST(sum(cnt) AS BIGINT) AS n_active, arg_max(cnt, bundle_id) AS n_upstreams
           FROM pairs GROUP BY project_id)"""

ROUTING_CTES = SERVED_CTES + f""",
hn AS ({HOSTNAMES_SQL}),
nh AS (SELECT project_id, count(*) AS n_hostnames FROM hn GROUP BY project_id),
rt AS (
SELECT p.id AS project_id,
       CASE WHEN s.n_active IS NULL THEN 'not_deployed' ELSE 'routed' END AS status,
       s.bundle_id, b.bundle_name, coalesce(s.n_bundles > 1, false) AS multi,
       coalesce(s.n_active, 0) AS n_active, coalesce(s.n_upstreams, 0) AS n_upstreams,
       coalesce(nh.n_hostnames, 0) AS n_hostnames,
       printf('p%08d', p.id) || '.{ROOT}' AS canonical_host
FROM project p LEFT JOIN served s ON s.project_id = p.id
LEFT JOIN bundle b ON b.id = s.bundle_id
LEFT JOIN nh ON nh.project_id = p.id)"""

UPSTREAMS_CTE = """
ups AS (SELECT a.project_id, a.bundle_id, a.id AS deployment_id, a.server_instance_id AS instance_id,
               a.server_ip AS host_ip, a.server_port AS host_port
        FROM active a JOIN served s ON a.project_id = s.project_id AND a.bundle_id = s.bundle_id)"""

ROUTING_ROLES = ("deployment", "bundle", "project", "vhost")


@query("hostnames", oracle=with_roles(HOSTNAMES_SQL, "project", "vhost"))
def q_hostnames(spark, sf):
    """C-3a / J-6 / U-1 / X-1..X-4: every project's host names in reference order."""
    r = Roles(spark, sf)
    return routing.hostnames(r.project, r.vhost)


@query("routing_table", oracle=with_roles("SELECT * FROM rt", *ROUTING_ROLES, extra=ROUTING_CTES))
def q_routing_table(spark, sf):
    """C-3 / A-6: per project the served (max active) bundle, multi-bundle flag and counts."""
    r = Roles(spark, sf)
    return routing.routing_table(r.deployment, r.bundle, r.project, r.vhost)


@query("routing_upstreams", oracle=with_roles("SELECT * FROM ups", "deployment",
                                              extra=SERVED_CTES + "," + UPSTREAMS_CTE))
def q_routing_upstreams(spark, sf):
    """C-3 / A-7 / F-18: the served bundle's deployments as upstream rows."""
    return routing.routing_upstreams(Roles(spark, sf).deployment)


def _dk_alias(bdir: str, fp: str) -> str:
    """DuckDB twin of ``routing.media_alias_dest``."""
    s = f"regexp_replace({fp}, '^/+|/+$', '', 'g')"
    return (f"CASE WHEN starts_with({s}, '{{SITE_PACKAGES}}') THEN {bdir} || '/lib/python2.6/site-packages/' || "
            f"regexp_replace(substr({s}, 16), '^/+', '') "
            f"WHEN starts_with({s}, '{{SRC_PACKAGES}}') THEN {bdir} || '/src/' || regexp_replace(substr({s}, 15), '^/+', '') "
            f"ELSE {bdir} || '/user-repo/' || {s} END")


SITE_SQL = ROUTING_CTES + "," + UPSTREAMS_CTE + f""",
r AS (SELECT project_id, printf('p%08d', project_id) AS app_id, bundle_name, n_upstreams,
             '/cust/' || printf('p%08d', project_id) || '/' || bundle_name AS bdir
      FROM rt WHERE status = 'routed'),
media(url_path, file_path, pos) AS (VALUES ('/pics/', '/var/pics', 0), ('/docs/', 'var/docs/', 1),
      ('/media/widgets/', '{{SITE_PACKAGES}}/widgets/media', 2), ('/media/maps/', '{{SRC_PACKAGES}}//maps', 3)),
names AS (SELECT project_id, string_agg(hostname, ' ' ORDER BY branch, pos) AS names FROM hn GROUP BY project_id),
lines AS (
SELECT project_id, app_id, 0 AS section, CAST(0 AS BIGINT) AS ord, 'upstream app_server_' || app_id || ' {{' AS line FROM r
UNION ALL SELECT u.project_id, app_id, 1, u.deployment_id, '    server ' || host_ip || ':' || CAST(host_port AS VARCHAR) || ' max_fails=2  fail_timeout=10s;'
          FROM ups u JOIN r ON u.project_id = r.project_id
UNION ALL SELECT project_id, app_id, 2, 0, '}}' FROM r
UNION ALL SELECT project_id, app_id, 3, 0, 'server {{' || chr(10) || '    listen 80;' || chr(10) || '    client_max_body_size 1G;' FROM r
UNION ALL SELECT r.project_id, app_id, 4, 0, '    server_name ' || n.names || ' ;' FROM names n JOIN r ON n.project_id = r.project_id
UNION ALL SELECT project_id, app_id, 5, 0, '    access_log /tmp/' || app_id || $$.access.log combined;
    keepalive_timeout 5;
    gzip on;
    gzip_http_version 1.1;
    gzip_comp_level 1;
    gzip_min_length 1100;
    gzip_proxied any;
    gzip_types text/plain text/html text/css application/json application/x-javascript text/xml application/xml application/xml+rss text/javascript;
    gzip_buffers 16 8k;
    gzip_disable "MSIE [1-6].(?!.*SV1)";
    gzip_vary on;$$ FROM r
UNION ALL SELECT project_id, app_id, 6, m.pos, '    location ' || m.url_path || ' {{' || chr(10) || '        alias ' || {_dk_alias('bdir', 'm.file_path')} || '/;' || chr(10) || '    }}'
          FROM r, media m
UNION ALL SELECT project_id, app_id, 7, 0, '    location /_admin_media/ {{' || chr(10) || '        alias ' || bdir
          || '/lib/python2.6/site-packages/django/contrib/admin/media/;' || chr(10) || '    }}' FROM r
UNION ALL SELECT project_id, app_id, 8, 0, $$    location / {{
        proxy_set_header X-Forwarded-For $proxy_add_x_forwarded_for;
        proxy_set_header Host $http_host;
        proxy_redirect off;
        if (!-f $request_filename) {{
            proxy_pass http://app_server_$$ || app_id || $$;
            break;
        }}
    }}$$ FROM r
UNION ALL SELECT project_id, app_id, 9, 0, '}}' FROM r
UNION ALL SELECT project_id, app_id, -1, 0, 'error: no appserver upstreams' FROM r WHERE n_upstreams = 0)"""


@query("site_config_text", oracle=with_roles("SELECT * FROM lines", *ROUTING_ROLES, extra=SITE_SQL))
def q_site_config_text(spark, sf):
    """C-4 / X-12 / X-11: every routed app's proxy site file as ordered line rows."""
    r = Roles(spark, sf)
    dep, project, vhost = r.deployment, r.project, r.vhost
    served = cut_lineage(routing.served_bundles(dep))  # read by the table and the upstreams
    table = routing.routing_table(dep, r.bundle, project, vhost, served)
    rt = cut_lineage(spread(table, project.count() * routing.FILE_ROWS, "project_id"))  # a row becomes a file
    routed = rt.filter(F.col("status") == "routed").select("project_id")
    # every routed project carries the same media map text; X-11 parses it per project
    media = site_media_entries(routed.withColumn("site_media", F.lit(MEDIA_MAP_TEXT)), "site_media")
    return routing.site_config_lines(rt, routing.routing_upstreams(dep, served), routing.hostnames(project, vhost),
                                     media.filter(F.col("status") == "ok").select("project_id", "url_path", "file_path", "pos"))


SITE_LINES_SQL = """
SELECT app_id, row_number() OVER (PARTITION BY app_id ORDER BY section, ord, sub) - 1 AS line_no, line
FROM (SELECT app_id, section, ord, generate_subscripts(a, 1) AS sub, unnest(a) AS line
      FROM (SELECT *, string_split(line, chr(10)) AS a FROM lines))"""


@query("site_files_written", oracle=with_roles(SITE_LINES_SQL, *ROUTING_ROLES, extra=SITE_SQL))
def q_site_files_written(spark, sf):
    """S-18: the proxy site files (C-4) written as text, in file order over several tasks, and read back line by line."""
    path = new_folder(spark, "sites")
    routing.write_site_files(q_site_config_text(spark, sf), path)
    return routing.read_site_files(spark, path)
