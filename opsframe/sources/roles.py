"""Role views: the driver's test tables seen as fleet-operations tables.

Each role is one SQL text that both Spark and DuckDB accept (``logline`` has
one form per engine). Base tables appear as ``{name}`` placeholders: Spark
binds them to parquet DataFrames through ``spark.sql(text, name=df)``; the
DuckDB oracle renders them as the pre-registered view names. The same text is
therefore the starting point of every Spark query and of its oracle.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from opsframe.session import spread

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")

ROLE_SQL: dict[str, str] = {
    "project": """
SELECT c_custkey AS id, c_nationkey AS owner_id, c_name AS title,
       lower(c_mktsegment) AS database_type,
       CASE WHEN c_custkey % 3 = 0 THEN 'slug-' || CAST(c_custkey AS STRING)
            WHEN c_custkey % 3 = 1 THEN '' END AS hostname_slug,
       CASE WHEN c_custkey % 5 <> 0 THEN 'db-' || CAST(c_custkey % 9 AS STRING) END AS db_host,
       CAST(1 + c_custkey % 4 AS INT) AS num_workers
FROM {customer}""",
    "vhost": """
SELECT c_custkey * 2 + k AS id, c_custkey AS project_id,
       'h' || CAST(c_custkey * 2 + k AS STRING) || '.example.com' AS hostname, k = 1 AS is_wildcard
FROM {customer} CROSS JOIN (VALUES (0), (1)) AS v(k) WHERE c_custkey % 4 <> 0""",
    "bundle": """
SELECT p_partkey AS id, p_partkey % 150 AS project_id,
       'bundle_p' || lpad(CAST(p_partkey % 150 AS STRING), 8, '0') || '_2011-'
         || lpad(CAST(1 + p_size % 12 AS STRING), 2, '0') || '-01-00.00.00' AS bundle_name,
       p_name || ' ' || p_type AS code_revision,
       min(l_shipdate) AS creation_date,
       CASE WHEN p_size > 45 THEN max(l_shipdate) END AS deletion_date
FROM {part} LEFT JOIN {lineitem} ON l_partkey = p_partkey
GROUP BY p_partkey, p_size, p_name, p_type""",
    "deployment": """
SELECT l_orderkey * 8 + l_linenumber AS id, min(o_custkey) AS project_id, min(l_partkey) AS bundle_id,
       'i-' || CAST(min(l_suppkey) AS STRING) AS server_instance_id,
       '10.0.' || CAST(min(l_suppkey) % 4 AS STRING) || '.' || CAST(min(l_suppkey) % 250 AS STRING) AS server_ip,
       CAST(10001 + l_orderkey % 200 AS INT) AS server_port,
       min(o_orderdate) AS creation_date,
       CASE WHEN min(l_linestatus) = 'F' THEN max(l_shipdate) END AS deactivation_date
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
GROUP BY l_orderkey, l_linenumber""",
    "host": """
SELECT 'i-' || CAST(s_suppkey AS STRING) AS instance_id, lower(replace(s_name, '#', '-')) AS name,
       CASE s_nationkey % 3 WHEN 0 THEN 'appserver' WHEN 1 THEN 'build' ELSE 'frontend_proxy' END AS role,
       '10.0.' || CAST(s_suppkey % 4 AS STRING) || '.' || CAST(s_suppkey % 250 AS STRING) AS ip,
       'appserver,appserver:i-' || CAST(s_suppkey AS STRING) AS queues,
       CAST(s_suppkey % 101 AS INT) AS space_pct, CAST(s_suppkey * 7 % 101 AS INT) AS inode_pct,
       s_acctbal AS load_raw
FROM {supplier}""",
    "job": """
SELECT o_orderkey AS id, 't' || CAST(o_orderkey AS STRING) AS task_id, lower(o_orderpriority) AS jobcode,
       o_custkey AS project_id, o_orderdate AS issued_at,
       'appserver:i-' || CAST(o_orderkey % 130 AS STRING) AS queue
FROM {orders}""",
    "taskmeta": """
SELECT 't' || CAST(l_orderkey AS STRING) AS task_id, max(l_shipdate) AS date_done
FROM {lineitem} WHERE l_orderkey % 10 <> 0 GROUP BY l_orderkey""",
    "joblog": """
SELECT event_id AS id, user_id AS job_id, ts,
       'Step ' || CAST(event_id % 3 AS STRING) AS message,
       CASE event_type WHEN 'signup' THEN 'sb' WHEN 'purchase' THEN 'se' WHEN 'error' THEN 'e'
                       WHEN 'click' THEN 'i' ELSE 'zz' END AS logtype
FROM {events}""",
    "control": """
SELECT event_id AS id, ts, CAST(10001 + user_id % 40 AS INT) AS port,
       CASE WHEN event_type IN ('signup', 'error') THEN 'unserve' ELSE 'serve' END AS cmd,
       CASE WHEN event_id % 17 = 0 THEN 'bad name!' ELSE 'bundle_' || CAST(event_id AS STRING) END AS bundle_name
FROM {events}""",
    "turnlog": """
SELECT conv_id AS log_id, turn AS line_no, text AS line FROM {conversations}""",
    "page": """
SELECT page_id AS id, url, CASE WHEN page_id % 3 > 0 THEN rtrim(url) || CASE WHEN page_id % 3 = 1 THEN '/' ELSE '' END END AS current_url
FROM {pages}""",
    "conf_name": """
SELECT event_id AS id,
       CASE event_id % 5
         WHEN 0 THEN 'p' || CAST(user_id AS STRING) || '.bundle_' || CAST(event_id AS STRING) || '.port.' || CAST(10001 + user_id AS STRING) || '.conf'
         WHEN 1 THEN 'p' || CAST(user_id AS STRING) || '.b.port.1.port.x.conf'
         WHEN 2 THEN 'bundle_p' || CAST(user_id AS STRING) || '_' || CAST(event_id AS STRING) || '-stderr---supervisor-abc.log'
         WHEN 3 THEN 'bundle_p_' || CAST(user_id AS STRING) || '_' || CAST(event_id AS STRING) || '-stdout---supervisor-abc.log'
         ELSE '.hidden' END AS filename
FROM {events}""",
    "repofile": """
SELECT doc_id AS id, CAST(floor(doc_id / 10) AS BIGINT) AS repo_id,
       CASE doc_id % 10
         WHEN 0 THEN 'proj/settings.py' WHEN 1 THEN 'settings_dev.py'
         WHEN 2 THEN CASE CAST(floor(doc_id / 10) AS BIGINT) % 4 WHEN 0 THEN 'deep/proj/urls.py' WHEN 1 THEN 'urls.py' ELSE 'other.py' END
         WHEN 3 THEN 'requirements.txt' WHEN 4 THEN 'proj/requirements/base.txt' WHEN 5 THEN 'requirements-dev.txt'
         WHEN 6 THEN 'README.txt' WHEN 7 THEN '.git/config' WHEN 8 THEN 'proj/models.py' ELSE 'media/logo.png' END AS path,
       CASE WHEN doc_id % 10 > 1 THEN text
            WHEN CAST(floor(doc_id / 10) AS BIGINT) % 4 = 2 THEN 'DEBUG = True'
            ELSE 'DEBUG = True' || chr(10) || 'ROOT_URLCONF = '''
              || CASE CAST(floor(doc_id / 10) AS BIGINT) % 4 WHEN 0 THEN 'proj.urls' WHEN 1 THEN 'mysite.urls' ELSE 'a.b.c' END || '''' END AS content
FROM {documents}""",
}

# Spark-side forms that differ from the shared text only in how rows are
# generated: the two-row ``VALUES`` cross join of ``vhost`` becomes a
# generator (no nested-loop join in the plan); the rows are identical.
SPARK_FORMS: dict[str, str] = {
    "vhost": """
SELECT c_custkey * 2 + k AS id, c_custkey AS project_id,
       'h' || CAST(c_custkey * 2 + k AS STRING) || '.example.com' AS hostname, k = 1 AS is_wildcard
FROM {customer} LATERAL VIEW explode(array(0, 1)) v AS k WHERE c_custkey % 4 <> 0""",
}

# Roles that group a large join: its inputs, and the keys they are spread by
SPREAD: dict[str, dict[str, str]] = {"deployment": {"lineitem": "l_orderkey", "orders": "o_orderkey"}}

LOGLINE_SPARK = """
SELECT doc_id AS log_id, source AS hostname, lang AS app_id, l.line_no, l.line
FROM {documents} LATERAL VIEW posexplode(split(text, '\\n')) l AS line_no, line"""

LOGLINE_DUCKDB = """
SELECT log_id, hostname, app_id, generate_subscripts(a, 1) - 1 AS line_no, unnest(a) AS line
FROM (SELECT doc_id AS log_id, source AS hostname, lang AS app_id, string_split(text, chr(10)) AS a FROM documents)"""

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def role(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One role view as a lazy DataFrame over the parquet tables of ``sf_dir``."""
    text = LOGLINE_SPARK if name == "logline" else SPARK_FORMS.get(name, ROLE_SQL[name])
    tables = {t: base_table(spark, sf_dir, t) for t in set(_PLACEHOLDER.findall(text))}
    if name in SPREAD:
        rows = max(tables[t].count() for t in SPREAD[name])  # from the files' footers
        tables |= {t: spread(tables[t], rows, key) for t, key in SPREAD[name].items()}
    return spark.sql(text, **tables)


def duckdb_role(name: str) -> str:
    text = LOGLINE_DUCKDB if name == "logline" else ROLE_SQL[name]
    return _PLACEHOLDER.sub(lambda m: m.group(1), text)


def with_roles(body: str, *names: str, extra: str = "") -> str:
    """Oracle SQL for DuckDB: ``WITH <roles>, <extra CTEs> <body>``."""
    ctes = [f"{n} AS ({duckdb_role(n)}\n)" for n in names]
    if extra.strip():
        ctes.append(extra.strip().strip(","))
    return f"WITH {',\n'.join(ctes)}\n{body}" if ctes else body


class Roles:
    """Lazy accessor: ``Roles(spark, sf_dir).deployment`` etc."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        # built once per accessor: repeated uses in one query share one DataFrame
        if name in ROLE_SQL or name == "logline":
            df = role(self.spark, self.sf_dir, name)
        elif name in BASE_TABLES:
            df = base_table(self.spark, self.sf_dir, name)
        else:
            raise AttributeError(name)
        setattr(self, name, df)
        return df
