"""Projections, filters and predicates (F-1 .. F-18).

Every function is ``(DataFrame, params) -> DataFrame`` or a column builder.
Predicates are plain column expressions so Catalyst pushes them to the scan.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values ----------------------------------------------------------
VALID_LOG_TYPES = ("i", "w", "e", "sb", "se", "jb", "je")  # info warn error step-begin step-end job-begin job-end
SAFE_ID_RE = r"\A[0-9A-Za-z\-_]+\z"
RESERVED_DIR_NAMES = ("django", "src")
VCS_DIR_NAMES = (".git", ".svn", ".hg")
PORT_FLOOR, PORT_CEILING = 1025, 25000  # ports <= 1024 are never usable
ALLOWED_SIGNALS = ("TTIN", "TTOU")
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def active_filter(df: DataFrame, active: bool | None = True, col: str = "deactivation_date") -> DataFrame:
    """F-3: True → active (no deactivation stamp), False → inactive, None → all."""
    if active is None:
        return df
    return df.filter(F.col(col).isNull() if active else F.col(col).isNotNull())


def id_filter(df: DataFrame, col: str, ids: Iterable | DataFrame | None) -> DataFrame:
    """F-4: optional id filter. ``None`` and an empty list both mean no filter.

    A literal list becomes ``isin`` (pushed to the parquet scan); a DataFrame
    of ids becomes a left-semi join (shuffle or runtime broadcast, never a
    driver-side list).
    """
    if ids is None:
        return df
    if isinstance(ids, DataFrame):
        key = ids.columns[0]
        return df.join(ids.select(F.col(key).alias(col)).distinct(), col, "left_semi")
    ids = list(ids)
    return df.filter(F.col(col).isin(ids)) if ids else df


def project_rows(df: DataFrame, project_id) -> DataFrame:
    """F-2 / F-17: rows of one project; a falsy id (None, 0, "") means all projects."""
    return df.filter(F.col("project_id") == F.lit(project_id)) if project_id else df


def search_workers(deployment: DataFrame, project_id=None, bundle_ids=None, active: bool | None = True) -> DataFrame:
    """F-2 + F-3 + F-4: ``search_workers`` for one project or (project_id=None) all."""
    return id_filter(active_filter(project_rows(deployment, project_id), active), "bundle_id", bundle_ids)


def search_allproject_workers(deployment: DataFrame, active: bool | None = True, ip_address: str | None = None) -> DataFrame:
    """F-7: cross-project search by active state and server ip (both pushed to the scan)."""
    out = active_filter(deployment, active)
    return out.filter(F.col("server_ip") == ip_address) if ip_address is not None else out


def lookup_status(table: DataFrame, keys: DataFrame, key_cols: list[str], strict: bool = False) -> DataFrame:
    """F-1 / F-5: exactly-one lookup for a set of requested keys.

    ``keys`` holds the requested key columns (plus any request columns).
    Output: one row per request with ``n_found`` and ``status`` in
    ok / missing / duplicate. The table side is pre-aggregated to one count
    per key before the join, so a hot key costs one row, not all its rows.
    With ``strict`` a non-ok status fails the job (``raise_error``).
    """
    counts = table.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("n_found"))
    out = keys.join(counts, key_cols, "left").withColumn("n_found", F.coalesce("n_found", F.lit(0)).cast("bigint"))
    status = (F.when(F.col("n_found") == 1, F.lit("ok"))
              .when(F.col("n_found") == 0, F.lit("missing")).otherwise(F.lit("duplicate")))
    out = out.withColumn("status", status)
    if strict:
        out = out.withColumn("status", F.when(F.col("status") == "ok", F.col("status"))
                             .otherwise(F.raise_error(F.concat(F.lit("lookup failed: "), F.col("status")))))
    return out


def valid_log_type(logtype) -> Column:
    """F-6: log type in the fixed domain."""
    return _c(logtype).isin(list(VALID_LOG_TYPES))


def split_valid_log(df: DataFrame, col: str = "logtype") -> tuple[DataFrame, DataFrame]:
    """F-6 / S-2: (valid rows, rejected rows)."""
    ok = valid_log_type(col)
    return df.filter(ok), df.filter(~ok | F.col(col).isNull())


def safe_identifier(c) -> Column:
    """F-8: ``^[0-9A-Za-z\\-_]+$`` with a true end anchor (no final newline)."""
    return F.coalesce(_c(c).rlike(SAFE_ID_RE), F.lit(False))


def missing_fields(*cols: str) -> Column:
    """F-9: array of the names of columns that are null or empty strings."""
    return F.array_compact(F.array(*[
        F.when(F.col(c).isNull() | (F.col(c).cast("string") == ""), F.lit(c)) for c in cols]))


def copied_source(path) -> Column:
    """F-10: a path is copied into a bundle unless a part of it is source-control metadata."""
    return ~F.arrays_overlap(F.split(_c(path), "/"), F.array(*[F.lit(n) for n in VCS_DIR_NAMES]))


def base_name(path) -> Column:
    return F.element_at(F.split(_c(path), "/"), -1)


def file_class(path) -> Column:
    """F-11: ``settings`` / ``python`` / ``requirements`` / null for a repo path.

    settings: name ends ``settings.py`` or (starts ``settings`` and ends ``.py``);
    python: ends ``.py``; requirements (only when not ``.py``): name ends
    ``requirements.txt``, or starts ``requirements`` and ends ``.txt``, or the
    path contains ``requirements/`` and ends ``.txt``.
    """
    p = _c(path)
    n = base_name(p)
    is_py = n.endswith(".py")
    settings = n.endswith("settings.py") | (n.startswith("settings") & is_py)
    req = (n.endswith("requirements.txt") | (n.startswith("requirements") & n.endswith(".txt"))
           | (p.contains("requirements/") & p.endswith(".txt")))
    return (F.when(settings, F.lit("settings")).when(is_py, F.lit("python"))
            .when(req, F.lit("requirements")))


def port_eligible(port) -> Column:
    """F-12: a port may be handed out only in [1025, 25000]."""
    return _c(port).between(PORT_FLOOR, PORT_CEILING)


def target_accepted(target, host_name, instance_id) -> Column:
    """F-13: a request addressed to ``target`` is valid on a host whose name or
    instance id equals it, or when it is ``localhost``."""
    t = _c(target)
    return F.coalesce((t == _c(host_name)) | (t == _c(instance_id)) | (t == F.lit("localhost")), F.lit(False))


def signal_allowed(sig) -> Column:
    """F-13: only TTIN / TTOU may be sent to a worker master."""
    return F.coalesce(_c(sig).isin(list(ALLOWED_SIGNALS)), F.lit(False))


def other_bundle(name, keep) -> Column:
    """F-14: an installed bundle other than the one being kept."""
    n = _c(name)
    return n.startswith("bundle_") & (n != _c(keep))


def address(instance_id="server_instance_id", ip="server_ip", port="server_port") -> Column:
    """F-18: deployment → (instance_id, node_name, host_ip, host_port) struct."""
    return F.struct(_c(instance_id).alias("instance_id"), F.lit("NODE_NAME_IGNORED").alias("node_name"),
                    _c(ip).alias("host_ip"), _c(port).alias("host_port"))


def constraint_violations(df: DataFrame, table: str, not_null: tuple[str, ...] = (), unique: tuple[str, ...] = (),
                          checks: dict[str, Column] | None = None) -> DataFrame:
    """F-9 (table form): the database constraints of §1.2 that Spark does not
    enforce, as data. One row per constraint: (table, constraint, n_violations).
    NOT NULL and CHECK are counted in one aggregation pass; each UNIQUE key is
    a per-key count (partial aggregation) folded to the number of keys seen
    more than once."""
    from functools import reduce

    exprs = [F.count(F.when(F.col(c).isNull(), 1)).alias(f"not_null({c})") for c in not_null]
    exprs += [F.count(F.when(~F.coalesce(cond, F.lit(True)), 1)).alias(f"check({name})")
              for name, cond in (checks or {}).items()]
    parts = []
    if exprs:
        wide = df.agg(*exprs)
        parts.append(wide.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("constraint"), F.col(f"`{c}`").cast("bigint").alias("n_violations"))
            for c in wide.columns])).alias("v")).select("v.*"))
    for key in unique:
        dup = (df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
               .agg(F.count(F.when(F.col("n") > 1, 1)).cast("bigint").alias("n_violations")))
        parts.append(dup.select(F.lit(f"unique({key})").alias("constraint"), "n_violations"))
    return reduce(lambda a, b: a.unionByName(b), parts).select(F.lit(table).alias("table"), "constraint", "n_violations")
