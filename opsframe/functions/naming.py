"""Identifier and name formats of the fleet (X-1 .. X-9): column expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must equal the platform's constants) --------------------
SYSID_FORMAT = "p%08d"                      # project system id
BUNDLE_STAMP_FORMAT = "yyyy-MM-dd-HH.mm.ss"  # bundle_<app>_<stamp>, UTC
REVISION_LIMIT = 512                        # stored code_revision length
REVISION_KEEP = 509                         # then "..." is appended
# ---------------------------------------------------------------------------

ROOT_DOMAIN = "apps.example.com"            # default domain of canonical and slug hosts (a parameter)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sysid(project_id) -> Column:
    """X-1: ``p%08d``; wider ids keep all digits (``lpad`` would cut them)."""
    return F.format_string(SYSID_FORMAT, _c(project_id))


def canonical_host(project_id, domain: str = ROOT_DOMAIN) -> Column:
    """X-2: ``<sysid>.<root domain>``."""
    return F.concat(sysid(project_id), F.lit("." + domain))


def slug_host(slug, domain: str = ROOT_DOMAIN) -> Column:
    """X-3: ``<slug>.<root domain>`` when the slug is neither null nor empty, else null."""
    s = _c(slug)
    return F.when(F.coalesce(s, F.lit("")) != "", F.concat(s, F.lit("." + domain)))


def wildcard_expansion(hostname, is_wildcard) -> Column:
    """X-4: array of host names a virtual host stands for, wildcard form first."""
    h = _c(hostname)
    return F.when(_c(is_wildcard), F.array(F.concat(F.lit("*."), h), h)).otherwise(F.array(h))


def truncate_revision(rev) -> Column:
    """X-5 / S-3: null → ``""``; longer than 512 → first 509 characters + ``...``."""
    r = F.coalesce(_c(rev), F.lit(""))
    return F.when(F.length(r) > REVISION_LIMIT,
                  F.concat(F.substring(r, 1, REVISION_KEEP), F.lit("..."))).otherwise(r)


def bundle_name(app_id, ts) -> Column:
    """X-6 format: ``bundle_<app>_<yyyy-MM-dd-HH.mm.ss>``."""
    return F.concat(F.lit("bundle_"), _c(app_id), F.lit("_"), F.date_format(_c(ts), BUNDLE_STAMP_FORMAT))


BUNDLE_NAME_RE = r"^bundle_(.*)_([0-9]{4}-[0-9]{2}-[0-9]{2}-[0-9]{2}\.[0-9]{2}\.[0-9]{2})$"


def bundle_name_app(name) -> Column:
    """X-6 parse: app id of a bundle name (empty string when it does not parse)."""
    return F.regexp_extract(_c(name), BUNDLE_NAME_RE, 1)


def bundle_name_time(name) -> Column:
    """X-6 parse: build time of a bundle name; null when it does not parse."""
    stamp = F.regexp_extract(_c(name), BUNDLE_NAME_RE, 2)
    return F.try_to_timestamp(F.nullif(stamp, F.lit("")), F.lit(BUNDLE_STAMP_FORMAT))


# X-7: worker config file ``<app>.<bundle>.port.<n>.conf`` (greedy middle = last ``.port.``)
WORKER_CONF_RE = r"^([^.]*)\.(.*)\.port\.(.*)\.conf$"


def worker_conf_parts(filename) -> Column:
    """X-7: struct(app_id, bundle_name, port) or null when the name is not a worker config.

    ``port`` is ``try_cast`` to int, so blanks around digits are accepted and a
    non-integer port makes the whole entry null (the entry is skipped).
    """
    f = _c(filename)
    ok = f.rlike(WORKER_CONF_RE)
    port = F.trim(F.regexp_extract(f, WORKER_CONF_RE, 3)).try_cast("int")
    # the app id is everything before the first '.', the bundle the rest up to the last '.port.'
    return F.when(ok & port.isNotNull(), F.struct(
        F.regexp_extract(f, WORKER_CONF_RE, 1).alias("app_id"),
        F.regexp_extract(f, WORKER_CONF_RE, 2).alias("bundle_name"),
        port.alias("port")))


# X-8: supervisor log file of a bundle
SUPERVISOR_LOG_RE = r"^bundle_(.*)_([^_]*)-(stderr|stdout)---supervisor-([^/]*)\.log$"


def supervisor_log_app(filename) -> Column:
    return F.regexp_extract(_c(filename), SUPERVISOR_LOG_RE, 1)


def supervisor_log_stream(filename) -> Column:
    return F.regexp_extract(_c(filename), SUPERVISOR_LOG_RE, 3)


# X-9: captions per log stream (fixed values)
LOG_CAPTIONS = {
    "stderr": "Application Standard Error",
    "stdout": "Application Standard Output",
    "access": "Web Server Access Log",
}


def log_caption(stream) -> Column:
    s = _c(stream)
    out = None
    for k, v in LOG_CAPTIONS.items():
        out = (F.when(s == k, F.lit(v)) if out is None else out.when(s == k, F.lit(v)))
    return out
