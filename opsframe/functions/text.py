"""Text and path functions (X-10 .. X-30) as column expressions.

Python string semantics the reference relies on, and how they are matched:
``str.strip()`` strips all whitespace (Spark ``trim`` strips only spaces) →
``strip_ws``; ``splitlines`` breaks on several separators → ``LINE_SPLIT_RE``;
``str.title()`` differs from ``initcap`` → ``py_title``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.splitlines() separators (\r\n first so it counts once).
LINE_SPLIT_RE = r"\r\n|[\n\r\x0B\x0C\x1C\x1D\x1E\x{85}\x{2028}\x{2029}]"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Python 2 byte-string whitespace — what the reference's str.strip() removes.
PY_WHITESPACE = " \t\n\r\x0b\x0c"


def strip_ws(c) -> Column:
    """Python ``str.strip()``: leading/trailing ASCII whitespace (Spark's
    ``trim`` removes only spaces); ``btrim`` with the set, no regex."""
    return F.btrim(_c(c), F.lit(PY_WHITESPACE))


def split_lines(c) -> Column:
    """Python ``str.splitlines()``: no trailing empty piece after a final break."""
    s = _c(c)
    parts = F.split(s, LINE_SPLIT_RE)
    # splitlines drops the empty piece after a terminating line break, and "" → []
    return F.when(s == "", F.array().cast("array<string>")).when(
        s.rlike("(" + LINE_SPLIT_RE + ")$"), F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


# ---- X-10 / X-11: site media map ------------------------------------------

def normalize_url_path(url) -> Column:
    """X-10: strip ``/`` at both ends; empty → ``/``, else ``/<path>/``."""
    u = F.regexp_replace(_c(url), r"^/+|/+$", "")
    return F.when(u == "", F.lit("/")).otherwise(F.concat(F.lit("/"), u, F.lit("/")))


MEDIA_LINE_RE = r"^(\S+)\s+(.*)$"


def media_entry(line) -> Column:
    """X-11: one stripped, non-blank map line → struct(url_path, file_path) or
    null when the line has a single token (the reference raises)."""
    ln = strip_ws(line)
    ok = ln.rlike(MEDIA_LINE_RE)
    return F.when(ok, F.struct(
        normalize_url_path(F.regexp_extract(ln, MEDIA_LINE_RE, 1)).alias("url_path"),
        F.regexp_extract(ln, MEDIA_LINE_RE, 2).alias("file_path")))


# ---- X-13 .. X-19: URLs, titles, modules ------------------------------------

def canonical_url(url) -> Column:
    """X-13: strip every trailing ``/``; null stays null."""
    return F.regexp_replace(_c(url), "/+$", "")


def checkout_decision(current_url, wanted_url) -> Column:
    """X-14: no current checkout → clone; different canonical URL → reclone; same → update."""
    cur, want = canonical_url(current_url), canonical_url(wanted_url)
    return (F.when(_c(current_url).isNull(), F.lit("clone"))
            .when(cur != want, F.lit("reclone")).otherwise(F.lit("update")))


GIT_FETCH_RE = r"(?m)^  Fetch URL: (.*)$"
SVN_URL_RE = r"(?m)^[ \t]*<url>(.+)</url>[ \t]*$"


def git_fetch_url(report) -> Column:
    """X-15: rest of the first ``  Fetch URL: `` line, stripped; none → null."""
    v = F.regexp_extract(_c(report), GIT_FETCH_RE, 1)
    return F.when(_c(report).rlike(GIT_FETCH_RE), strip_ws(v))


def svn_url(report) -> Column:
    """X-16: text of the first ``<url>…</url>`` line (blanks around allowed); none → null."""
    v = F.regexp_extract(_c(report), SVN_URL_RE, 1)
    return F.when(_c(report).rlike(SVN_URL_RE), v)


def py_title(c) -> Column:
    """X-19: Python ``str.title()``: upper-case a letter that follows a
    non-letter (or starts the string), lower-case every other letter.

    Done on Spark arrays: split into letter runs / non-letter runs, then
    capitalise each letter run (``initcap`` would treat ``'`` and digits
    differently).
    """
    s = _c(c)
    runs = F.regexp_extract_all(s, F.lit(r"([A-Za-z]+|[^A-Za-z]+)"), 1)
    return F.array_join(F.transform(runs, lambda r: F.when(
        r.rlike("^[A-Za-z]"), F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, F.lit(2), F.length(r)))))
        .otherwise(r)), "")


def title_from_url(url) -> Column:
    """X-17: split on ``/`` and ``.``; from the right, first part not starting
    with ``git``; ``_`` → space; title-case. All parts start with ``git`` →
    ``Untitled Project``. A trailing ``/`` gives an empty last part → ``""``."""
    parts = F.reverse(F.split(_c(url), r"[/.]"))
    keep = F.filter(parts, lambda p: ~p.startswith("git"))
    first = F.try_element_at(keep, F.lit(1))
    return F.when(_c(url).isNull(), F.lit(None)).when(
        first.isNull(), F.lit("Untitled Project")).otherwise(py_title(F.regexp_replace(first, "_", " ")))


# ---- X-20 .. X-28: report parsing ------------------------------------------

def percent_value(token) -> Column:
    """X-20: ``"42%"`` → 42; anything else → null."""
    t = _c(token)
    return F.when(t.endswith("%"), F.regexp_replace(t, "%$", "").try_cast("int"))


SUBCOMMANDS_MARKER = "Available subcommands:"


def subcommand_section(help_text) -> Column:
    """X-23: stripped lines after the last marker; null when the marker is absent."""
    t = _c(help_text)
    return F.when(F.instr(t, SUBCOMMANDS_MARKER) > 0,
                  F.transform(split_lines(F.substring_index(t, SUBCOMMANDS_MARKER, -1)), lambda x: strip_ws(x)))


def command_args(cmd) -> Column:
    """X-24: Python ``str.split()`` of a command string (empty → empty array)."""
    s = strip_ws(cmd)
    return F.when(s == "", F.array().cast("array<string>")).otherwise(F.split(s, r"\s+"))


def joined_output(stdout, stderr, shell: bool = False) -> Column:
    """X-27: ``stdout + "\\n" + stderr``; the shell variant adds stderr only when non-empty."""
    if shell:
        return F.concat_ws("\n", _c(stdout), F.nullif(_c(stderr), F.lit("")))
    return F.concat(_c(stdout), F.lit("\n"), _c(stderr))


KV_RE = r"^(.*?): (.*)$"


def kv_pair(line) -> Column:
    """X-28: ``k: v`` split once at the first ``": "``; other lines → null."""
    ln = _c(line)
    return F.when(ln.rlike(KV_RE), F.struct(F.regexp_extract(ln, KV_RE, 1).alias("key"),
                                           F.regexp_extract(ln, KV_RE, 2).alias("value")))


def file_url_path(url) -> Column:
    """X-30: ``file:`` URL → local path: backslashes → ``/``, ``|`` drive marker
    → ``:``, percent-decoding (``+`` kept), one leading ``/``; non-file → null."""
    u = _c(url)
    rest = F.regexp_replace(F.regexp_replace(u, r"^file:", ""), r"\\", "/")
    rest = F.regexp_replace(rest, r"^/*([a-zA-Z])\|", "$1:")
    # runs of whole escapes are decoded together (a character may take several); all else, malformed escapes too, stays
    pieces = F.regexp_extract_all(rest, F.lit("((?:%[0-9A-Fa-f]{2})+|[^%]+|%)"), F.lit(1))
    decoded = F.array_join(F.transform(pieces, lambda x: F.when(x.rlike("^%[0-9A-Fa-f]"), F.url_decode(x)).otherwise(x)), "")
    return F.when(u.startswith("file:"), F.regexp_replace(decoded, "^/+", "/"))


# X-21: gunicorn process title (fixed pattern)
GUNICORN_TITLE_RE = r"^gunicorn: (master|worker) \['(\S+) on :(\d+)'\]\s*$"


def gunicorn_title(command) -> Column:
    """X-21: struct(kind, bundle_name, port) of a gunicorn process title, else null."""
    c = _c(command)
    return F.when(c.rlike(GUNICORN_TITLE_RE), F.struct(
        F.regexp_extract(c, GUNICORN_TITLE_RE, 1).alias("kind"),
        F.regexp_extract(c, GUNICORN_TITLE_RE, 2).alias("bundle_name"),
        F.regexp_extract(c, GUNICORN_TITLE_RE, 3).cast("int").alias("port")))
