"""E-1: source-control kinds and how each one's report names the address of a checkout.

A handler is a function from the report column to the address column. Kinds are
open: ``register_handler`` adds one, and every expression built after that knows it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from opsframe.functions import text as T

Handler = Callable[[Column], Column]
_HANDLERS: dict[str, Handler] = {}


def register_handler(kind: str, handler: Handler) -> None:
    """Add a kind, or replace its handler."""
    _HANDLERS[kind] = handler


def handlers() -> dict[str, Handler]:
    return dict(_HANDLERS)


def source_url_of(kind: Column, report: Column) -> Column:
    """The address a report names; null for a kind without a handler (the caller marks it rejected)."""
    out = F.lit(None).cast("string")
    for k, handler in _HANDLERS.items():
        out = F.when(kind == k, handler(report)).otherwise(out)
    return out


register_handler("git", T.git_fetch_url)
register_handler("hg", T.strip_ws)
register_handler("svn", T.svn_url)
