"""Parts of URLs.

The default rules are plain text rules: schemes are removed wherever they occur, a fragment, port or
user stays, a slash inside the query starts the path, and a parameter also matches as the end of a
longer name. ``strict=True`` anchors every rule to the place it belongs to.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*://)?(?:[^/?#@]*@)?"


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _without(url: Column, *schemes: str) -> Column:
    for scheme in schemes:
        url = F.replace(url, F.lit(scheme), F.lit(""))
    return url


def _part(text: Column, delimiter: str, n: int) -> Column:
    return F.split_part(text, F.lit(delimiter), F.lit(n))


def get_url_host(url: str | Column, strict: bool = False) -> Column:
    url = _column(url)
    if strict:
        return F.regexp_extract(url, _AUTHORITY + r"([^/?#:]*)", 1)
    bare = _without(url, "android-app://", "http://", "https://")
    return _part(_part(bare, "/", 1), "?", 1)


def get_url_path(url: str | Column, strict: bool = False) -> Column:
    """Path without its leading slash and without the query."""
    url = _column(url)
    if strict:
        return F.regexp_extract(url, _AUTHORITY + r"[^/?#]*/([^?#]*)", 1)
    bare = _without(url, "http://", "https://")
    slash, question = F.instr(bare, "/"), F.instr(bare, "?")
    rest = F.when(slash > 0, F.substring(bare, slash + 1, F.length(bare))).when(question > 0, F.lit("")).otherwise(bare)
    return F.when(url.isNotNull(), _part(rest, "?", 1))


def get_url_parameter(url: str | Column, name: str, strict: bool = False) -> Column:
    """Value of a query parameter; NULL when absent or empty."""
    url = _column(url)
    if strict:
        found = F.regexp_extract(url, rf"[?&]{re.escape(name)}=([^&#]*)", 1)
    else:
        found = _part(_part(url, f"{name}=", 2), "&", 1)
    return F.nullif(found, F.lit(""))
