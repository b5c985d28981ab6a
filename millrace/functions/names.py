"""Names of output columns."""

from __future__ import annotations

import re
import string

_KEPT = frozenset(string.ascii_lowercase + string.digits + "_")


def slugify(name: str | None) -> str:
    """A column name from any text: lower case, ``[a-z0-9_]`` only, no leading digit."""
    joined = "_".join(re.split("[- ]+", (name or "").lower()))
    slug = "".join(c for c in joined if c in _KEPT)
    return f"_{slug}" if slug[:1].isdigit() else slug
