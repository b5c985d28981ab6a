"""Word matching in text columns.

A word is a maximal run of letters and digits, compared in lower case. Conditions combine with the
usual column operators: ``has_word("text", "fate") & ~has_word("text", "india")``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_BREAK = r"[^\p{L}\p{N}]+"


def _text(*columns: str) -> Column:
    return F.lower(F.concat_ws(" ", *columns))


def words(*columns: str) -> Column:
    """Distinct words of the columns taken together."""
    return F.array_remove(F.array_distinct(F.split(_text(*columns), _BREAK)), "")


def has_word(column: str | tuple[str, ...], word: str) -> Column:
    """True where the word occurs; stops at the first occurrence and builds no word list."""
    columns = (column,) if isinstance(column, str) else tuple(column)
    needle = word.lower()
    if not needle or re.search(r"[\W_]", needle):
        raise ValueError(f"not a single word: {word!r}")
    return _text(*columns).rlike(rf"(?<![\p{{L}}\p{{N}}]){needle}(?![\p{{L}}\p{{N}}])")
