"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text hashed in place of NULL, part of the key format.
NULL_TEXT = "_dbt_utils_surrogate_key_null_"


def generate_surrogate_key(columns: Sequence[str | Column], null_as_empty: bool = False) -> Column:
    """MD5 over the columns as text joined by ``-``.

    ``null_as_empty`` makes NULL and the empty text the same key. Doubles should be cast to decimals
    first: their text differs from engine to engine.
    """
    if isinstance(columns, (str, Column)) or len(columns) == 0:
        raise ValueError("generate_surrogate_key takes a non-empty list of columns")
    missing = F.lit("" if null_as_empty else NULL_TEXT)
    texts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), missing) for c in columns]
    return F.md5(F.concat_ws("-", *texts))
