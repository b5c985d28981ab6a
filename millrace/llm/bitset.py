"""Sets of 64-bit hashes as bit sets of fixed size, to leave rows out early; a fuller set leaves out fewer."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bit_set(df: DataFrame, column: str, bits: int = 23) -> np.ndarray:
    """The hashes of a column by their leading ``bits`` bits; at most ``2 ** bits / 64`` numbers are collected."""
    at = df.select(F.shiftrightunsigned(column, 64 - bits).alias("bit"))
    rows = at.groupBy(F.shiftright("bit", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits")).collect()
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    for r in rows:
        out[r["at"]] = r["bits"]
    return out.view(np.uint8)


def maybe_in(members: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be in the set."""
    bits = int(len(members) * 8).bit_length() - 1
    at = (hashes.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)
    return (members[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def wide_bit_set(df: DataFrame, column: str, per_hash: int = 32, most: int = 26) -> np.ndarray:
    """As ``bit_set``, with about ``per_hash`` bits for each hash of the column and ``2 ** most`` bits at most.

    The numbers come to the driver as Arrow buffers: 16 bytes for each 64 bits that are not all unset.
    """
    bits = min(most, max(16, (df.count() * per_hash).bit_length()))
    at = df.select(F.shiftrightunsigned(column, 64 - bits).alias("bit"))
    rows = at.groupBy(F.shiftright("bit", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    out[rows["at"].to_numpy()] = rows["bits"].to_numpy()
    return out.view(np.uint8)
