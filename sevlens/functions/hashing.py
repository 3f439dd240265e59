"""Stable, partitioning-independent hashing of row ids.

``randomSplit`` / ``sample`` draw from per-partition random streams, so the same
rows in a different number of partitions land in different splits.  A hash of
the id gives every row a fixed position in [0, 1): the split and the sample do
not change with partitioning, with executor loss (recomputed tasks hash the same
way) or between engines, because md5 is standard.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO_32 = 4294967296.0


def unit_hash(id_col, seed: int | str = 42) -> Column:
    """Uniform value in [0, 1) from the first 32 bits of md5(seed || ':' || id).

    The division is by a power of two, so the double is exact and equals what an
    SQL engine gets with the same md5 text.
    """
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    text = F.concat(F.lit(f"{seed}:"), c.cast("string"))
    top32 = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return top32 / F.lit(_TWO_32)
