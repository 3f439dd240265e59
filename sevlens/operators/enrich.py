"""Joins: dimension enrichment (J1), prediction pairing (J2), split leakage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A dimension is broadcast only when it provably holds at most this many rows
# and at most this many bytes (rows x the schema's fixed row width estimate).
DEFAULT_BROADCAST_MAX_ROWS = 1_000_000
DEFAULT_BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def has_at_most(df: DataFrame, max_rows: int) -> bool:
    """True if ``df`` has <= max_rows rows.  Reads at most max_rows + 1 rows."""
    return df.limit(max_rows + 1).count() <= max_rows


# Per-value size estimates (the same figures Spark's planner uses for these types).
_TYPE_BYTES = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "float": 4, "date": 4,
               "bigint": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8, "string": 20}


def row_width(df: DataFrame) -> int:
    """Estimated bytes per row from the schema; nested / unknown types count 64 bytes."""
    return max(1, sum(_TYPE_BYTES.get(f.dataType.simpleString(), 64) for f in df.schema.fields))


def broadcast_if_bounded(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
                         max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES,
                         measured: DataFrame | None = None) -> DataFrame:
    """Broadcast hint behind a bounded size check; otherwise leave the choice to
    Catalyst / AQE (sort-merge join, converted at runtime if it turns out small).

    The check reads at most ``limit + 1`` rows of ``measured`` (by default ``df``; a base
    table of at least as many rows costs no shuffle to count), and is made each time, so
    a table that has grown is not broadcast on an old proof.
    """
    limit = min(max_rows, max_bytes // row_width(df))
    return F.broadcast(df) if has_at_most(df if measured is None else measured, limit) else df


def enrich(df: DataFrame, lookup: DataFrame, on: str | Sequence[str], how: str = "left",
           max_broadcast_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """Equi-join a dimension onto a fact table.

    ``USING`` semantics: the key is emitted once and first.  With ``how="left"``
    an unmatched or null key keeps the fact row with null dimension columns.
    A hot key costs nothing extra on the broadcast path; on the shuffle path AQE
    splits skewed fact partitions (left side of a left join is splittable).
    """
    keys = [on] if isinstance(on, str) else list(on)
    return df.join(broadcast_if_bounded(lookup, max_broadcast_rows), keys, how)


def join_predictions(a: DataFrame, b: DataFrame, id_col: str = "ID") -> DataFrame:
    """Pair two separately scored prediction frames on the row id (no reliance on
    row order).  When both models score the same frame, score them in one chain
    instead (``plans.models.score`` with prefixes) and no join is needed."""
    return a.join(b, id_col, "inner")


def split_overlap(a: DataFrame, b: DataFrame, id_col: str = "ID") -> DataFrame:
    """Ids present in both frames (leakage check); empty when disjoint."""
    return a.select(id_col).join(b.select(id_col), id_col, "left_semi").distinct()
