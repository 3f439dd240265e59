"""Validation reports.

Each report is one aggregate over the input (partial aggregation on every task,
one tiny final merge), then a Generate to long form on the single result row.
Nothing is collected; the report is itself a DataFrame.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the reference checks.
CRITICAL_COLUMNS = ("Severity", "Start_Time", "Start_Lat", "Start_Lng", "State")
NULL_WARN_PCT = 5.0
SEVERITY_DOMAIN = (1, 2, 3, 4)
US_BOUNDING_BOX = {"Start_Lat": (24.0, 72.0), "Start_Lng": (-170.0, -66.0)}
RANGE_MAX_FRACTION = 0.01


def long_form(row_df: DataFrame, items: Sequence[tuple[str, Mapping[str, Column]]]) -> DataFrame:
    """Turn a one-row aggregate into one row per item: explode(array(struct...))."""
    structs = [F.struct(F.lit(name).alias("column"), *[c.alias(k) for k, c in fields.items()])
               for name, fields in items]
    return row_df.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def shape(df: DataFrame) -> DataFrame:
    """(rows, columns) of a frame."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "columns", F.lit(len(df.columns)))


def null_report(df: DataFrame, cols: Iterable[str] = CRITICAL_COLUMNS,
                warn_pct: float = NULL_WARN_PCT) -> DataFrame:
    """(column, null_count, null_pct, status): PASS if pct < warn_pct else WARN."""
    cols = list(cols)
    agg = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(F.col(c).isNull()).alias(f"__null_{i}") for i, c in enumerate(cols)])
    items = []
    for i, c in enumerate(cols):
        nulls = F.col(f"__null_{i}")
        pct = F.round(nulls * F.lit(100.0) / F.col("__n"), 4)
        items.append((c, {"null_count": nulls, "null_pct": pct,
                          "status": F.when(pct < warn_pct, "PASS").otherwise("WARN")}))
    return long_form(agg, items)


def domain_violations(df: DataFrame, col: str = "Severity",
                      allowed: Sequence = SEVERITY_DOMAIN) -> DataFrame:
    """Rows whose non-null value is outside ``allowed`` (null rows are not counted)."""
    bad = F.count_if(~F.col(col).isin(list(allowed)))
    return df.agg(bad.alias("violations")).select(
        F.lit(col).alias("column"), "violations",
        F.when(F.col("violations") == 0, "PASS").otherwise("FAIL").alias("status"))


def range_violations(df: DataFrame, bounds: Mapping[str, tuple[float, float]] = US_BOUNDING_BOX,
                     max_fraction: float = RANGE_MAX_FRACTION) -> DataFrame:
    """Rows outside any (lo, hi) box; PASS if fewer than max_fraction of all rows."""
    cond = None
    for c, (lo, hi) in bounds.items():
        part = (F.col(c) < lo) | (F.col(c) > hi)
        cond = part if cond is None else (cond | part)
    agg = df.agg(F.count_if(cond).alias("violations"), F.count(F.lit(1)).alias("rows"))
    return agg.withColumn("status", F.when(
        F.col("violations") < F.col("rows") * F.lit(max_fraction), "PASS").otherwise("WARN"))


def all_null_columns(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """(column, non_null, all_null) for each column."""
    cols = list(cols or df.columns)
    agg = df.agg(*[F.count(F.col(c)).alias(f"__nn_{i}") for i, c in enumerate(cols)])
    return long_form(agg, [(c, {"non_null": F.col(f"__nn_{i}"),
                                "all_null": F.col(f"__nn_{i}") == 0})
                           for i, c in enumerate(cols)])


def assert_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Raise if a column is missing; return the frame unchanged."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def column_presence(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """V14 as a report: (column, present, non_null); an absent column has no count.  One pass for all."""
    names = list(required)
    have = [c for c in names if c in df.columns]
    agg = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count(F.col(c)).alias(f"__nn_{i}") for i, c in enumerate(have)])
    counted = {c: F.col(f"__nn_{i}") for i, c in enumerate(have)}
    return long_form(agg, [(c, {"present": F.lit(c in counted), "non_null": counted.get(c, F.lit(None).cast("bigint"))}) for c in names])


def invalid_rows(df: DataFrame, domains: Mapping[str, Sequence] | None = None, bounds: Mapping[str, tuple[float, float]] | None = None,
                 required: Iterable[str] = (), out: str = "reasons") -> DataFrame:
    """Rows that break a rule, with the broken rules in ``out``, for a quarantine table.

    A value outside its domain or its (lo, hi) range breaks a rule, a null only where the column is
    required.  One filter over the scan, no shuffle; bounds and nulls of plain columns reach the scan.
    """
    broken = {f"domain:{c}": ~F.col(c).isin(list(v)) for c, v in (domains or {}).items()}
    broken |= {f"range:{c}": (F.col(c) < lo) | (F.col(c) > hi) for c, (lo, hi) in (bounds or {}).items()}
    broken |= {f"null:{c}": F.col(c).isNull() for c in required}
    if not broken:
        return df.withColumn(out, F.array().cast("array<string>")).where(F.lit(False))
    named = F.array(*[F.when(cond, F.lit(name)) for name, cond in broken.items()])
    any_broken = functools.reduce(lambda a, b: a | b, broken.values())
    return df.where(any_broken).withColumn(out, F.array_compact(named))


def bounds_report(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """(column, min, max, lo, hi, within) in one pass over all checked columns."""
    names = list(bounds)
    agg = df.agg(*[e for i, c in enumerate(names)
                   for e in (F.min(c).cast("double").alias(f"__mn_{i}"),
                             F.max(c).cast("double").alias(f"__mx_{i}"))])
    items = []
    for i, c in enumerate(names):
        lo, hi = bounds[c]
        mn, mx = F.col(f"__mn_{i}"), F.col(f"__mx_{i}")
        items.append((c, {"min": mn, "max": mx, "lo": F.lit(float(lo)), "hi": F.lit(float(hi)),
                          "within": F.coalesce((mn >= lo) & (mx <= hi), F.lit(True))}))
    return long_form(agg, items)


def ingest_report(df: DataFrame, critical: Iterable[str] = CRITICAL_COLUMNS,
                  domain_col: str = "Severity", allowed: Sequence = SEVERITY_DOMAIN,
                  bounds: Mapping[str, tuple[float, float]] = US_BOUNDING_BOX,
                  warn_pct: float = NULL_WARN_PCT, max_fraction: float = RANGE_MAX_FRACTION) -> DataFrame:
    """Null, domain and bounding-box checks in ONE scan: (check, column, count, pct, status).

    The reference ran one action per check over a cached table; here every
    counter is a conditional count in a single aggregate, so the input is read
    once and nothing needs to be cached.
    """
    critical = list(critical)
    box = None
    for c, (lo, hi) in bounds.items():
        part = (F.col(c) < lo) | (F.col(c) > hi)
        box = part if box is None else (box | part)
    agg = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(F.col(c).isNull()).alias(f"__null_{i}") for i, c in enumerate(critical)],
                 F.count_if(~F.col(domain_col).isin(list(allowed))).alias("__domain"),
                 F.count_if(box).alias("__box"))
    n = F.col("__n")

    def pct(x):
        return F.round(F.coalesce(F.try_divide(x * F.lit(100.0), n), F.lit(0.0)), 4)

    items = []
    for i, c in enumerate(critical):
        x = F.col(f"__null_{i}")
        items.append((c, {"check": F.lit("nulls"), "count": x, "pct": pct(x),
                          "status": F.when(pct(x) < warn_pct, "PASS").otherwise("WARN")}))
    d = F.col("__domain")
    items.append((domain_col, {"check": F.lit("domain"), "count": d, "pct": pct(d),
                               "status": F.when(d == 0, "PASS").otherwise("FAIL")}))
    b = F.col("__box")
    items.append((",".join(bounds), {"check": F.lit("bounds"), "count": b, "pct": pct(b),
                                     "status": F.when(b < n * F.lit(max_fraction), "PASS").otherwise("WARN")}))
    items.append(("*", {"check": F.lit("rows"), "count": n, "pct": F.lit(100.0),
                        "status": F.when(n > 0, "PASS").otherwise("FAIL")}))
    return long_form(agg, items)
