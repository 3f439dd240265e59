"""Every query with a DuckDB oracle matches it on the smallest tables (names, types, values)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from sevlens.sources.tables import TABLES

DUCK_TO_SPARK = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string",
                 "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "DOUBLE[]": "array<double>"}


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_matches_oracle(spark, sf_small, duck, key):
    sdf = E.queries()[key](spark, sf_small)
    rel = duck.sql(E.oracle_sql()[key])
    assert sorted(sdf.columns) == sorted(rel.columns)
    types = dict(sdf.dtypes)
    for name, t in zip(rel.columns, rel.types):
        assert types[name] == DUCK_TO_SPARK.get(str(t), str(t)), name
    assert _rows(sdf.columns, [tuple(r) for r in sdf.collect()]) == _rows(rel.columns, rel.fetchall())
