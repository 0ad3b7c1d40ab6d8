"""Every registered query against its DuckDB oracle on the smallest data set."""
import math

import duckdb
import pytest

import __spark_entry__ as E
from salesmart.plans.oracle import ORACLE
from salesmart.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if type(v).__name__ == "Decimal":
        return round(float(v), 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:19]
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(k for k in ORACLE if k in QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()), key=repr)
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    exp = sorted((tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()), key=repr)
    assert got == exp


def test_entry_runs(spark):
    assert E.entry(spark).count() > 0


_TYPES = {"IntegerType()": "INTEGER", "LongType()": "BIGINT", "DoubleType()": "DOUBLE", "StringType()": "VARCHAR",
          "DateType()": "DATE", "BooleanType()": "BOOLEAN", "TimestampNTZType()": "TIMESTAMP"}


@pytest.mark.parametrize("name", sorted(k for k in ORACLE if k in QUERIES))
def test_query_types_match_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    spark_types = {f.name: _TYPES.get(repr(f.dataType), repr(f.dataType)) for f in df.schema.fields}
    duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {E.oracle_sql()[name]}").fetchall()}
    assert spark_types == duck_types


# Nested-loop joins are allowed only against a broadcast side of proven size:
# the country table (a fixed list of at most ~250 rows).
_BOUNDED_NESTED_LOOP = {"country_iso": 1}


@pytest.mark.parametrize("name", sorted(k for k in QUERIES if not k.startswith("stream_")))
def test_plan_has_no_python_and_no_cross_products(spark, name):
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        E.queries()[name](spark, SF).explain("formatted")
    tree = buf.getvalue().split("\n\n(")[0]
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct"):
        assert bad not in tree
    assert tree.count("BroadcastNestedLoopJoin") <= _BOUNDED_NESTED_LOOP.get(name, 0)
