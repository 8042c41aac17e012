"""Every registered query against its SQL, on the smallest tables."""

import datetime as dt
import glob
import math
import os

import duckdb
import pytest
from conftest import SF_SMALL

import __spark_entry__ as entry_point

from forecourt.queries import ORACLES, QUERIES  # noqa: E402
from forecourt.schema import PREDICTION_COLUMNS  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_SMALL}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    if isinstance(v, (int, float)) and not isinstance(v, bool):
        return repr(float(v))
    return str(v.date() if isinstance(v, dt.datetime) else v)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert table(df.columns, df.collect()) == table(columns, result.fetchall())


def test_every_query_has_sql_and_is_registered():
    assert set(QUERIES) == set(ORACLES) <= set(entry_point.oracle_sql())
    assert set(QUERIES) <= set(entry_point.queries())


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.count() == 6000 and df.columns[0] == "listing_id"


def test_no_python_worker_and_no_pair_join_in_any_plan(spark):
    for name in sorted(ORACLES):
        plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        for bad in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct", "NestedLoop"):
            assert bad not in plan, (name, bad)


def test_partial_upsert_gives_every_prediction_column(spark):
    assert QUERIES["upsert_partial"](spark, SF_SMALL).columns == PREDICTION_COLUMNS
