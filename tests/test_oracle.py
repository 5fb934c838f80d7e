"""Every registered query against its SQL twin on whole tables."""

import glob
import math
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry_module
from tests.conftest import SF

QUERIES, ORACLE = entry_module.queries(), entry_module.oracle_sql()
#: Queries of the training-data pipeline, which have tests of their own.
NO_TWIN = re.compile(r"op\d+_\w+|pipeline").fullmatch


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    yield con
    con.close()


def _key(row):
    return tuple((v is None, f"{v:025.9f}" if isinstance(v, float) else str(v)) for v in row)


def _clean(v):
    return None if isinstance(v, float) and math.isnan(v) else v


def test_every_query_has_a_twin():
    assert all(NO_TWIN(name) for name in set(QUERIES) - set(ORACLE))
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted((tuple(_clean(r[c]) for c in cols) for r in df.collect()), key=_key)
    cur = duck.execute(ORACLE[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    order = [names.index(c) for c in cols]
    want = sorted((tuple(_clean(r[i]) for i in order) for r in cur.fetchall()), key=_key)
    assert got == want


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns[:5] == ["rt", "pid", "stop_id", "period", "period_value"]
    assert df.count() > 0


def test_sampling_is_repeatable_and_whole(spark, sf):
    first = QUERIES["sampled_trip_profiles"](spark, sf).collect()
    again = QUERIES["sampled_trip_profiles"](spark, sf).collect()
    assert sorted(first) == sorted(again)
    full = {tuple(r) for r in QUERIES["trip_profiles"](spark, sf).collect()}
    assert {tuple(r) for r in first} <= full
