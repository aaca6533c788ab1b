"""Every registered query of the core library against its DuckDB SQL."""

import os

import duckdb
import pytest

from parley.plans import audio, checks, foldsql, more, oracles, results, stages, talk  # noqa: F401  all register
from parley.plans.more import QUERIES

ORACLES = oracles.ORACLES | more.ORACLES


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for f in os.listdir(sf_dir):
        c.sql(f"create view {f.removesuffix('.parquet')} as select * from '{sf_dir}/{f}'")
    return c


def _plain(rows, columns):
    def text(x):
        if x is None:
            return "null"
        return f"{x:.4f}" if isinstance(x, float) else str(x)

    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([text(r[i]) for i in order] for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    want = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert _plain(df.collect(), df.columns) == _plain(want.fetchall(), want.columns)
