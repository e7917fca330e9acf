"""Differential check: every registered query against its DuckDB SQL at sf0.01."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import digest  # noqa: E402
from shelfwise.sources.tables import TABLES, table_path  # noqa: E402

from shelfwise.plans.catalog import QUERIES as OWN  # noqa: E402
from conftest import SF_CHECK, SF_SMOKE  # noqa: E402

TYPE_MAP = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
            "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{table_path(SF_CHECK, t)}')")
    return con


def test_every_query_has_sql():
    assert set(OWN) <= set(E.oracle_sql()) and set(OWN) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_matches_sql(spark, duck, name):
    sdf = E.queries()[name](spark, SF_CHECK)
    cur = duck.execute(E.oracle_sql()[name])
    otypes = {d[0]: str(d[1]) for d in cur.description}
    od = cur.df()
    stypes = {f.name: TYPE_MAP.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
    assert stypes == otypes
    assert digest(sdf.toPandas()) == digest(od)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0].skus > 0
    assert E.queries()["run_summary"](spark, SF_SMOKE).schema == df.schema
