"""Every registered query on empty copies of the driver tables (same schemas,
no rows): it runs, and where it has an oracle, matches it (names and rows)."""

import tempfile

import duckdb
import pytest

import __spark_entry__ as ent
from oracle_check import digest
from sparkwright.sources.files import TABLES

from conftest import SF0001


@pytest.fixture(scope="module")
def empty_dir():
    d = tempfile.mkdtemp(prefix="sw-empty-")
    for t in TABLES:
        duckdb.sql(f"COPY (SELECT * FROM '{SF0001}/{t}.parquet' LIMIT 0) "
                   f"TO '{d}/{t}.parquet' (FORMAT PARQUET)")
    return d


def test_every_query_on_empty_tables(spark, empty_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{empty_dir}/{t}.parquet'")
    oracles = ent.oracle_sql()
    for name, fn in ent.queries().items():
        sdf = fn(spark, empty_dir)
        rows = [tuple(r) for r in sdf.collect()]
        if name not in oracles:
            continue
        res = con.execute(oracles[name])
        ocols = [d[0] for d in res.description]
        orows = res.fetchall()
        assert sorted(sdf.columns) == sorted(ocols), name
        assert digest(rows, sdf.columns)[0] == digest(orows, ocols)[0], name
