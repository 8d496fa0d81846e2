"""Every registered query against its DuckDB oracle at sf0.01 (the driver's
correctness gate, run locally)."""

import duckdb
import pytest

import __spark_entry__ as ent
from oracle_check import digest, duck_type
from sparkwright.sources.files import TABLES

from conftest import SF001, SF0001

from sparkwright.plans import registry  # noqa: E402

registry.load_all()
#: The library's own queries; those of the corpus subpackage have their own tests.
QUERIES = {n: q for n, q in ent.queries().items() if n in registry.QUERIES}
ORACLES = dict(registry.ORACLES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF001)
    srows, scols = [tuple(r) for r in sdf.collect()], sdf.columns
    rel = con.sql(ORACLES[name])
    assert {c: duck_type(t) for c, t in sdf.dtypes} == \
        {c: str(t) for c, t in zip(rel.columns, rel.types)}
    res = con.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(scols) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(srows, scols)[0] == digest(orows, ocols)[0]


def test_every_query_runs_on_smoke_data(spark):
    for name, fn in QUERIES.items():
        if name in ORACLES:
            continue  # covered above at sf0.01
        assert fn(spark, SF0001).count() >= 0, name


def test_entry(spark):
    df = ent.entry(spark)
    assert df.columns == ["batchNum", "denominator", "molecule", "ratio"]
    assert df.count() > 0


# Python operators a query may use; every other query stays JVM-side.
PYTHON_ALLOWED = {"udf_filter": {"ArrowEvalPython"},
                  "json_array_items_udtf": {"ArrowEvalPythonUDTF"},
                  "file_listing": {"MapInPandas"}}


def test_plans_have_no_pair_joins_and_no_stray_python(spark):
    """Plan audit: no cartesian / nested-loop join anywhere; Python only where
    listed (and never row-at-a-time); every table scan is column-pruned
    unless the query needs all columns."""
    from plan_audit import audit_plan
    needs_all = {"cells_upsert_scan", "parquet_roundtrip", "orc_append_roundtrip",
                 "csv_untyped_roundtrip", "csv_typed_roundtrip", "json_roundtrip",
                 "repartition_write"}
    for name, fn in QUERIES.items():
        a = audit_plan(fn(spark, SF0001)._jdf.queryExecution().executedPlan().toString())
        assert not a["forbidden"], (name, a["forbidden"])
        assert set(a["python"]) <= PYTHON_ALLOWED.get(name, set()), (name, a["python"])
        assert "BatchEvalPython" not in a["python"], name
        if name not in needs_all:
            for fmt, loc, cols in a["scans"]:
                if loc.endswith(".parquet") and loc.replace(".parquet", "") in TABLES:
                    import pyarrow.parquet as pq
                    width = len(pq.read_schema(f"{SF0001}/{loc}").names)
                    assert len(cols) < width, (name, loc, cols)
