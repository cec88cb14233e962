"""Every registered query against its DuckDB oracle (sf0.001 for speed)."""

import os

import pytest

from threadlens.plans import ORACLES, QUERIES, load_all

load_all()
SF = os.environ.get("THREADLENS_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    from tests.oracle_check import oracle_con
    return oracle_con(SF)


_TYPES = {"IntegerType()": "INTEGER", "LongType()": "BIGINT", "DoubleType()": "DOUBLE",
          "StringType()": "VARCHAR", "BooleanType()": "BOOLEAN", "TimestampNTZType()": "TIMESTAMP"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    from tests.oracle_check import canon
    df = QUERIES[name](spark, SF)
    sdf = df.toPandas()
    if name not in ORACLES:
        assert len(sdf.columns) > 0
        return
    rel = con.sql(ORACLES[name])
    spark_types = {f.name: _TYPES.get(str(f.dataType), str(f.dataType)) for f in df.schema.fields}
    assert spark_types == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    odf = rel.df()
    sc, sr = canon(sdf)
    oc, orows = canon(odf)
    assert sc == oc
    assert len(sr) == len(orows)
    assert sr == orows


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
