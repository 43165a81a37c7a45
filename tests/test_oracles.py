"""Every registered query with a DuckDB oracle must return the same rows
(column names, row count, order-insensitive values) at sf0.001."""

import os

import duckdb
import pytest

from oracle_check import TABLES, digest

SF = "/root/testdata/sf0.001"
SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
                 "boolean": "BOOLEAN", "float": "FLOAT", "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def _names():
    import __spark_entry__ as E
    return sorted(E.oracle_sql())


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    import __spark_entry__ as E
    df = E.queries()[name](spark, SF)
    scols, srows = df.columns, [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    dcols, drows = [d[0] for d in res.description], res.fetchall()
    assert sorted(scols) == sorted(dcols)
    dtypes = {d[0]: str(d[1]) for d in res.description}
    for f in df.schema.fields:
        st = f.dataType.simpleString()
        assert SPARK_TO_DUCK.get(st, st) == dtypes[f.name], (f.name, st, dtypes[f.name])
    assert len(srows) == len(drows)
    assert digest(scols, srows)[0] == digest(dcols, drows)[0]


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["lang", "docs_kept", "n_tokens"]
    assert len(df.collect()) > 0
