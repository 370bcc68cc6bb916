"""Every citation-impact query against its SQL in DuckDB."""

import math

import duckdb
import pytest

from impactory.functions.fixpoint import Files, Scratch, shared_folder
from impactory.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("part", "orders", "lineitem"):
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def _rows(rows):
    return sorted(repr([round(v, 6) if isinstance(v, float) and not math.isnan(v) else v for v in r]) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, name):
    before = Files(spark, shared_folder(spark)).names(), spark.sql("SHOW DATABASES").count()
    with Scratch(spark):
        got = registry.QUERIES[name](spark, SF)
        want = con.sql(registry.ORACLES[name])
        columns = sorted(got.columns)
        assert columns == sorted(want.columns)
        at = [want.columns.index(c) for c in columns]
        assert _rows([r[c] for c in columns] for r in got.collect()) == _rows([r[i] for i in at] for r in want.fetchall())
    assert (Files(spark, shared_folder(spark)).names(), spark.sql("SHOW DATABASES").count()) == before and spark.sql("SHOW TABLES").isEmpty()


def test_entry_and_registry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() == 200
