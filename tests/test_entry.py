import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry  # noqa: E402
from fairlead.plans import registry  # noqa: E402


def test_contract():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert {"p1_found", "p3_found", "p4_found", "p7_found"} <= set(registry.QUERIES)


def test_entry(spark, sf):
    assert entry.entry(spark).count() >= 0


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_sql(spark, sf, name):
    """Every query of the core gives the rows of its SQL."""
    duckdb = pytest.importorskip("duckdb")
    from fairlead.schema import TABLES
    from tools.compare import rows_of

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = registry.QUERIES[name](spark, sf)
    cur = con.execute(registry.ORACLES[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, cur.fetchall())
