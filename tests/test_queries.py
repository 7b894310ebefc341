"""Every query with SQL agrees with DuckDB: columns, types and rows."""

import glob
import os

import duckdb
import pytest

from inkspar.plans import registry


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sf_dir, duck, name, tmp_path):
    out = str(tmp_path / "out")
    registry.QUERIES[name](spark, sf_dir).write.parquet(out)
    ours = f"(SELECT * FROM '{out}/*.parquet')"
    if name not in registry.ORACLES:
        assert duck.sql(f"SELECT count(*) FROM {ours}").fetchall()[0][0] > 0
        return
    duck.sql(f"CREATE OR REPLACE TEMP TABLE wanted AS {registry.ORACLES[name]}")
    wanted = {r[0]: r[1] for r in duck.sql("DESCRIBE wanted").fetchall()}
    assert wanted == {r[0]: r[1] for r in duck.sql(f"DESCRIBE SELECT * FROM {ours}").fetchall()}
    cols = ", ".join(f'"{c}"' for c in wanted)
    for a, b in (("wanted", ours), (ours, "wanted")):
        assert duck.sql(f"SELECT count(*) FROM (SELECT {cols} FROM {a} EXCEPT ALL SELECT {cols} FROM {b})").fetchall() == [(0,)]


def test_entry_and_names(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
