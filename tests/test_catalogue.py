"""Every query of the catalogue gives the rows that DuckDB gives for its SQL."""

import os

import duckdb
import pytest

from tributary.plans import catalogue

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for f in os.listdir(DIR):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DIR}/{f}'")
    return c


def plain(rows):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=lambda r: [(v is not None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, db, name):
    df = catalogue.QUERIES[name](spark, DIR)
    if name not in catalogue.ORACLE:
        assert df.count() > 0
        return
    sql = catalogue.ORACLE[name]
    columns = [r[0] for r in db.execute(f"DESCRIBE {sql}").fetchall()]
    assert sorted(df.columns) == sorted(columns)
    assert plain(tuple(r) for r in df.select(columns).collect()) == plain(db.execute(sql).fetchall())


def test_number_equivalence_of_long_keys(spark, tmp_path):
    """Keys of over 6 digits keep their last ones, by which numbers are compared."""
    keys = [5, 151, 202003, 999_996, 1_000_001, 1_039_266, 2_020_003, 8_999_996, 8_999_997, 123_456_786]
    spark.createDataFrame([(k,) for k in keys], "o_orderkey long").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    c = duckdb.connect()
    c.execute(f"CREATE VIEW orders AS SELECT * FROM '{tmp_path}/orders.parquet/*.parquet'")
    got = catalogue.QUERIES["number_equivalence"](spark, str(tmp_path)).select("o_orderkey", "igual").collect()
    assert plain(tuple(r) for r in got) == plain(c.execute(catalogue.ORACLE["number_equivalence"]).fetchall())
