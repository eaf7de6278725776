import duckdb
import pytest

from skein.plans import catalog

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_against_duckdb(spark, name):
    got = catalog.QUERIES[name](spark, DATA).toPandas()
    assert len(got.columns)
    if name not in catalog.ORACLES:
        assert len(got)
        return
    con = duckdb.connect()
    for t in TABLES.split():
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    want = con.sql(catalog.ORACLES[name]).df()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    both = [x[cols].sort_values(cols).reset_index(drop=True).astype(str) for x in (got, want)]
    assert both[0].equals(both[1])
