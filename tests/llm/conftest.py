import duckdb
import pytest

from propensity.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture
def same_as_sql(spark):
    """Compares a query with its SQL twin over whole tables."""
    def compare(name, folder=SF):
        con = duckdb.connect()
        for t in ("documents", "pages", "benchmark", "labels"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
        df = QUERIES[name](spark, folder)
        want = con.execute(ORACLES[name])
        names = [c[0] for c in want.description]
        assert sorted(df.columns) == sorted(names)
        rows = sorted(map(tuple, df.select(*names).collect()), key=repr)
        assert rows == sorted(want.fetchall(), key=repr)
    return compare
