import duckdb
import pytest

import __spark_entry__
from strataloom.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(df):
    def text(x):
        return "null" if x is None or x != x else f"{x:.9g}" if isinstance(x, float) else str(x)

    return sorted("|".join(text(x) for x in row) for row in df[sorted(df.columns)].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", [n for n in catalog.ORACLES if n != "multitable_integrity"])
def test_query_matches_sql(spark, db, name):
    assert plain(catalog.QUERIES[name](spark, SF).toPandas()) == plain(db.sql(catalog.ORACLES[name]).df())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 1 and set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
