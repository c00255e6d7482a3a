import duckdb
import pytest

from claimloom.functions.scalar import year
import __spark_entry__ as entry
from claimloom.sources.files import geojson_features

QUERIES = {k: v for p in entry.PLANS for k, v in p.QUERIES.items()}
ORACLES = {k: v for p in entry.PLANS for k, v in p.ORACLES.items()}
SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, name):
    if name not in ORACLES:
        assert QUERIES[name](spark, SF).count() > 0
        return
    con = duckdb.connect()
    for t in ("customer", "part", "orders", "documents", "supplier", "lineitem", "nation", "region", "events", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = QUERIES[name](spark, SF)
    want = con.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    assert set(columns) == set(got.columns)
    assert sorted(map(repr, map(tuple, got.select(*columns).collect()))) == sorted(map(repr, want.fetchall()))


def test_year_and_features(spark):
    df = spark.createDataFrame([("built 1894", 1.0, 2.0), ("-300", None, 2.0), ("none", 1.0, 3.0)], "t string, lat double, lon double")
    assert [r[0] for r in df.select(year(df.t)).collect()] == [1894, -300, None]
    assert geojson_features(df).count() == 2
