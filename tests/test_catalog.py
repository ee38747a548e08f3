"""Every registered query with SQL against DuckDB, as multisets with six significant digits."""

import duckdb
import pandas as pd
import pytest

from quillstone.plans import catalog, more

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def normal(df):
    def form(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return "-"
        if isinstance(v, float):
            return f"{v:.6g}"
        return str(v).removesuffix(" 00:00:00")

    def number(v):
        s = form(v)
        try:
            return f"{float(s):.6g}" if not isinstance(v, str) else s
        except ValueError:
            return s

    return sorted(tuple(map(number, r)) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(more.catalog_queries()))
def test_query(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF).toPandas()
    if name in catalog.ORACLES:
        want = duck.sql(catalog.ORACLES[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert normal(got) == normal(want)
    else:
        assert len(got)


def test_only_customers_with_pending_orders_are_covered(spark, tmp_path):
    spark.createDataFrame([(1, "A"), (2, "A"), (3, "B"), (4, None)], "c_custkey long, c_mktsegment string").write.parquet(str(tmp_path / "customer.parquet"))
    orders = [(1, "P"), (1, "P"), (1, "F"), (2, "F"), (2, "O"), (3, None), (None, "P")]
    spark.createDataFrame(orders, "o_custkey long, o_orderstatus string").write.parquet(str(tmp_path / "orders.parquet"))
    got = {tuple(r) for r in catalog.QUERIES["jn20_covered_by_category"](spark, str(tmp_path)).select("category", "n", "n_covered").collect()}
    assert got == {("A", 2, 1), ("B", 1, 0), (None, 1, 0)}
