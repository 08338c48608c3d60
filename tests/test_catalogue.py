import os

import duckdb
import pytest

from tonnage.plans import catalogue

DATA = "/root/testdata/sf0.001"


def plain(value):
    if isinstance(value, float):
        return round(value, 9)
    return [plain(x) for x in value] if isinstance(value, (list, tuple)) else value


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for file in os.listdir(DATA):
        con.sql(f"create view {file.removesuffix('.parquet')} as select * from '{DATA}/{file}'")
    return con


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables here")
@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_its_oracle(spark, oracle, name):
    df = catalogue.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(str([plain(r[c]) for c in columns]) for r in df.collect())
    relation = oracle.sql(catalogue.ORACLES[name])
    assert sorted(relation.columns) == columns
    expected = sorted(str([plain(x) for x in r]) for r in relation.select(*(duckdb.ColumnExpression(c) for c in columns)).fetchall())
    assert got == expected


def test_anomalies_where_no_athlete_has_one_sex(spark, tmp_path):
    # one athlete, whose sex is F and Mx: nothing is left to judge
    spark.sql("select o_orderkey, 41L as o_custkey from values (1L), (2L), (6L), (8L) as t(o_orderkey)").write.parquet(f"{tmp_path}/orders.parquet")
    got = {r["path"]: r["value"] for r in catalogue.QUERIES["audit_anomalies"](spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.sql(f"create view orders as select * from '{tmp_path}/orders.parquet/*.parquet'")
    assert got == dict(con.sql(catalogue.ORACLES["audit_anomalies"]).fetchall())
    assert got["sex_conflicts"] == "1" and got["unexpected_sex_values/distinct"] == ""
