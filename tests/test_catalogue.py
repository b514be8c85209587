"""Every query with SQL gives that SQL's rows; the others run and have rows."""

import datetime
import decimal

import duckdb
import pytest

from loomline.plans.catalogue import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return tuple(map(plain, v)) if isinstance(v, list | tuple) else v


def rows(columns, values):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(plain(v[i]) for i in order) for v in values), key=str)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.sql(ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_embedding_is_not_read_by_statistics(spark):
    plan = QUERIES["domain_summary"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "embedding" not in plan.replace("embeddings.parquet", "")
    assert "TakeOrderedAndProject" in QUERIES["vector_topk"](spark, SF)._jdf.queryExecution().executedPlan().toString()
