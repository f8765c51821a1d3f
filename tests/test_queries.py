import math

import duckdb
import pandas as pd
import pytest

from episoda.plans import oracles, queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def cell(x):
    if hasattr(x, "__len__") and not isinstance(x, str):
        return ",".join(map(str, x))
    if x is None or pd.isna(x):
        return "null"
    return repr(round(float(x), 6) + 0.0) if isinstance(x, (int, float)) and not isinstance(x, bool) and not math.isnan(x) else str(x)


def rows(df):
    return sorted(tuple(cell(x) for x in r) for r in df[sorted(df.columns)].astype(object).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(oracles.ORACLE_SQL))
def test_query_equals_its_sql(spark, con, name):
    got, want = queries.QUERIES[name](spark, SF).toPandas(), con.execute(oracles.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want) and rows(got) == rows(want)


def test_every_oracle_has_a_query():
    assert set(oracles.ORACLE_SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(oracles.ORACLE_SQL)))
def test_other_queries_run(spark, name):
    assert queries.QUERIES[name](spark, SF).count() >= 0


def test_isolation_draws_on_all_reference_rows(spark):
    """Reference rows that a hash order puts last are known to the forest: its cuts tell their values from those far outside."""
    from pyspark.sql import functions as F

    from episoda.operators import anomaly

    order = [r.id for r in spark.range(2100).orderBy(F.xxhash64("id")).collect()]
    rows = [("reference", e, float(i % 7) if i < 2000 else 100.0 + i % 7) for i, e in enumerate(order)] + [("test", 5000, 103.0), ("test", 5001, 1000.0)]
    got = {r.episode_index: r.score for r in anomaly.isolation_scores(spark.createDataFrame(rows, "dataset string, episode_index bigint, a double"), ["a"], 20).collect()}
    assert len(got) == 2102 and got[5000] < got[5001]
