"""Every registered query against its SQL counterpart."""

import duckdb
import pytest

import __spark_entry__ as entry

# plans that would pair every row with every row
PAIRING = ("CartesianProduct", "BroadcastNestedLoopJoin")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def sql(sf):
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return connection


def comparable(rows):
    return sorted((tuple(0.0 if v == 0 and isinstance(v, float) else v for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, sf, sql, name):
    df = entry.queries()[name](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in PAIRING), plan
    columns = sorted(df.columns)
    rows = comparable([tuple(r[c] for c in columns) for r in df.collect()])
    oracle = entry.oracle_sql().get(name)
    if oracle is None:
        assert rows
        return
    result = sql.execute(oracle)
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    assert rows == comparable([tuple(r[names.index(c)] for c in columns) for r in result.fetchall()])


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_stop_words_are_those_of_spark(spark):
    from pyspark.ml.feature import StopWordsRemover

    from nearkin.plans.oracles import STOP_WORDS

    assert STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")

