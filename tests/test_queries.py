"""Every registered query against its SQL on DuckDB."""

import math

import duckdb
import pytest

from gazetta.plans.queries import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf001):
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf001}/{t}.parquet'")
    return db


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, sf001, duck, name):
    got = QUERIES[name](spark, sf001)
    want = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert rows(got.columns, got.collect()) == rows(names, want.fetchall())


def test_exact_sample(spark, sf001):
    ids = [r.doc_id for r in QUERIES["exact_sample"](spark, sf001).collect()]
    assert len(ids) == len(set(ids)) == 100


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 3
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
