"""Every registered query equals its SQL twin on the smallest given tables."""

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import entry
from check import TABLES, canonical
from lynxrisk.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    assert len(got)
    sql = ORACLES.get(name)
    if sql is None:
        return
    cursor = db.execute(sql)
    want = pd.DataFrame(cursor.fetchall(), columns=[d[0] for d in cursor.description])
    pd.testing.assert_frame_equal(canonical(got), canonical(want))


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
