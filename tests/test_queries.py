"""Every registered query against its SQL over the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracle import compare, connect
from rillmark.plans import QUERIES
from tests.conftest import SF_DIR

STREAMS = [n for n in QUERIES if "_stream_" in n and n != "s7_stream_as_table"]
TABLES = [n for n in QUERIES if n not in STREAMS]


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_names_and_entry(spark):
    assert set(oracle_sql()) <= set(queries())
    assert entry(spark).columns == ["event_type", "cnt", "window_start", "window_end"]


@pytest.mark.parametrize("name", TABLES)
def test_query_agrees_with_sql(spark, db, name):
    got = queries()[name](spark, SF_DIR).toPandas()
    assert compare(got, db.sql(oracle_sql()[name]).df()) is None


@pytest.mark.parametrize("name", STREAMS)
def test_stream_agrees_with_sql(spark, db, name):
    got = queries()[name](spark, SF_DIR).toPandas()
    assert compare(got, db.sql(oracle_sql()[name]).df()) is None
