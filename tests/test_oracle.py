"""Every registered query beside its SQL."""

import compare as c
import pytest

from __spark_entry__ import entry, oracle_sql, queries


@pytest.fixture(scope="module")
def con(data):
    return c.connect(data)


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, con, data, name):
    line = c.compare(spark, con, name, data)
    assert line.startswith(("ok", "rows")), line


def test_keys():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["data_type", "window_start", "avg_value", "avg_user_id", "record_count"]
    assert df.count() > 0
