"""Every registered query against its SQL in DuckDB."""

import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as driver
from streamlog.plans import catalogue, oracle

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
QUERIES, SQL = catalogue.QUERIES, oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def canonical(frame: pd.DataFrame) -> list[tuple]:
    columns = sorted(frame.columns)

    def cell(value):
        if pd.isna(value):
            return None
        if isinstance(value, float) and value.is_integer():
            return int(value)
        return value.isoformat() if hasattr(value, "isoformat") else value.item() if hasattr(value, "item") else value

    found = [tuple(cell(v) for v in row) for row in frame[columns].astype(object).itertuples(index=False)]
    return sorted(found, key=repr)


SPARK_TYPES = {
    "VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    types = {column: SPARK_TYPES[str(kind)] for column, kind, *_ in duck.execute(SQL[name]).description}
    assert dict(result.dtypes) == types
    expected, actual = duck.execute(SQL[name]).fetchdf(), result.toPandas()
    assert len(actual) == len(expected)
    assert len(expected) > 0
    assert canonical(actual) == canonical(expected)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(driver.queries())


def test_entry(spark):
    result = driver.entry(spark)
    assert result.columns == ["topic", "partition", "n", "first_offset", "next_offset"]
    assert result.count() == 20
